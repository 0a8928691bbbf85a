"""Top-k with a total order (ties broken by the listed columns)."""

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """Global top k. Planned as TakeOrderedAndProject: each task keeps its
    own k best rows and only those reach the final merge."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, group: list[str], order: list[Column], k: int, rank_col: str = "rank") -> DataFrame:
    """Top k rows of every group, numbered 1..k in ``rank_col``. The
    ``row_number() <= k`` filter lets Spark insert a per-partition group
    limit before the shuffle, so at most k rows per group and map task move."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)
