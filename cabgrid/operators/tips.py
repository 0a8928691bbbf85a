"""Generous riders: tips per taxi and day."""

from pyspark.sql import DataFrame, functions as F

from cabgrid.functions.money import sum_of_cents
from cabgrid.operators.topk import top_k, top_k_per_group
from cabgrid.schema import TOP_K

DAY = "1 day"


def driver_tips(trips: DataFrame, cents: bool = False) -> DataFrame:
    """``total_tip_amount`` per taxi and day (partial sums before the shuffle). With
    ``cents``, tips are whole cents and added up as such: the order of rows doesn't matter."""
    w = F.window("pickup_dt", DAY)
    return (
        trips.groupBy("medallion", w.alias("w"))
        .agg((sum_of_cents("tip_amount") if cents else F.sum("tip_amount")).alias("total_tip_amount"))
        .select("medallion", F.col("w.start").alias("day"), "total_tip_amount")
    )


def pleasant_drivers(trips: DataFrame, k: int = TOP_K, cents: bool = False) -> DataFrame:
    """The k best (taxi, day) tip totals over the whole input."""
    order = [F.desc("total_tip_amount"), F.asc("day"), F.asc("medallion")]
    return top_k(driver_tips(trips, cents), order, k)


def pleasant_drivers_per_day(trips: DataFrame, k: int = TOP_K) -> DataFrame:
    """The k best-tipped taxis of every day, ranked 1..k."""
    order = [F.desc("total_tip_amount"), F.asc("medallion")]
    return top_k_per_group(driver_tips(trips), ["day"], order, k)
