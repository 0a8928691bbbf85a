"""Connected components of a link table, as rounds of joins."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cabgrid.llm.scratch import saved


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over one partition's links: a star for each local group."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
    stars = [(x, r) for x in parent if (r := find(x)) != x]
    for i in range(0, len(stars), 50_000):
        a, b = zip(*stars[i : i + 50_000])
        yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def connected(links: DataFrame, keep: Callable[[DataFrame, str], DataFrame] = saved) -> DataFrame:
    """(``node``, ``component``) for every node of the links (``a``, ``b``); the
    component is its smallest node.

    Links of one partition are first reduced to stars by union-find (memory: the
    nodes of a partition). Then rounds alternate two steps until nothing moves:
    each node's larger neighbours are linked to its smallest neighbour, then each
    node is linked to its smallest one alone. Smallest neighbours are minima, so
    a node with very many links is combined before the shuffle and the join with
    it is one that Spark can split. Null ends are ignored; no links, no rows. Tables
    between the rounds are written by ``keep``."""
    links = links.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = keep(links.mapInArrow(_forest, "a long, b long").distinct(), "stars")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.unionByName(least.where("m < a").select("a", F.col("m").alias("b"))).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        edges = keep(small.where("a <> b").distinct(), "edges")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
