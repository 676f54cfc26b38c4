"""Connected components of an edge table."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, ship


#: Edges that a task joins up at a time.
MOST = 200_000


def _contracted(edges: DataFrame, most: int) -> DataFrame:
    """Each run of ``most`` edges of a task as stars: every node with the smallest node that the run joins it to."""
    kind = edges.schema["a"].dataType.simpleString()

    def stars(held: list[tuple], types: list) -> pa.RecordBatch:
        up: dict = {}

        def find(x):
            root = x
            while (above := up.get(root, root)) != root:
                root = above
            while x != root:
                up[x], x = root, up.get(x, x)
            return root

        for a, b in held:
            a, b = find(a), find(b)
            if a != b:
                up[max(a, b)] = min(a, b)
        found = [(x, find(x)) for x in list(up)]
        return pa.RecordBatch.from_arrays([pa.array([p[i] for p in found], t) for i, t in enumerate(types)], names=["a", "b"])

    def run(batches):
        held: list[tuple] = []
        types: list = []
        for batch in batches:
            types = [c.type for c in batch.columns]
            held += zip(*[c.to_pylist() for c in batch.columns], strict=True)
            if len(held) >= most:
                yield stars(held, types)
                held = []
        if held:
            yield stars(held, types)

    ship(edges.sparkSession)
    return edges.mapInArrow(run, f"a {kind}, b {kind}")


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one other at most, and on no node that hangs itself."""
    ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("low"), F.lit(0).alias("high")).union(edges.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("v").agg(F.sum("low").alias("low"), F.max("high").alias("high")).filter("low > 1 or (low > 0 and high > 0)").isEmpty()


def components(edges: DataFrame, most: int = MOST) -> DataFrame:
    """``edges``: a, b of one orderable type. Returns (a, b): each node but the smallest of its component, with that smallest.

    Tasks join up what they can see first, ``most`` edges at a time. Where no more than that are left one task
    ends it: rounds are some four jobs each, however few the edges, and each leaves its mark on the driver. Otherwise a round hangs the larger neighbours of a node on its
    smallest one, then the smaller ones, until only stars are left; rounds grow with the logarithm
    of the longest path. Minima are aggregated before a shuffle, and no node's neighbours are ever
    collected. Loops and repeats do no harm.
    """
    now = cut(_contracted(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b"), most).distinct())
    if now.count() <= most:
        return cut(_contracted(now.coalesce(1), most))
    while not _is_stars(now):
        both = now.union(now.select("b", "a"))
        # minima are cut, so that the join has an exchange on either side and Spark can split a hub's partition
        low = cut(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()
        low = cut(large.groupBy("a").agg(F.min("b").alias("m")))
        near = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")
        now = cut(near.union(low.select("a", F.col("m").alias("b"))).distinct())
    return now
