"""Approximate nearest neighbours by descent: neighbours of neighbours are likely neighbours.

Every point starts with points that a hash throws together. In a round each point brings its own
neighbours and those it is a neighbour of together, some of either, new ones first; they are compared
with each other, and what is nearer than the farthest a point has takes its place (Dong et al.,
2011). A round is a join that fetches the vectors and one regrouping; groups are bounded by the
number of neighbours taken part in, so the work of a round grows with the number of points alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import Scratch, ship

FOUND = "a long, b long, distance double"


def _compared(batches):
    """Pairs of each run of equal g (rows: g, a, fresh, most, v): those with a new one that are nearer than the farthest either has."""
    held: list[tuple] = []
    now = None
    out: list[np.ndarray] = []

    def close():
        if len(held) < 2:
            return
        ids = np.array([h[0] for h in held], dtype=np.int64)
        fresh, most = np.array([h[1] for h in held]), np.array([h[2] for h in held])
        x = np.stack([h[3] for h in held])
        d = np.sqrt(np.maximum(0, ((x[:, None] - x[None]) ** 2).sum(2)))
        i, j = np.nonzero((fresh[:, None] | fresh[None]) & (ids[:, None] != ids[None]) & (d < most[:, None]))
        out.append(np.rec.fromarrays([ids[i], ids[j], d[i, j]], names="a,b,d"))

    def batch():
        r = np.concatenate(out) if out else np.rec.fromarrays([np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)], names="a,b,d")
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(r["a"]), pa.array(r["b"]), pa.array(r["d"])], names=["a", "b", "distance"])

    for b in batches:
        g, a, fresh, most = (c.to_pylist() for c in b.columns[:4])
        v = np.asarray(b.column(4).flatten(), dtype=np.float64).reshape(b.num_rows, -1)
        for r in range(b.num_rows):
            if g[r] != now:
                close()
                now, held = g[r], []
            held.append((a[r], fresh[r], most[r], v[r]))
        yield batch()
    close()
    yield batch()


def _grouped(rows: DataFrame) -> DataFrame:
    return rows.select("g", "a", "fresh", "most", "v").repartition("g").sortWithinPartitions("g", "a").mapInArrow(_compared, FOUND)


def descend(
    vectors: DataFrame,
    k: int = 20,
    metric: str = "euclidean",
    key: str = "id",
    vector: str = "v",
    rounds: int = 8,
    width: int = 15,
    settle: float = 0.002,
    seed: int = 0,
) -> DataFrame:
    """a, b, rank, distance: about the k nearest others of each vector (ids unique), ties by b. metric: euclidean or cosine.

    ``width``: how many neighbours, and how many of which a point is a neighbour, take part in a
    round. Rounds end when fewer than ``settle`` of all places changed, or after ``rounds``. The
    lists are those of a run with this seed; recall against ``nearest`` is measured in the tests. Vectors that are null, or
    hold a null or a number that is not finite, and for the cosine zero vectors, take no part; all
    vectors have the same length. One vector has no neighbours and gives no row.
    """
    spark = ship(vectors.sparkSession)
    kept = Scratch(spark, "descent")
    # floats stay as short as they are until they are compared, as doubles
    short = metric == "euclidean" and vectors.schema[vector].dataType.simpleString() == "array<float>"
    each = F.col(vector) if short else F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall("v", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    rows = vectors.select(F.col(key).cast("long").alias("a"), each.alias("v")).filter(F.col("v").isNotNull() & (F.size("v") > 0)).filter(finite)
    if metric == "cosine":
        norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
        rows = rows.withColumn("n", norm).filter("n > 0").select("a", F.transform("v", lambda x: x / F.col("n")).alias("v"))
    rows = kept.put(rows)
    n = rows.count()
    nearest_first = Window.partitionBy("a").orderBy("distance", "b")

    def best(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(nearest_first)).filter(F.col("rank") <= k)

    # two throws, so that hardly any point starts without k others
    thrown = F.pmod(F.xxhash64("a", "t", F.lit(seed)), F.lit(max(1, n // (k + k // 2 + 2))))
    start = rows.withColumn("t", F.explode(F.array(F.lit(0), F.lit(1))))
    start = start.select(F.concat_ws(":", "t", thrown).alias("g"), "a", F.lit(True).alias("fresh"), F.lit(float("inf")).alias("most"), "v")
    lists = kept.put(best(_grouped(start).repartition("a").distinct()).withColumn("fresh", F.lit(True)))
    for r in range(rounds):
        kth = lists.groupBy("a").agg(F.max("distance").alias("far"), F.count(F.lit(1)).alias("m"))
        kth = kth.select("a", F.when(F.col("m") < k, F.lit(float("inf"))).otherwise(F.col("far")).alias("most"))
        there = lists.select(F.col("a").alias("g"), F.col("b").alias("a"), "fresh", F.lit(0).alias("way"))
        both = there.unionByName(lists.select(F.col("b").alias("g"), "a", "fresh", F.lit(1).alias("way")))
        # new ones first, then by hash; a hub's many are cut to the width before they are shuffled
        order = Window.partitionBy("g", "way").orderBy(F.desc("fresh"), F.xxhash64("g", "a", F.lit(seed + r)))
        taken = both.withColumn("p", F.row_number().over(order)).filter(F.col("p") <= width).groupBy("g", "a").agg(F.max("fresh").alias("fresh"))
        taken = kept.put(taken)
        # where nobody is new nobody is compared: only the other groups fetch vectors
        news = taken.groupBy("g").agg(F.count_if("fresh").alias("news")).filter("news > 0").select("g")
        met = taken.join(news, "g", "left_semi")
        found = _grouped(met.join(rows.join(kth, "a", "left").fillna({"most": float("inf")}), "a"))
        asked = taken.filter("fresh").select(F.col("g").alias("a"), F.col("a").alias("b")).withColumn("met", F.lit(True))
        old = lists.join(asked, ["a", "b"], "left").select("a", "b", "distance", (F.col("fresh") & F.col("met").isNull()).alias("fresh"), F.lit(True).alias("had"))
        merged = old.unionByName(found.select("*", F.lit(True).alias("fresh"), F.lit(False).alias("had")))
        # dealt by a once, which is what the sums of repeated pairs and the ranks both need
        merged = merged.repartition("a").groupBy("a", "b").agg(F.min("distance").alias("distance"), F.max("had").alias("had"), F.min("fresh").alias("fresh"))
        lists, seen = kept.put_seen(best(merged), F.count_if(~F.col("had")).alias("new"))
        if seen["new"] < settle * n * k:
            break
    out = lists.withColumn("distance", F.col("distance") ** 2 / 2 if metric == "cosine" else F.col("distance"))
    out = kept.put(out.select("a", "b", "rank", "distance"))
    kept.drop_before(1)
    return out
