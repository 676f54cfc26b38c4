"""Ball k-means: centroid clustering that compares a vector only with centroids its ball can reach.

A cluster is a ball: a centroid and the largest distance of a member. Another centroid is a
neighbour of the cluster only if it lies within two radii; its half distances cut the ball into a
stable core, whose members stay without a comparison, and annuli, whose members are compared with
as many of the neighbours, nearest first, as their own distance asks for (Xia et al., 2020). All of
it is integer arithmetic, so that ties and borders are those of the plain algorithm.

A round is one pass over the table of vectors with their clusters: it writes the next such table to
the shared folder (so a lost executor costs a task, not the rounds before), and sums per cluster
are added up by Spark. The driver holds the centroids alone: clusters times components.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .storage import drop_dir, new_dir

#: Scaled components are bounded by this, so that the squared distance of some hundred of them fits 64 bits.
BOUND = 1 << 25
#: Below this all products and sums of a hundred components are exact as doubles.
EXACT = 1 << 20
LARGEST = (1 << 63) - 1
STATE = "vec_id long, v array<int>, cluster int, d2 long"


@dataclass(frozen=True)
class Settings:
    components: int = 64
    scale: int = 256
    clusters: int = 40
    rounds: int = 5
    seed: str = "2"


def scaled_vectors(vectors: DataFrame, s: Settings, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, v: floor(scale * x) of vectors with exactly ``components`` components, none null or not finite."""
    finite = F.forall("v", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(vector_col, lambda x: x.cast("double")).alias("v"))
    kept = rows.filter((F.size("v") == s.components) & finite)
    bounded = F.transform("v", lambda x: F.least(F.greatest(F.floor(F.greatest(F.least(x, F.lit(2.0**40)), F.lit(-(2.0**40))) * s.scale), F.lit(-BOUND)), F.lit(BOUND)).cast("int"))
    return kept.select("vec_id", bounded.alias("v"))


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of each row of x to the one centroid c, or to the centroid in the same row."""
    d = x - c
    return np.einsum("ij,ij->i", d, d)


class Balls:
    """Centroids, and for every cluster the neighbours within two radii, nearest first, with their squared distances."""

    def __init__(self, centroids: np.ndarray, radii: np.ndarray | None):
        self.c = c = centroids
        self.near: list[tuple[np.ndarray, np.ndarray]] = []
        if radii is None:  # no clusters yet
            return
        for i in range(len(c)):
            d2 = squared(c, c[i])
            order = np.lexsort((np.arange(len(c)), d2))
            order = order[(order != i) & (d2[order] <= 4 * (radii[i] * (1 + 1e-9) + 1) ** 2)]
            self.near.append((order, d2[order]))

    def first(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest of all centroids; ties to the smaller number."""
        f = np.float64 if max(np.abs(x).max(initial=0), np.abs(self.c).max()) <= EXACT else np.int64
        y, c = x.astype(f), self.c.astype(f)
        d2 = (y * y).sum(1)[:, None] + (c * c).sum(1)[None] - 2 * (y @ c.T)
        best = d2.argmin(1)
        return best, d2[np.arange(len(x)), best].astype(np.int64)

    def again(self, x: np.ndarray, cluster: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Nearest centroids of vectors that had these clusters, and how many comparisons with neighbours it took."""
        best, d2 = cluster.copy(), squared(x, self.c[cluster])
        compared = 0
        order = np.argsort(cluster, kind="stable")
        ends = np.cumsum(np.bincount(cluster, minlength=len(self.c)))
        for i, (near, gap) in enumerate(self.near):
            own = order[ends[i - 1] if i else 0 : ends[i]]
            if not len(own) or not len(near):
                continue
            # a centroid farther than two own distances cannot be nearer, nor tie
            annulus = np.searchsorted(gap, 4 * d2[own], side="right")
            for j in range(annulus.max()):
                ask = own[annulus > j]
                compared += len(ask)
                other = squared(x[ask], self.c[near[j]])
                win = (other < d2[ask]) | ((other == d2[ask]) & (near[j] < best[ask]))
                best[ask[win]], d2[ask[win]] = near[j], other[win]
        return best, d2, compared


def _assigned(state: DataFrame, balls: Balls, fresh: bool) -> DataFrame:
    shared = ship(state.sparkSession).sparkContext.broadcast(balls)

    def run(batches):
        own = shared.value
        for b in batches:
            if not b.num_rows:
                continue
            x = np.asarray(b.column(1).flatten()).astype(np.int64).reshape(b.num_rows, -1)
            best, d2 = own.first(x) if fresh else own.again(x, np.asarray(b.column(2)).astype(np.int64))[:2]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(best.astype(np.int32)), pa.array(d2)], names=["vec_id", "v", "cluster", "d2"])

    return state.mapInArrow(run, STATE)


def _sums(state: DataFrame, n: int) -> list:
    """One row a cluster: members, largest and summed distance, and the sum of each component."""
    parts = [F.sum(F.col("v")[j].cast("long")).alias(f"s{j}") for j in range(n)]
    return state.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.max("d2").alias("far"), F.coalesce(F.try_sum("d2"), F.lit(LARGEST)).alias("inertia"), *parts).collect()


def ball_kmeans(vectors: DataFrame, settings: Settings = Settings(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Centroids start as the vectors whose ``seed:id`` has the smallest SHA-256 (fewer vectors than
    clusters: all of them; a null id is written null; rows that share an id are ordered by vector).
    Each round assigns and then moves every centroid that has members to the floor of their mean;
    afterwards vectors are assigned once more. Repeated rows are vectors of their own. Scaled components
    beyond 2**25 count as 2**25, and an inertia beyond 64 bits as the largest number of them. No vectors give no rows; other columns are not read.
    """
    spark, s = vectors.sparkSession, settings
    given = scaled_vectors(vectors, s, id_col, vector_col)
    key = F.sha2(F.concat(F.lit(f"{s.seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    start = given.orderBy(key, "v").limit(s.clusters).select("v").collect()
    empty = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not start:
        return spark.createDataFrame([], empty)
    c = np.array([r["v"] for r in start], dtype=np.int64)
    radii: np.ndarray | None = None
    state, folder = given, None
    for t in range(s.rounds + 1):
        balls = Balls(c, radii)
        own = new_dir(spark, f"clusters-{t}")
        _assigned(state, balls, fresh=radii is None).write.parquet(own)
        state = spark.read.schema(STATE).parquet(own)
        if folder:
            drop_dir(spark, folder)
        folder = own
        sums = _sums(state, s.components)
        if t == s.rounds:
            break
        moved = c.copy()
        radii = np.zeros(len(c))
        for r in sums:
            moved[r["cluster"]] = [r[f"s{j}"] // r["n"] for j in range(s.components)]
            radii[r["cluster"]] = np.sqrt(float(r["far"]))
        # the ball about the new centroid: the old one's radius and the way that the centroid went
        radii += np.sqrt(squared(moved, c).astype(np.float64))
        c = moved
    inertia = min(LARGEST, sum(r["inertia"] for r in sums))
    told = [(r["cluster"], r["inertia"], inertia, hashlib.sha256(",".join(map(str, c[r["cluster"]].tolist())).encode()).hexdigest()) for r in sums]
    figures = spark.createDataFrame(told, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # one row a cluster
    return state.select("vec_id", "cluster", F.col("d2").alias("distance")).join(F.broadcast(figures), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
