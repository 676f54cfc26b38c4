"""Exact top-k search by inner product: a ball tree per shard, searched by branch and bound.

A node's inner product with a query is at most q . centre + |q| * radius. Nodes are visited in the
order of that bound and left out once it is below the current kth score of every query that is
still open. Trees are built once, a row each, and so are blocks of queries; every pair of a tree and
a block is searched where Spark's join brings the two together. A bounded pilot is searched first:
its kth scores travel with the queries, and pairs of one block in one task pass on what they found.
"""

from __future__ import annotations

import heapq
import io

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, ship

NO_ID = (1 << 63) - 1
LOWEST = -(1 << 63)
RESULT = "block int, q int, query_id long, vec_id long, score long"


def packed(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpacked(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as got:
        return {k: got[k] for k in got.files}


class BallTree:
    def __init__(self, ids: np.ndarray, x: np.ndarray, leaf: int):
        self.x, self.ids = x, ids
        spans: list[list[int]] = []
        centres, radii = [], []
        order = np.arange(len(x))
        f = x.astype(np.float64)
        todo = [(0, len(x), -1, 0)]
        while todo:
            a, b, parent, side = todo.pop()
            own = f[order[a:b]]
            centre = own.mean(axis=0)
            radius = float(np.sqrt(((own - centre) ** 2).sum(axis=1).max()))
            spans.append([a, b, -1, -1])
            centres.append(centre)
            radii.append(radius)
            me = len(spans) - 1
            if parent >= 0:
                spans[parent][2 + side] = me
            if b - a > leaf and radius > 0:
                axis = int(own.var(axis=0).argmax())
                mid = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(own[:, axis], mid)]
                todo += [(a, a + mid, me, 0), (a + mid, b, me, 1)]
        self.order, self.spans, self.centres, self.radii = order, np.array(spans).reshape(-1, 4), np.array(centres), np.array(radii)

    def to_bytes(self) -> bytes:
        small = self.x.astype(np.int32) if len(self.x) and np.abs(self.x.astype(np.float64)).max() < 2**31 else self.x
        return packed(x=small, ids=self.ids, order=self.order, spans=self.spans, centres=self.centres, radii=self.radii)

    @classmethod
    def of_bytes(cls, data: bytes) -> BallTree:
        out = cls.__new__(cls)
        out.__dict__.update(unpacked(data))
        out.x = out.x.astype(np.int64)
        return out

    def search(self, queries: Queries) -> None:
        if not len(self.x) or not len(queries.x):
            return
        heap = [(0.0, 0, np.arange(len(queries.x)), np.full(len(queries.x), np.inf))]
        while heap:
            _, at, who, bound = heapq.heappop(heap)
            open_ = bound >= queries.kth[who]
            who = who[open_]
            if not len(who):
                continue
            a, b, left, right = self.spans[at]
            if left < 0:
                rows = self.order[a:b]
                queries.offer(who, self.ids[rows], self.x[rows])
                continue
            for child in (int(left), int(right)):
                centre, radius = self.centres[child], self.radii[child]
                norm = queries.norm[who]
                bound = queries.f[who] @ centre + norm * radius
                bound += 1e-9 * norm * (np.sqrt(centre @ centre) + radius) + 1e-6  # rounding
                heapq.heappush(heap, (-float(bound.max()), child, who, bound))


class Queries:
    """Queries with their best k so far; kth is the score below which a candidate cannot matter."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int, kth: np.ndarray | None = None):
        self.ids, self.x, self.k = ids, x, k
        self.f = x.astype(np.float64)
        self.norm = np.sqrt((self.f**2).sum(axis=1))
        self.least = np.full(len(ids), -np.inf) if kth is None else kth.astype(np.float64)
        self.kth = self.least.copy()
        self.best = np.full((len(ids), k), LOWEST, dtype=np.int64)
        self.best_ids = np.full((len(ids), k), NO_ID, dtype=np.int64)
        self.filled = np.zeros((len(ids), k), dtype=bool)

    def offer(self, who: np.ndarray, ids: np.ndarray, x: np.ndarray) -> None:
        most = float(np.abs(self.f[who]).max(initial=0)) * float(np.abs(x.astype(np.float64)).max(initial=0)) * max(1, x.shape[1])
        if most < 2**53:
            got = np.rint(self.f[who] @ x.astype(np.float64).T).astype(np.int64)
        else:  # sums that doubles do not hold exactly
            got = np.clip(self.x[who].astype(object) @ x.astype(object).T, LOWEST, NO_ID).astype(np.int64)
        fine = ids[None, :] != self.ids[who][:, None]
        scores = np.concatenate([self.best[who], np.where(fine, got, LOWEST)], axis=1)
        owners = np.concatenate([self.best_ids[who], np.broadcast_to(ids, got.shape)], axis=1)
        real = np.concatenate([self.filled[who], fine], axis=1)
        top = np.lexsort((owners, -scores.astype(np.float64) if most < 2**53 else _descending(scores), ~real), axis=-1)[:, : self.k]
        self.best[who] = np.take_along_axis(scores, top, 1)
        self.best_ids[who] = np.take_along_axis(owners, top, 1)
        self.filled[who] = np.take_along_axis(real, top, 1)
        last = np.where(self.filled[who][:, -1], self.best[who][:, -1].astype(np.float64), -np.inf)
        self.kth[who] = np.maximum(self.least[who], last)

    def result(self, block: int) -> pd.DataFrame:
        worth = self.filled & (self.best >= np.where(np.isinf(self.least), LOWEST, self.least)[:, None])
        row, col = np.nonzero(worth)
        return pd.DataFrame({"block": block, "q": row.astype(np.int32), "query_id": self.ids[row], "vec_id": self.best_ids[row, col], "score": self.best[row, col]})


def _descending(scores: np.ndarray) -> np.ndarray:
    return ~scores  # -x - 1 keeps the order and does not overflow


def _of_size(frames, size: int):
    """Runs of rows with vectors of one length: (ids, vectors), ``size`` rows at most."""
    held: dict[int, list[tuple]] = {}
    for f in frames:
        for i, v in zip(f["vec_id"], f["v"], strict=True):
            own = held.setdefault(len(v), [])
            own.append((i, v))
            if len(own) == size:
                yield np.array([i for i, _ in own]), np.stack([v for _, v in own])
                del held[len(v)]
    for own in held.values():
        yield np.array([i for i, _ in own]), np.stack([v for _, v in own])


def usable(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """vec_id, v: floor(scale * x) of each component, of the vectors without null or non-finite components."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    fine = F.col("d").isNotNull() & (F.size("d") > 0) & F.forall("d", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("d")).filter(F.coalesce(fine, F.lit(False)))
    return rows.select(F.coalesce("id", F.lit(NO_ID)).alias("vec_id"), F.transform("d", lambda x: F.floor(x * scale).cast("long")).alias("v"))


def top_k(
    vectors: DataFrame,
    every: int = 100,
    k: int = 10,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: float = 1024.0,
    shard_rows: int = 4096,
    leaf: int = 64,
    block: int = 4096,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best by integer inner product of each query.

    Queries are the rows whose id is divisible by ``every``, in blocks of about ``block``; the
    candidates of a query are all rows with another id and a vector of the same length (all of
    them if fewer than k). Ties go to the smaller id; rows without an id are candidates, last in
    ties, and never queries. Null and empty vectors and those with null or non-finite components
    take no part; scores beyond 64 bits are cut to them; a query among repeated rows is answered once per row. No rows give no rows.
    """
    spark = ship(vectors.sparkSession)
    rows = usable(vectors, id_col, vector_col, scale)
    asks = (F.col("vec_id") % every == 0) & (F.col("vec_id") != NO_ID)
    n, n_queries = rows.agg(F.count(F.lit(1)), F.count_if(asks)).first()
    if not n_queries:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    place = F.xxhash64("vec_id", "v", F.lit(b"q"))
    sample = rows.filter(F.pmod(F.xxhash64("vec_id", "v"), F.lit(max(1, n // shard_rows))) == 0).limit(shard_rows)
    pilot = spark.sparkContext.broadcast([BallTree(i, x, leaf) for i, x in _of_size([sample.toPandas()], shard_rows)])  # shard_rows vectors at most

    def trees(frames):
        for i, x in _of_size(frames, shard_rows):
            yield pd.DataFrame({"length": [x.shape[1]], "tree": [BallTree(i, x, leaf).to_bytes()]})

    def blocks(frames):
        for i, x in _of_size(frames, block):
            own = Queries(i, x, k)
            for t in pilot.value:
                if t.x.shape[1] == x.shape[1]:
                    t.search(own)
            kth = np.where(own.filled[:, -1], own.best[:, -1].astype(np.float64), -np.inf)
            yield pd.DataFrame({"length": [x.shape[1]], "asked": [packed(ids=i, x=x, kth=kth)]})

    def search(batches):
        now, own = None, None
        for b in batches:
            for number, asked, tree in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
                if number != now:
                    if own is not None:
                        yield pa.RecordBatch.from_pandas(own.result(now), schema=out, preserve_index=False)
                    q = unpacked(asked.as_py())
                    now, own = number, Queries(q["ids"], q["x"], k, q["kth"])
                BallTree.of_bytes(tree.as_py()).search(own)
        if own is not None:
            yield pa.RecordBatch.from_pandas(own.result(now), schema=out, preserve_index=False)

    out = pa.schema([("block", pa.int32()), ("q", pa.int32()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
    shards = max(1, -(-n // shard_rows))
    made = cut(rows.repartition(shards, F.xxhash64("vec_id", "v")).mapInPandas(trees, "length int, tree binary"))
    given = cut(rows.filter(asks).repartition(max(1, -(-n_queries // block)), place).mapInPandas(blocks, "length int, asked binary"))
    number = given.select("length", "asked", F.monotonically_increasing_id().alias("m"))
    numbered = cut(number.withColumn("block", F.row_number().over(Window.orderBy("m"))).drop("m"))  # one row a block
    n_blocks = numbered.count()
    # every tree meets every block of its length; a block lies in as many slots as keep all tasks busy
    slots = max(1, min(shards, -(-2 * spark.sparkContext.defaultParallelism // n_blocks)))
    each = F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))
    trees_in = made.withColumn("slot", F.pmod(F.monotonically_increasing_id() + F.spark_partition_id(), F.lit(slots)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(1), F.lit(n_blocks))))
    pairs = numbered.withColumn("slot", each).repartition(n_blocks * slots, "block", "slot").join(trees_in.hint("merge"), ["block", "slot", "length"])
    found = pairs.select("block", "asked", "tree").mapInArrow(search, RESULT)
    best = Window.partitionBy("block", "q").orderBy(F.desc("score"), F.asc("vec_id"))
    top = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return top.select("query_id", "rank", F.when(F.col("vec_id") != NO_ID, F.col("vec_id")).alias("vec_id"), "score")
