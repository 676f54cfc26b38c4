"""A layout of a neighbour graph in the plane: a spectral start, then rounds of attraction and repulsion.

As in UMAP (McInnes et al., 2018), points that share an edge are drawn together and sampled others
pushed apart. Points are moved block by block: in a round every block of points sees where all others
were at its start, moves its own by several steps, and is repelled by the points of one other block,
which changes from round to round. A round is one job; the result depends on the seed alone.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Scratch, ship

#: Edges a point takes part in by round, in the mean, at most.
EDGES = 64
#: First step size. All edges of a point act at once, so it is below the 1 of methods that take them one by one.
RATE = 0.1


def curve(min_dist: float, spread: float) -> tuple[float, float]:
    """(a, b) of 1 / (1 + a d^(2b)), fitted to 1 up to ``min_dist`` and an exponential of ``spread`` beyond it."""
    x = np.linspace(1e-3, 3 * spread, 300)
    y = np.where(x < min_dist, 1.0, np.exp(-(x - min_dist) / spread))
    p, damp = np.zeros(2), 1e-2  # logarithms of a and b

    def off(q: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(q[0]) * x ** (2 * np.exp(q[1]))) - y

    for _ in range(200):
        r = off(p)
        jac = np.stack([(off(p + h) - r) / 1e-6 for h in np.eye(2) * 1e-6], 1)
        step = np.linalg.solve(jac.T @ jac + damp * np.eye(2), -jac.T @ r)
        better = (off(p + step) ** 2).sum() < (r**2).sum()
        p, damp = (p + step, damp / 3) if better else (p, damp * 4)
    return float(np.exp(p[0])), float(np.exp(p[1]))


def spectral_start(edges: DataFrame, kept: Scratch, rounds: int = 24, seed: int = 0) -> DataFrame:
    """a, x, y: the second and third eigenvectors of the graph's normalised adjacency, by subspace iteration; 10 units wide.

    A round is one join over the edges; the 3 by 3 sums of products that keep the vectors apart come from the same job.
    """
    degree = kept.put(edges.groupBy("a").agg(F.sum("weight").alias("k")))
    ends = degree.select(F.col("a").alias("b"), F.col("k").alias("kb"))
    norm = kept.put(edges.join(degree, "a").join(ends, "b").select("a", "b", (F.col("weight") / F.sqrt(F.col("k") * F.col("kb"))).alias("w")))
    noise = [(F.xxhash64("a", F.lit(seed + i)) / F.lit(2.0**63)).alias(f"v{i}") for i in (1, 2)]
    now = degree.select("a", F.sqrt("k").alias("v0"), *noise)
    products = [F.sum(F.col(f"v{i}") * F.col(f"v{j}")).alias(f"p{i}{j}") for i in range(3) for j in range(i, 3)]
    now, seen = kept.put_seen(now, *products)
    for _ in range(rounds):
        gram = np.array([[seen[f"p{min(i, j)}{max(i, j)}"] for j in range(3)] for i in range(3)])
        # columns of the inverse root of the sums, from first to third: what is orthonormal after it
        turn = np.linalg.inv(np.linalg.cholesky(gram + 1e-12 * np.trace(gram) * np.eye(3))).T
        own = [sum((F.col(f"v{i}") * float(turn[i, j]) for i in range(j + 1)), F.lit(0.0)).alias(f"v{j}") for j in range(3)]
        straight = now.select("a", *own)
        # half of itself keeps negative eigenvalues from winning
        there = norm.join(straight.withColumnRenamed("a", "b"), "b").select("a", *[(F.col("w") * F.col(f"v{i}") / 2).alias(f"v{i}") for i in range(3)])
        both = there.unionByName(straight.select("a", *[(F.col(f"v{i}") / 2).alias(f"v{i}") for i in range(3)]))
        now, seen = kept.put_seen(both.groupBy("a").agg(*[F.sum(f"v{i}").alias(f"v{i}") for i in range(3)]), *products)
    plain = kept.put(now.join(degree, "a").select("a", *[(F.col(f"v{i}") / F.col("v0")).alias(c) for i, c in ((1, "x"), (2, "y"))]))
    top = plain.agg(*[F.max(F.abs(F.col(c))).alias(c) for c in "xy"]).first()
    jitter = [(F.xxhash64("a", F.lit(seed + i)) / F.lit(2.0**63) * 1e-3) for i in (7, 8)]
    return plain.select("a", *[(F.col(c) * (5.0 / (top[c] or 1.0)) + j).alias(c) for c, j in zip("xy", jitter, strict=True)])


def _moves(a: float, b: float, steps: int, rate: float, negatives: int, seed: int):
    """Task body: the points of a block (kind 0) with what draws them (1) and what pushes them (2)."""

    def run(f: pd.DataFrame) -> pd.DataFrame:
        own, drawn, far = (f[f["kind"] == k] for k in (0, 1, 2))
        own = own.sort_values("a")
        ids = own["a"].to_numpy()
        p = own[["x", "y"]].to_numpy().copy()
        drawn = drawn.sort_values(["a", "x", "y"])
        i, to = np.searchsorted(ids, drawn["a"].to_numpy()), drawn[["x", "y"]].to_numpy()
        others = far.sort_values(["x", "y"])[["x", "y"]].to_numpy()
        r = np.random.default_rng((seed, int(ids[0]) & 0x7FFFFFFF)) if len(ids) else None
        for s in range(steps):
            step = rate * (1 - s / steps / 2)
            d = p[i] - to
            d2 = (d * d).sum(1)
            with np.errstate(divide="ignore", invalid="ignore"):
                pull = np.where(d2 > 0, -2 * a * b * d2 ** (b - 1) / (1 + a * d2**b), 0.0)
            move = np.zeros_like(p)
            np.add.at(move, i, np.clip(pull[:, None] * d, -4, 4))
            if len(others):
                for _ in range(negatives):
                    d = p - others[r.integers(0, len(others), len(p))]
                    d2 = (d * d).sum(1)
                    push = np.where(d2 > 0, 2 * b / ((0.001 + d2) * (1 + a * d2**b)), 0.0)
                    move += np.clip(push[:, None] * d, -4, 4)
            p += step * move
        return pd.DataFrame({"a": ids, "x": p[:, 0], "y": p[:, 1]})

    return run


def layout(
    edges: DataFrame,
    min_dist: float = 0.5,
    spread: float = 1.0,
    rounds: int = 16,
    steps: int = 6,
    negatives: int = 5,
    block: int = 2000,
    seed: int = 0,
    start: DataFrame | None = None,
) -> DataFrame:
    """a, x, y: a place for every node of a symmetric graph (a, b, weight up to 1; loops are left out).

    ``start``: a, x, y to begin with, in place of the spectral start. In a round an edge draws with the
    probability of its weight, and less at a node of more than 64 such edges, by a hash of its ends and the round; so no
    node brings more edges to a block than that in the mean. No edges give no rows.
    """
    spark = ship(edges.sparkSession)
    kept = Scratch(spark, "layout")
    graph = kept.put(edges.filter("a != b").groupBy("a", "b").agg(F.max("weight").alias("weight")))
    if graph.isEmpty():
        return spark.createDataFrame([], f"a {edges.schema['a'].dataType.simpleString()}, x double, y double")
    weights = graph.groupBy("a").agg(F.sum("weight").alias("k"))
    chance = F.least(F.lit(1.0), F.col("weight")) * F.least(F.lit(1.0), F.lit(float(EDGES)) / F.col("k"))
    ranked = kept.put(graph.join(weights, "a").select("a", "b", chance.alias("chance")))
    places = kept.put(start.select("a", "x", "y") if start is not None else spectral_start(graph, kept, seed=seed))
    a, b = curve(min_dist, spread)
    blocks = max(1, math.ceil(places.count() / block))
    slot = F.pmod(F.xxhash64("a", F.lit(seed)), F.lit(blocks)).cast("int")
    schema = f"a {edges.schema['a'].dataType.simpleString()}, x double, y double"
    for r in range(rounds):
        uniform = F.pmod(F.xxhash64("a", "b", F.lit(seed + r)), F.lit(1 << 30)) / F.lit(float(1 << 30))
        drawn = ranked.filter(uniform < F.col("chance")).select("a", "b").join(places.withColumnRenamed("a", "b"), "b")
        drawn = drawn.select(slot.alias("i"), F.lit(1).alias("kind"), "a", "x", "y")
        own = places.select(slot.alias("i"), F.lit(0).alias("kind"), "a", "x", "y")
        far = places.select(F.pmod(slot + F.lit(1 + r), F.lit(blocks)).cast("int").alias("i"), F.lit(2).alias("kind"), "a", "x", "y")
        moves = _moves(a, b, steps, RATE * (1 - r / rounds), negatives, seed + r)
        places = kept.put(own.unionByName(drawn).unionByName(far).groupBy("i").applyInPandas(moves, schema))
    kept.drop_before(1)
    return places
