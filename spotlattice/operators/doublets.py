"""Doublets from counts: simulated pairs of cells, their place among real ones, and a threshold where the simulated scores part.

A simulated doublet is the sum of two cells' counts, gene by gene, in the long table. Components are
those of the real cells; simulated ones are projected on them. A cell's score is the posterior chance
of being a doublet, given the share of simulated ones among its neighbours (Wolock et al., 2019).
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut
from . import expression, sparse_pca
from .neighbours import nearest_tally

BINS = 256


def cell_pairs(cells: DataFrame, n: int, ratio: int, seed: int, cell: str = "cell") -> DataFrame:
    """id (below 0), left, right: about ``ratio`` pairs for each cell, chosen by hashes; a cell is in two pairs of a round at most."""
    dealt = cells.select(F.col(cell).alias("c"), F.explode(F.sequence(F.lit(0), F.lit(ratio - 1))).alias("r"))
    slot = F.pmod(F.xxhash64("c", "r", F.lit(seed)), F.lit(max(1, n // 8)))  # some eight cells
    w = Window.partitionBy("r", "slot").orderBy(F.xxhash64("c", "r", F.lit(seed + 1)), "c")
    p = dealt.withColumn("slot", slot).withColumn("right", F.coalesce(F.lead("c").over(w), F.first("c").over(w)))
    name = F.xxhash64("r", "c", "right", F.lit(seed))
    return p.filter("c != right").select((-1 - F.abs(name % (1 << 60))).alias("id"), F.col("c").alias("left"), "right").dropDuplicates(["id"])


def simulated(matrix: DataFrame, pairs: DataFrame, cell: str = "cell", gene: str = "gene", n: str = "n") -> DataFrame:
    """cell (the pair's id), gene, n: counts of both cells of each pair added up."""
    ends = pairs.select("id", F.explode(F.array("left", "right")).alias(cell))
    return matrix.join(ends, cell).groupBy(F.col("id").alias(cell), gene).agg(F.sum(n).alias(n))


def valley(counts: np.ndarray, most: int = 10_000) -> int | None:
    """The bin of the least count between the two highest of a histogram that is smoothed until it has two; None if it never has."""
    h = counts.astype(float)
    for _ in range(most):
        up = np.flatnonzero((h[1:-1] > h[:-2]) & (h[1:-1] >= h[2:])) + 1
        tops = [*([0] if len(h) > 1 and h[0] > h[1] else []), *up.tolist(), *([len(h) - 1] if len(h) > 1 and h[-1] > h[-2] else [])]
        if len(tops) < 2:
            return None
        if len(tops) == 2:
            return tops[0] + int(h[tops[0] : tops[1] + 1].argmin())
        padded = np.pad(h, 1, mode="edge")
        h = (padded[:-2] + padded[1:-1] + padded[2:]) / 3
    return None


def doublet_calls(
    matrix: DataFrame,
    rate: float = 0.06,
    ratio: int = 2,
    k: int | None = None,
    n_pcs: int = 30,
    n_genes: int = 2000,
    seed: int = 0,
    least: int = 30,
    cell: str = "cell",
    gene: str = "gene",
    n: str = "n",
) -> tuple[DataFrame, float | None]:
    """(cell, doublet_score, doublet_call) of every cell (whole number, not below 0) with a count, and the threshold.

    ``k``: neighbours among real cells, by default half the root of their number. The threshold is
    the valley of the simulated scores' histogram (256 bins, which is what comes to the driver); where
    it has no two heights the threshold is None and nothing is called. Fewer than ``least`` cells say
    nothing about a valley and are not scored: null, not called.
    """
    matrix = cut(matrix.filter(F.col(n) > 0).select(cell, gene, n))
    totals = cut(matrix.groupBy(cell).agg(F.sum(n).alias(n)))
    cells = totals.select(cell)
    count = cells.count()
    if count < max(3, least):
        return cells.select(cell, F.lit(None).cast("double").alias("doublet_score"), F.lit(False).alias("doublet_call")), None
    pairs = cut(cell_pairs(cells, count, ratio, seed, cell))
    m = pairs.count()
    real = cut(expression.log_normalise(matrix, cell=cell, n=n))
    top = cut(expression.stabilised_genes(real, count, n_genes, cell=cell, gene=gene))
    # of a pair only the listed genes are looked at: its total is that of its cells
    made = simulated(expression.gene_subset(matrix, top, gene), pairs, cell, gene, n)
    both = pairs.select(F.col("id"), F.explode(F.array("left", "right")).alias(cell)).join(totals, cell).groupBy(F.col("id").alias(cell)).agg(F.sum(n).alias(n))
    values = expression.gene_subset(real, top, gene).unionByName(expression.log_normalise(made, cell=cell, n=n, totals=both))
    scaled, zeros = expression.scale(values, top.select(gene, "mean", "var"), 10.0, gene)
    places = cut(sparse_pca.gene_places(top, gene))
    genes = places.count()
    listed = cells.unionByName(pairs.select(F.col("id").alias(cell)))
    rows = cut(sparse_pca.sparse_rows(scaled.select(cell, gene, "z"), zeros, listed, places, cell, gene))
    mean, comp, _, _ = sparse_pca.sparse_components(rows.filter(F.col(cell) >= 0), genes, max(1, min(n_pcs, genes, count - 1)), seed=seed)
    scores = cut(sparse_pca.sparse_scores(rows, mean, comp, cell))
    r = m / count
    around = round((k or max(1, round(0.5 * math.sqrt(count)))) * (1 + r))
    near = nearest_tally(scores, around, F.col("b") < 0, key=cell, vector="pc")
    share = near.select("a", ((F.col("chosen") + 1.0) / (F.col("n") + 2.0)).alias("q"))
    score = F.col("q") * rate / r / ((1 - rate) - F.col("q") * (1 - rate - rate / r))
    scored = cut(share.select(F.col("a").alias(cell), score.alias("doublet_score")))
    made = scored.filter(F.col(cell) < 0)
    low, high = made.agg(F.min("doublet_score"), F.max("doublet_score")).first()
    limit = None
    if low is not None and high > low:
        place = F.least(F.floor((F.col("doublet_score") - low) / ((high - low) / BINS)), F.lit(BINS - 1)).cast("int")
        told = made.groupBy(place.alias("bin")).count().collect()
        h = np.zeros(BINS)
        h[[x["bin"] for x in told]] = [x["count"] for x in told]
        at = valley(h)
        limit = None if at is None else low + (at + 0.5) * (high - low) / BINS
    called = F.lit(False) if limit is None else F.coalesce(F.col("doublet_score") > limit, F.lit(False))
    own = cells.join(scored, cell, "left")
    return own.select(cell, "doublet_score", called.alias("doublet_call")), limit
