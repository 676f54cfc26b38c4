"""From a count matrix to a clustered bundle: the analysis chain as one plan."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import expression, layout, leiden, neighbours, sparse_pca
from ..session import cut
from ..sources import tables
from .stages import ClusterSettings


@dataclass
class Clustered:
    """x: cell, gene, value (all genes); obs: cell, total, cluster, pc, x, y; var: gene, mean, var, norm_var, place, loading; edges: a, b, weight."""

    x: DataFrame
    obs: DataFrame
    var: DataFrame
    edges: DataFrame
    notes: dict

    def write(self, folder: str) -> None:
        tables.write_bundle(folder, self.x, self.obs, self.var, self.notes)
        self.edges.write.mode("overwrite").parquet(f"{folder}/edges")


def clustered(
    matrix: DataFrame,
    settings: ClusterSettings = ClusterSettings(),
    cell: str = "cell",
    gene: str = "gene",
    n: str = "n",
    iterations: int = 2,
    place: bool = True,
    search: Callable = neighbours.nearest,
) -> Clustered:
    """``matrix``: cell (long), gene, n, one row a pair. Cells below ``min_counts`` go; values are normalised to 10,000
    and logged; the genes with the largest stabilised variance are scaled (at most 10) and give the
    components, whose neighbours (the cell itself counts as one) give the graph, its Leiden clusters and, with ``place``, its layout. ``search`` finds the neighbours: exactly, or
    ``descent.descend`` for many cells.

    A cell without a stored value among those genes has the coordinates of an all-zero row. Fewer
    cells than neighbours: all others are neighbours. A lone cell has no edge, and null for cluster, x and y.
    """
    s = settings
    totals = cut(matrix.groupBy(cell).agg(F.sum(n).alias("total")).filter(F.col("total") >= (s.min_counts or 0)))
    kept = matrix.select(cell, gene, n).join(totals.select(cell), cell)
    cells = totals.count()
    values = cut(expression.log_normalise(kept, cell=cell, n=n))
    top = cut(expression.stabilised_genes(values, cells, s.variable_genes, cell=cell, gene=gene))
    own = expression.gene_subset(values, top, gene)
    stats = cut(top.select(gene, "mean", "var"))
    scaled, zeros = expression.scale(own, stats, 10.0, gene)
    places = cut(sparse_pca.gene_places(top, gene))
    rows = cut(sparse_pca.sparse_rows(scaled.select(cell, gene, "z"), zeros, totals, places, cell, gene))
    genes = places.count()
    k = max(1, min(s.n_pcs, genes, cells - 1))
    mean, comp, variances, whole = sparse_pca.sparse_components(rows, genes, k, seed=s.seed)
    scores = cut(sparse_pca.sparse_scores(rows, mean, comp, cell))
    near = search(scores, s.neighbours - 1, key=cell, vector="pc")
    edges = cut(neighbours.fuzzy_weights(near, s.neighbours))
    clusters = leiden.leiden(edges, s.resolution, iterations=iterations, seed=s.seed).withColumnRenamed("a", cell)
    obs = totals.join(scores, cell).join(clusters, cell, "left")
    if place:
        obs = obs.join(layout.layout(edges, seed=s.seed).withColumnRenamed("a", cell), cell, "left")
    else:
        obs = obs.withColumns({c: F.lit(None).cast("double") for c in "xy"})
    # one row a gene
    loads = matrix.sparkSession.createDataFrame([(i, [float(x) for x in comp[:, i]]) for i in range(genes)], "ix int, loading array<double>")
    var = top.join(places.join(loads, "ix").drop("ix"), gene)
    notes = {"settings": dataclasses.asdict(s), "variances": [float(x) for x in variances], "variance": float(whole), "cells": cells, "genes": genes}
    return Clustered(values, obs, var, edges, notes)


def explained(notes: dict) -> np.ndarray:
    """Share of the total variance that each component has."""
    return np.array(notes["variances"]) / (notes["variance"] or 1.0)
