"""Principal components of a scaled sparse matrix, without ever making it dense.

The matrix has a value z for every stored cell and gene and the gene's z0 elsewhere. Written as
S + 1 z0' with S = z - z0 where a value is stored, its centred form is S - 1 m' with m the column
means of S: z0 cancels, and what is not stored stays out of every sum. Components come from
subspace iteration: a pass takes each row s to y = s V - m' V and adds s' y up, gene by gene.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship

#: Genes whose sums travel together.
CHUNK = 64
#: Numbers of a dense block of rows that a task makes at a time.
BLOCK = 4_000_000


def gene_places(genes: DataFrame, gene: str = "gene") -> DataFrame:
    """gene, ix: places from 0 of a list of genes (one row each), by gene."""
    return genes.select(gene).distinct().select(gene, (F.row_number().over(Window.orderBy(gene)) - 1).cast("int").alias("ix"))


def sparse_rows(scaled: DataFrame, zeros: DataFrame, cells: DataFrame, places: DataFrame, cell: str = "cell", gene: str = "gene") -> DataFrame:
    """cell, ix, s: one row for every cell of ``cells``, its stored places in order and z - z0 there.

    ``scaled``: cell, gene, z; ``zeros``: gene, z0. Cells without a stored value have empty arrays;
    values of cells or genes that are not listed are left out. A row holds no more than the genes listed.
    """
    own = scaled.join(zeros.join(places, gene), gene).select(cell, F.struct("ix", (F.col("z") - F.col("z0")).alias("s")).alias("e"))
    rows = own.groupBy(cell).agg(F.sort_array(F.collect_list("e")).alias("e"))
    listed = cells.select(cell).distinct().join(rows, cell, "left")
    none = F.array().cast("array<struct<ix:int,s:double>>")
    return listed.withColumn("e", F.coalesce("e", none)).select(cell, F.col("e.ix").alias("ix"), F.col("e.s").alias("s"))


def _dense(batch: pa.RecordBatch, n: int):
    """Dense blocks of the rows of a batch (its last two columns are ix and s), and where each begins."""
    step = max(1, BLOCK // max(1, n))
    for a in range(0, batch.num_rows, step):
        part = batch.slice(a, step)
        ix, s = part.column(part.num_columns - 2), part.column(part.num_columns - 1)
        x = np.zeros((part.num_rows, n))
        row = np.repeat(np.arange(part.num_rows), np.diff(np.asarray(ix.offsets)))
        x[row, np.asarray(ix.flatten())] = np.asarray(s.flatten())
        yield a, x


def _pass(rows: DataFrame, v: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """X' X v for the centred matrix X: tasks add up their rows, chunks of genes are added up across tasks."""
    n, width = v.shape
    shared = ship(rows.sparkSession).sparkContext.broadcast((v, mean))  # genes listed times components

    def run(batches):
        own, m = shared.value
        shift = m @ own
        z, total = np.zeros((n, width)), np.zeros(width)
        seen = False
        for b in batches:
            for _, x in _dense(b, n):
                y = x @ own - shift
                z += x.T @ y
                total += y.sum(0)
                seen = True
        if seen:
            z -= np.outer(m, total)
            at = list(range(0, n, CHUNK))
            yield pa.RecordBatch.from_pydict({"chunk": pa.array([a // CHUNK for a in at], pa.int32()), "z": pa.array([z[a : a + CHUNK].tobytes() for a in at], pa.binary())})

    def add(f: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"chunk": [f["chunk"].iloc[0]], "z": [sum(np.frombuffer(x) for x in f["z"]).tobytes()]})

    told = rows.select("ix", "s").mapInArrow(run, "chunk int, z binary").groupBy("chunk").applyInPandas(add, "chunk int, z binary").toPandas().sort_values("chunk")
    return np.concatenate([np.frombuffer(x).reshape(-1, width) for x in told["z"]])


def sparse_components(rows: DataFrame, n_genes: int, k: int, passes: int = 8, extra: int = 10, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """(mean, components, variances, total variance) of ``rows`` (cell, ix, s); components are rows, the largest entry of each positive.

    What the driver and every task hold is genes times (k + extra) numbers, whatever the number of
    cells. With k + extra genes or fewer the result is exact after one pass. Without cells, or with
    fewer than two, variances are 0.
    """
    stored = rows.select(F.explode(F.arrays_zip("ix", "s")).alias("e")).select("e.ix", "e.s")
    sums = stored.groupBy("ix").agg(F.sum("s").alias("s"), F.sum(F.col("s") * F.col("s")).alias("q")).toPandas()  # one row a gene
    n = rows.count()
    mean, square = np.zeros(n_genes), np.zeros(n_genes)
    mean[sums["ix"]], square[sums["ix"]] = sums["s"] / max(1, n), sums["q"]
    width = min(n_genes, k + extra)
    k = min(k, width)
    if n < 2:
        return mean, np.eye(n_genes)[:k], np.zeros(k), 0.0
    total = float((square - n * mean * mean).sum() / (n - 1))
    v = np.linalg.qr(np.random.default_rng(seed).standard_normal((n_genes, width)))[0]
    for p in range(1 if width == n_genes else passes):
        if p:
            v = np.linalg.qr(z)[0]
        z = _pass(rows, v, mean)
    small = v.T @ z
    values, turn = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(values)[::-1][:k]
    comp = (v @ turn[:, order]).T
    comp *= np.where(comp[np.arange(k), np.abs(comp).argmax(axis=1)] < 0, -1, 1)[:, None]
    return mean, comp, np.maximum(values[order], 0) / (n - 1), total


def sparse_scores(rows: DataFrame, mean: np.ndarray, components: np.ndarray, cell: str = "cell") -> DataFrame:
    """cell, pc: coordinates of each row along the components."""
    shared = ship(rows.sparkSession).sparkContext.broadcast((mean, components))

    def run(batches):
        m, c = shared.value
        for b in batches:
            if b.num_rows:
                y = np.concatenate([x @ c.T - m @ c.T for _, x in _dense(b, len(m))])
                listed = pa.ListArray.from_arrays(pa.array(np.arange(0, y.size + 1, len(c)), pa.int32()), pa.array(y.ravel()))
                yield pa.RecordBatch.from_arrays([b.column(0), listed], names=["cell", "pc"])

    kind = rows.schema[cell].dataType.simpleString()
    return rows.select(F.col(cell).alias("cell"), "ix", "s").mapInArrow(run, f"cell {kind}, pc array<double>").withColumnRenamed("cell", cell)
