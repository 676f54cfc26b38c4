"""Expression values and their statistics, sparse: a cell and gene without a row is a zero."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut, dealt, ship


def log_normalise(matrix: DataFrame, target: float = 1e4, cell: str = "cell", n: str = "n", out: str = "value", totals: DataFrame | None = None) -> DataFrame:
    """ln(1 + n * target / total of the cell). ``totals`` (cell, n): where ``matrix`` does not hold all of a cell's counts."""
    matrix = dealt(matrix, cell)
    totals = (matrix.groupBy(cell).agg(F.sum(n).alias(n)) if totals is None else totals).select(cell, F.col(n).cast("double").alias("_t"))
    return matrix.join(totals, cell).withColumn(out, F.log1p(F.try_divide(F.col(n) * F.lit(float(target)), F.col("_t")))).drop("_t", n)


def gene_mean_var(values: DataFrame, n_cells: int, gene: str = "gene", value: str = "value") -> DataFrame:
    """Mean and sample variance over all cells, zeros included."""
    s = values.groupBy(gene).agg(F.sum(value).alias("s"), F.sum(F.col(value) * F.col(value)).alias("q"))
    mean = F.col("s") / n_cells
    return s.select(gene, mean.alias("mean"), F.greatest(F.lit(0.0), (F.col("q") - F.col("s") * mean) / max(1, n_cells - 1)).alias("var"))


def scale(values: DataFrame, stats: DataFrame, clip: float = 10.0, gene: str = "gene", value: str = "value") -> tuple[DataFrame, DataFrame]:
    """z-scores of the rows that exist, and per gene the z-score of its zeros."""
    sd = F.when(F.col("var") > 0, F.sqrt("var")).otherwise(F.lit(1.0))
    z = F.least(F.lit(clip), (F.col(value) - F.col("mean")) / sd)
    return values.join(stats, gene).withColumn("z", z).drop("mean", "var", value), stats.select(gene, F.least(F.lit(clip), -F.col("mean") / sd).alias("z0"))


def variable_genes(stats: DataFrame, n_top: int, bins: int = 20, gene: str = "gene") -> DataFrame:
    """The genes whose dispersion stands out most among genes of like mean; ties by gene.

    Genes are cut into ``bins`` of equal size by mean; the dispersion var / mean is compared with
    the mean and deviation of its bin (a bin without deviation counts as 1).
    """
    disp = F.coalesce(F.try_divide(F.col("var"), F.col("mean")), F.lit(0.0))
    b = stats.withColumn("dispersion", disp).withColumn("bin", F.ntile(bins).over(Window.orderBy("mean", gene)))  # one row a gene
    w = Window.partitionBy("bin")
    sd = F.stddev_samp("dispersion").over(w)
    norm = (F.col("dispersion") - F.avg("dispersion").over(w)) / F.when(sd > 0, sd).otherwise(F.lit(1.0))
    return b.withColumn("norm_dispersion", F.round(norm, 6)).orderBy(F.desc("norm_dispersion"), gene).limit(n_top).select(gene, "mean", "var", "norm_dispersion")


def wilcoxon(values: DataFrame, clusters: DataFrame, cell: str = "cell", gene: str = "gene", value: str = "value", cluster: str = "cluster", step: float = 1 / 32) -> DataFrame:
    """cluster, gene, z of the rank-sum test of each cluster against the rest; ties share mean ranks, without tie correction.

    ``clusters`` has one row a cell. Zeros are one tie below all (positive) values, so only stored
    values are ranked; genes without any are left out. Equal values of a cluster are counted before
    anything is ranked, so a tie is one row a cluster; a gene's values are dealt into ranges of
    ``step``, ranked there, and moved up by the counts of the ranges below, so a gene that every cell has is not one task.
    """
    sizes = clusters.groupBy(cluster).agg(F.count(F.lit(1)).cast("double").alias("size"))
    n = sizes.agg(F.sum("size").alias("cells"))
    v = values.filter(F.col(value) > 0).join(clusters.select(cell, cluster), cell)
    v = dealt(v.select(gene, F.floor(F.col(value) / step).alias("_b"), value, cluster), gene, "_b")
    tied = v.groupBy(gene, "_b", value, cluster).agg(F.count(F.lit(1)).cast("double").alias("_k"))
    by = Window.partitionBy(gene, "_b")
    upto = F.sum("_k").over(by.orderBy(value).rangeBetween(Window.unboundedPreceding, Window.currentRow))
    every_k = F.sum("_k").over(Window.partitionBy(gene, "_b", value))
    inside = tied.select(gene, "_b", cluster, "_k", (F.col("_k") * (upto - (every_k - 1) / 2)).alias("_r"))
    ranges = dealt(inside.groupBy(gene, "_b", cluster).agg(F.sum("_r").alias("_r"), F.sum("_k").alias("_k")), gene)
    own = Window.partitionBy(gene)
    below = F.coalesce(F.sum("_k").over(own.orderBy("_b").rangeBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    moved = ranges.select(gene, cluster, "_k", (F.col("_r") + below * F.col("_k")).alias("_r"), F.sum("_k").over(own).alias("stored"))
    sums = moved.groupBy(gene, cluster).agg(F.sum("_r").alias("r"), F.sum("_k").alias("k"), F.first("stored").alias("stored"))
    # one entry a cluster
    entry = F.when(F.col(cluster).isNotNull(), F.struct(cluster, F.struct("r", "k")))
    genes = sums.groupBy(gene).agg(F.first("stored").alias("stored"), F.map_from_entries(F.collect_list(entry)).alias("_own"))
    every = genes.crossJoin(F.broadcast(sizes.crossJoin(n))).withColumn("_o", F.try_element_at("_own", F.col(cluster))).select("*", "_o.r", "_o.k")
    zeros = F.col("cells") - F.col("stored")
    k = F.coalesce("k", F.lit(0.0))
    total = F.coalesce("r", F.lit(0.0)) + k * zeros + (F.col("size") - k) * (zeros + 1) / 2
    rest = F.col("cells") - F.col("size")
    sd = F.sqrt(F.col("size") * rest * (F.col("cells") + 1) / 12)
    return every.select(cluster, gene, F.try_divide(total - F.col("size") * (F.col("cells") + 1) / 2, sd).alias("z"))


def top_markers(tests: DataFrame, n: int = 100, cluster: str = "cluster", gene: str = "gene", score: str = "z") -> DataFrame:
    place = F.row_number().over(Window.partitionBy(cluster).orderBy(F.desc(score), gene))
    return tests.withColumn("place", place).filter(F.col("place") <= n)


def adjust(tests: DataFrame, p: str, cluster: str = "cluster", gene: str = "gene", out: str = "p_adj") -> DataFrame:
    """Benjamini-Hochberg within each cluster: from the largest p down, the least of p * m / rank.

    Equal p have the result of the last of them, so only different p are ranked, in 1,024 ranges of p
    that counts and least values of the others are handed to; no task holds a cluster.
    """
    tests = cut(tests)  # read twice
    each = tests.groupBy(cluster, p).agg(F.count(F.lit(1)).alias("_n")).withColumn("_b", F.coalesce(F.floor(F.col(p) * 1024), F.lit(-1)))
    own, range_ = Window.partitionBy(cluster), Window.partitionBy(cluster, "_b")
    before = own.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    sizes = each.groupBy(cluster, "_b").agg(F.sum("_n").alias("_all"), F.sum(F.when(F.col(p).isNotNull(), F.col("_n"))).alias("_m"))
    sizes = sizes.select(F.col(cluster).alias("_c"), F.col("_b").alias("_at"), F.coalesce(F.sum("_all").over(before), F.lit(0)).alias("_below"), F.coalesce(F.sum("_m").over(own), F.lit(0)).alias("_m"))
    ranked = each.join(sizes, F.col(cluster).eqNullSafe(F.col("_c")) & (F.col("_b") == F.col("_at"))).drop("_c", "_at")
    rank = F.col("_below") + F.sum("_n").over(range_.orderBy(p).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    q = ranked.withColumn("_q", F.col(p) * F.col("_m") / rank)
    q = q.withColumn("_q", F.min("_q").over(range_.orderBy(F.desc(p)).rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    least = q.groupBy(cluster, "_b").agg(F.min("_q").alias("_least"))
    after = F.min("_least").over(own.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1))
    least = least.select(F.col(cluster).alias("_c"), F.col("_b").alias("_at"), after.alias("_after"))
    done = q.join(least, F.col(cluster).eqNullSafe(F.col("_c")) & (F.col("_b") == F.col("_at")))
    done = done.select(F.col(cluster).alias("_c"), F.col(p).alias("_p"), F.least(F.lit(1.0), "_q", "_after").alias(out))
    return tests.join(done, F.col(cluster).eqNullSafe(F.col("_c")) & F.col(p).eqNullSafe(F.col("_p"))).drop("_c", "_p")


def two_sided_p(z: Column) -> Column:
    """Two-sided normal p-value; null for null."""

    def tail(v: pd.Series) -> pd.Series:
        return v.map(lambda x: math.erfc(abs(x) / math.sqrt(2)), na_action="ignore")

    ship(SparkSession.getActiveSession())
    return F.pandas_udf(tail, "double")(z)


def local_trend(x: np.ndarray, y: np.ndarray, span: float = 0.3, knots: int = 400) -> np.ndarray:
    """Local quadratic fit of y on x with tricube weights over the nearest ``span`` of the points, at quantile knots, interpolated between."""
    order = np.argsort(x, kind="stable")
    xs, ys, n = x[order], y[order], len(x)
    k = min(n, max(4, int(np.ceil(span * n))))
    at = np.unique(np.quantile(xs, np.linspace(0, 1, min(knots, n))))
    fitted = np.empty(len(at))
    for i, c in enumerate(at):
        a = int(np.clip(np.searchsorted(xs, c) - k // 2, 0, n - k))
        while a > 0 and c - xs[a - 1] < xs[a + k - 1] - c:
            a -= 1
        while a + k < n and xs[a + k] - c < c - xs[a]:
            a += 1
        px, py = xs[a : a + k] - c, ys[a : a + k]
        far = np.abs(px).max() or 1.0
        w = np.sqrt((1 - np.minimum(np.abs(px) / far, 1) ** 3) ** 3 + 1e-12)
        fitted[i] = np.linalg.lstsq(np.stack([np.ones(k), px, px * px], 1) * w[:, None], py * w, rcond=None)[0][0]
    return np.interp(x, at, fitted)


def _columns(batches) -> list[np.ndarray]:
    """What a task is given: x, y of its points in order, and how many rows each stands for."""
    got = [[np.asarray(c) for c in b.columns] for b in batches]
    mean, var, n = (np.concatenate([g[i] for g in got] or [np.zeros(0)]) for i in range(3))
    return [np.log10(mean), np.log10(var), n.astype(np.int64)]


def _lines(points: DataFrame, body) -> dict[int, np.ndarray]:
    """``body`` (part, x, y, n) to an array of doubles, once a part of ``points``; by part. What comes to the driver is one array a part."""

    def run(batches):
        part = TaskContext.get().partitionId()
        told = np.asarray(body(part, *_columns(batches)), np.float64)
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "told": pa.array([told.tobytes()], pa.binary())})

    return {r.part: np.frombuffer(r.told) for r in points.mapInArrow(run, "part int, told binary").collect()}


def trend_knots(stats: DataFrame, span: float = 0.3, knots: int = 400, fan: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Knots and fitted values of ``local_trend`` over log10 of ``mean`` and ``var`` (both above 0) of all rows, which stay distributed.

    Points are put in order by ranges of their mean, so values are found by their rank. The window of a
    knot is sought by rank, ``fan`` places a round for all knots at once; a fit needs no more of a task than
    the triangle (QR) of its points in the window. The driver holds some numbers for each knot and part.
    """
    spark = ship(stats.sparkSession)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    each = stats.groupBy("mean", "var").agg(F.count(F.lit(1)).alias("n"))
    points = cut(each.repartitionByRange(parts, "mean", "var").sortWithinPartitions("mean", "var").select("mean", "var", "n"))
    held = _lines(points, lambda part, x, y, n: [n.sum()])
    starts = {part: int(sum(held[q][0] for q in held if q < part)) for part in held}
    rows = int(sum(h[0] for h in held.values()))

    def at_rank(ranks: np.ndarray) -> np.ndarray:
        wanted = np.unique(ranks)
        shared = spark.sparkContext.broadcast((wanted, starts))

        def own(part, x, y, n):
            want, begin = shared.value
            upto = begin[part] + np.cumsum(n)
            here = want[np.searchsorted(want, begin[part]) : np.searchsorted(want, upto[-1])] if len(n) else want[:0]
            return x[np.searchsorted(upto, here, side="right")]

        told = _lines(points, own)
        return np.concatenate([told[q] for q in sorted(told)])[np.searchsorted(wanted, ranks)]

    place = np.linspace(0, 1, min(knots, rows)) * (rows - 1)
    low = np.floor(place).astype(np.int64)
    a, b = at_rank(np.stack([low, np.minimum(low + 1, rows - 1)]))
    t = place - low
    at = np.unique(np.where(t >= 0.5, b - (b - a) * (1 - t), a + (b - a) * t))
    # of the windows of k points the first that reaches as far up as down; far is the reach of the best
    k = min(rows, max(4, int(np.ceil(span * rows))))
    lo, hi = np.zeros(len(at), np.int64), np.full(len(at), rows - k)
    while (lo < hi).any():
        tried = lo[:, None] + (hi - lo)[:, None] * np.arange(fan) // fan
        down, up = at_rank(np.stack([tried, tried + k - 1]))
        enough = up - at[:, None] >= at[:, None] - down
        first = np.where(enough.any(1), enough.argmax(1), fan)  # enough at this place, not at the one before
        ends = np.concatenate([tried, hi[:, None]], 1)
        lo, hi = np.where(first > 0, np.take_along_axis(ends, np.maximum(first - 1, 0)[:, None], 1)[:, 0] + 1, lo), np.take_along_axis(ends, first[:, None], 1)[:, 0]
        lo = np.minimum(lo, hi)
    before = np.maximum(lo - 1, 0)
    down, up, down_before, up_before = at_rank(np.stack([lo, lo + k - 1, before, before + k - 1]))
    far = np.minimum(np.maximum(at - down, up - at), np.maximum(at - down_before, up_before - at))
    windows = spark.sparkContext.broadcast((at, far))

    def triangles(part, x, y, n):
        out = np.zeros((len(windows.value[0]), 4, 4))
        for i, (c, reach) in enumerate(zip(*windows.value, strict=True)):
            s = slice(np.searchsorted(x, c - reach), np.searchsorted(x, c + reach, side="right"))
            px = x[s] - c
            w = np.sqrt(((1 - np.minimum(np.abs(px) / (reach or 1.0), 1) ** 3) ** 3 + 1e-12) * n[s])
            r = np.linalg.qr(np.stack([w, px * w, px * px * w, y[s] * w], 1), mode="r")
            out[i, : len(r)] = r
        return out.ravel()

    told = _lines(points, triangles)
    whole = np.stack([told[q].reshape(-1, 4, 4) for q in sorted(told)], 1).reshape(len(at), -1, 4)
    return at, np.array([np.linalg.lstsq(m[:, :3], m[:, 3], rcond=None)[0][0] for m in whole])


def expected_sd(stats: DataFrame, span: float = 0.3, gene: str = "gene", most: int = 50_000) -> DataFrame:
    """gene, sd: the deviation that the trend of log10 variance on log10 mean expects, of rows (gene, mean, var) with both above 0.

    Up to ``most`` rows come to the driver, more stay distributed.
    """
    spark = ship(stats.sparkSession)
    schema = f"{gene} {stats.schema[gene].dataType.simpleString()}, sd double"
    if stats.limit(most + 1).count() <= most:
        fit = stats.select(gene, "mean", "var").toPandas()
        sd = np.sqrt(10 ** local_trend(np.log10(fit["mean"].to_numpy()), np.log10(fit["var"].to_numpy()), span)) if len(fit) else np.zeros(0)
        return spark.createDataFrame(pd.DataFrame({gene: fit[gene], "sd": sd}), schema)
    shared = spark.sparkContext.broadcast(trend_knots(stats, span))

    def run(batches):
        for b in batches:
            sd = np.sqrt(10 ** np.interp(np.log10(np.asarray(b.column(1))), *shared.value))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sd)], names=[gene, "sd"])

    return stats.select(gene, "mean").mapInArrow(run, schema)


def stabilised_genes(values: DataFrame, n_cells: int, n_top: int, span: float = 0.3, cell: str = "cell", gene: str = "gene", value: str = "value") -> DataFrame:
    """gene, mean, var, norm_var, place: the ``n_top`` genes with the largest variance of standardised, clipped values.

    The variance expected of a mean is a local quadratic trend of log10 variance on log10 mean (Stuart
    et al., 2019). Values are standardised by mean and expected deviation and clipped at the root of
    the number of cells. Genes without variance have 0.
    """
    stats = cut(gene_mean_var(values, n_cells, gene, value))
    expected = expected_sd(stats.filter("var > 0 and mean > 0"), span, gene)
    top = float(np.sqrt(n_cells))
    per = stats.join(expected, gene).withColumn("z0", F.least(F.lit(top), -F.col("mean") / F.col("sd")))
    z = F.least(F.lit(top), (F.col(value) - F.col("mean")) / F.col("sd"))
    sums = values.join(per.select(gene, "mean", "sd"), gene).groupBy(gene).agg(F.sum(z * z).alias("q"), F.count(F.lit(1)).alias("k"))
    norm = (F.col("q") + (n_cells - F.col("k")) * F.col("z0") * F.col("z0")) / max(1, n_cells - 1)
    scored = stats.join(per.select(gene, "z0"), gene, "left").join(sums, gene, "left").withColumn("norm_var", F.round(F.coalesce(norm, F.lit(0.0)), 6))
    place = F.row_number().over(Window.orderBy(F.desc("norm_var"), gene))
    return scored.orderBy(F.desc("norm_var"), gene).limit(n_top).withColumn("place", place).select(gene, "mean", "var", "norm_var", "place")


def gene_subset(matrix: DataFrame, genes: DataFrame, gene: str = "gene") -> DataFrame:
    """Rows of the genes in ``genes``."""
    return matrix.join(genes.select(gene), gene, "left_semi").select(*matrix.columns)


def cluster_means(values: DataFrame, clusters: DataFrame, cell: str = "cell", gene: str = "gene", value: str = "value", cluster: str = "cluster") -> DataFrame:
    """Per cluster and gene with any stored value: sums and shares over all cells of the cluster, and of the rest."""
    sizes = clusters.groupBy(cluster).agg(F.count(F.lit(1)).cast("double").alias("size"))
    n = sizes.agg(F.sum("size").alias("cells"))
    own = values.join(clusters.select(cell, cluster), cell).groupBy(gene, cluster).agg(
        F.sum(F.expm1(value)).alias("raw"), F.sum(value).alias("sum"), F.count_if(F.col(value) > 0).cast("double").alias("k")
    )
    total = own.groupBy(gene).agg(F.sum("raw").alias("raw_all"))
    every = total.crossJoin(F.broadcast(sizes)).crossJoin(F.broadcast(n)).join(own, [gene, cluster], "left").fillna(0.0, ["raw", "sum", "k"])
    return every


def log_fold_change(means: DataFrame, gene: str = "gene", cluster: str = "cluster") -> DataFrame:
    """log2 of mean normalised counts in the cluster over those in the rest.

    Both means are rounded to 9 places before 1e-9 is added, so that a gene that only one side has
    does not depend on the order in which the other side's sum came to almost 0.
    """
    a = F.round(F.col("raw") / F.col("size"), 9)
    b = F.coalesce(F.try_divide(F.col("raw_all") - F.col("raw"), F.col("cells") - F.col("size")), F.lit(0.0))
    return means.select(cluster, gene, F.log2((a + 1e-9) / (F.round(F.greatest(b, F.lit(0.0)), 9) + 1e-9)).alias("logfc"))


def dotplot(means: DataFrame, gene: str = "gene", cluster: str = "cluster") -> DataFrame:
    """Mean value and share of expressing cells, the mean scaled to 0..1 over the clusters of a gene."""
    m = means.withColumn("mean", F.col("sum") / F.col("size")).withColumn("fraction", F.col("k") / F.col("size"))
    w = Window.partitionBy(gene)
    low, high = F.min("mean").over(w), F.max("mean").over(w)
    return m.withColumn("scaled", F.coalesce(F.try_divide(F.col("mean") - low, high - low), F.lit(0.0))).select(cluster, gene, "mean", "fraction", "scaled")
