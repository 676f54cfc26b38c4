"""Cell-by-gene counts in long form, assignment yields, and quality control."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import share, starts_with_any
from ..session import cut
from .quantiles import quantiles


def cell_gene_matrix(counts: DataFrame, cell: str = "cell", gene: str = "gene", n: str = "n") -> DataFrame:
    """Sum of counts by cell and gene."""
    return counts.groupBy(cell, gene).agg(F.sum(n).alias(n))


def assign_counts(counts: DataFrame, spot_cell: DataFrame, spot: str = "spot", cell: str = "cell") -> DataFrame:
    """Counts of known spots with the spot's cell, null where it has none."""
    return counts.join(spot_cell.select(spot, cell), spot)


def assignment_yield(counts: DataFrame, spot: str = "spot", cell: str = "cell", n: str = "n") -> DataFrame:
    """One row: spots and counts, assigned or not. Fractions are null where the total is 0."""
    spots = counts.groupBy(spot, cell).agg(F.sum(n).alias("n"))
    has = F.col(cell).isNotNull()
    t = spots.agg(
        F.count(F.lit(1)).alias("n_spots_total"), F.count_if(has).alias("n_spots_assigned"), F.coalesce(F.sum("n"), F.lit(0)).alias("counts_total"),
        F.coalesce(F.sum(F.when(has, F.col("n"))), F.lit(0)).alias("counts_assigned"),
    )
    return t.select(
        "n_spots_total", "n_spots_assigned", share(F.col("n_spots_assigned"), F.col("n_spots_total")).alias("spots_assigned_frac"), "counts_total", "counts_assigned",
        (F.col("counts_total") - F.col("counts_assigned")).alias("counts_unassigned"), share(F.col("counts_assigned"), F.col("counts_total")).alias("counts_assigned_frac"),
    )


def gene_yield(counts: DataFrame, genes: DataFrame, gene: str = "gene", cell: str = "cell", n: str = "n") -> DataFrame:
    """Per gene assigned and unassigned counts; a gene without counts has an unassigned share of 1."""
    has = F.col(cell).isNotNull()
    own = counts.groupBy(gene).agg(F.sum(F.when(has, F.col(n))).alias("a"), F.sum(F.when(~has, F.col(n))).alias("u"))
    a, u = F.coalesce("a", F.lit(0)), F.coalesce("u", F.lit(0))
    out = genes.join(own, gene, "left").select(*genes.columns, a.alias("assigned_counts"), u.alias("unassigned_counts"), (a + u).alias("total_counts"))
    frac = share(F.col("assigned_counts"), F.col("total_counts"), 0.0)
    return out.withColumn("assigned_frac", frac).withColumn("unassigned_frac", 1 - frac)


def top_unassigned(yields: DataFrame, gene: str = "gene", least: float = 100, n: int = 30) -> DataFrame:
    """The genes with the largest unassigned share among those with enough counts; ties by gene."""
    return yields.filter(F.col("total_counts") >= least).orderBy(F.desc("unassigned_frac"), gene).limit(n)


def qc_metrics(
    matrix: DataFrame, genes: DataFrame, mito: tuple[str, ...], ribo: tuple[str, ...], cell: str = "cell", gene: str = "gene", n: str = "n", name: str = "gene_name", k: int = 5
) -> DataFrame:
    """n_umi, n_genes, pct_mito, pct_ribo and the share of the k largest genes, of every cell in ``matrix`` (one row a cell and gene)."""
    flags = genes.select(gene, starts_with_any(F.col(name), mito).alias("_mt"), starts_with_any(F.col(name), ribo).alias("_rb"))
    place = F.row_number().over(Window.partitionBy(cell).orderBy(F.desc(n), gene))
    top = matrix.withColumn("_r", place).filter(F.col("_r") <= k).groupBy(cell).agg(F.sum(n).alias("_top"))
    v = F.col(n)
    base = matrix.join(flags, gene, "left").groupBy(cell).agg(
        F.sum(v).alias("n_umi"), F.count_if(v > 0).alias("n_genes"), F.coalesce(F.sum(F.when(F.col("_mt"), v)), F.lit(0)).alias("_m"), F.coalesce(F.sum(F.when(F.col("_rb"), v)), F.lit(0)).alias("_b")
    )
    pct = lambda c: 100 * share(F.col(c), F.col("n_umi"), 0.0)
    return base.join(top, cell).select(
        cell, "n_umi", "n_genes", pct("_m").alias("pct_mito"), pct("_b").alias("pct_ribo"), F.when(F.col("n_umi") > 0, share(F.col("_top"), F.col("n_umi"))).alias("top5_frac")
    )


def robust_scale(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: metric, median, mad. mad is 1.4826 times the median deviation, else IQR / 1.349, else 1. Reads ``df`` several times: cut it first where it is dear."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("x")) for c in columns])).alias("s")).select("s.*")
    q = cut(quantiles(long, "metric", "x", {"median": 0.5, "q25": 0.25, "q75": 0.75}))
    off = long.join(F.broadcast(q.select("metric", "median")), "metric").select("metric", F.abs(F.col("x") - F.col("median")).alias("x"))
    spread = quantiles(off, "metric", "x", {"d": 0.5})
    iqr = F.when(F.col("q75") > F.col("q25"), (F.col("q75") - F.col("q25")) / 1.349).otherwise(F.lit(1.0))
    return q.join(spread, "metric").select("metric", "median", F.when(F.col("d") > 0, 1.4826 * F.col("d")).otherwise(iqr).alias("mad"))


def qc_keep(metrics: DataFrame, mad_mult: float = 3.0, min_genes: int = 200, min_umis: int = 500, max_mito: float = 30.0, max_top5: float | None = None) -> DataFrame:
    """``metrics`` with qc_keep: absolute floors (0: off) and MAD limits; limits come from all cells, nulls fail."""
    metrics = cut(metrics)  # read three times below
    r = robust_scale(metrics, ["n_umi", "n_genes", "pct_mito"])
    limits = r.agg(*[F.max(F.when(F.col("metric") == m, F.col("median") + (k * mad_mult) * F.col("mad"))).alias(f"_{m}") for m, k in (("n_umi", -1), ("n_genes", -1), ("pct_mito", 1))])
    cap = F.least("_pct_mito", F.lit(float(max_mito))) if max_mito > 0 else F.col("_pct_mito")
    ok = (F.col("n_umi") >= F.col("_n_umi")) & (F.col("n_genes") >= F.col("_n_genes")) & (F.col("pct_mito") <= cap)
    for c, least in (("n_genes", min_genes), ("n_umi", min_umis)):
        if least > 0:
            ok = ok & (F.col(c) >= least)
    if max_top5:
        ok = ok & (F.col("top5_frac") <= max_top5)
    return metrics.crossJoin(F.broadcast(limits)).withColumn("qc_keep", F.coalesce(ok, F.lit(False))).drop("_n_umi", "_n_genes", "_pct_mito")


def with_defaults(metrics: DataFrame, matrix: DataFrame | None = None, cell: str = "cell", n: str = "n") -> DataFrame:
    """``metrics`` with the columns that later steps ask for: percentages that are missing are 0, n_umi and n_genes are counted again."""
    lacking = [c for c in ("n_umi", "n_genes") if c not in metrics.columns]
    out = metrics
    if lacking:
        if matrix is None:
            raise ValueError(f"no {', '.join(lacking)} and no matrix to count them from")
        own = matrix.groupBy(cell).agg(F.sum(n).alias("n_umi"), F.count_if(F.col(n) > 0).alias("n_genes")).select(cell, *lacking)
        out = out.join(own, cell, "left").fillna(0, lacking)
    for c in ("pct_mito", "pct_ribo"):
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0.0)) if c in out.columns else F.lit(0.0))
    return out


def gene_metrics(matrix: DataFrame, n_cells: int, gene: str = "gene", n: str = "n") -> DataFrame:
    """Per gene: n_cells with a count, total, mean over all cells, and the share of cells without one."""
    m = matrix.groupBy(gene).agg(F.count_if(F.col(n) > 0).alias("n_cells"), F.sum(n).alias("total_counts"))
    return m.select(gene, "n_cells", "total_counts", (F.col("total_counts") / n_cells).alias("mean_counts"), (100 * (1 - F.col("n_cells") / n_cells)).alias("pct_dropout"))


def min_counts(metrics: DataFrame, least: float | None, column: str = "n_umi") -> DataFrame:
    """Cells with at least ``least`` counts; all where no limit is given or the column is not there."""
    return metrics if least is None or column not in metrics.columns else metrics.filter(F.col(column) >= least)


def final_keep(metrics: DataFrame, doublets: DataFrame | None, cell: str = "cell") -> DataFrame:
    """``metrics`` of the cells that pass quality control and are not called doublets; a cell without a call is none."""
    kept = metrics.filter("qc_keep")
    if doublets is None:
        return kept
    called = doublets.filter("doublet_call").select(cell)
    return kept.join(called, cell, "left_anti")


def filter_bundle(matrix: DataFrame, obs: DataFrame, var: DataFrame, cell: str = "cell", gene: str = "gene") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(X, obs, var) of the cells in ``obs`` and the genes in ``var``, in both directions of the matrix."""
    x = matrix.join(obs.select(cell), cell, "left_semi").join(var.select(gene), gene, "left_semi")
    return x.select(*matrix.columns), obs, var


def qc_report(metrics: DataFrame, doublets: DataFrame | None, settings: dict, cell: str = "cell") -> DataFrame:
    """One row: cells before and after, cells that each filter takes, limits in use, and the settings as JSON. ``metrics`` has qc_keep."""
    import json

    scale = robust_scale(metrics, ["n_umi", "n_genes", "pct_mito"])
    limits = scale.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("metric", F.struct(F.round("median", 6).alias("median"), F.round("mad", 6).alias("mad"))))))).alias("limits"))
    m = metrics if doublets is None else metrics.join(doublets.select(cell, "doublet_call"), cell, "left")
    call = F.lit(False) if doublets is None else F.coalesce("doublet_call", F.lit(False))
    n = m.agg(
        F.count(F.lit(1)).alias("n_cells_raw"), F.count_if(F.col("qc_keep") & ~call).alias("n_cells_kept"), F.count_if(~F.col("qc_keep")).alias("n_failed_qc"), F.count_if(call).alias("n_doublets")
    )
    return n.crossJoin(F.broadcast(limits)).withColumn("settings", F.lit(json.dumps(settings, sort_keys=True)))


def bins_2d(df: DataFrame, x: str, y: str, nx: int = 50, ny: int = 50) -> DataFrame:
    """bx, by, n: a scatter plot as counts in equal bins between least and largest; one value is bin 0. Rows with a null are left out."""
    d = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).filter("x is not null and y is not null")
    ends = d.agg(F.min("x").alias("xl"), F.max("x").alias("xh"), F.min("y").alias("yl"), F.max("y").alias("yh"))

    def place(c: str, n: int) -> Column:
        low, high = F.col(f"{c}l"), F.col(f"{c}h")
        return F.when(high > low, F.least(F.lit(n - 1), F.floor((F.col(c) - low) / (high - low) * n))).otherwise(F.lit(0)).cast("int")

    return d.crossJoin(F.broadcast(ends)).groupBy(place("x", nx).alias("bx"), place("y", ny).alias("by")).agg(F.count(F.lit(1)).alias("n"))


def unique_names(df: DataFrame, name: str, order: str, out: str = "unique_name") -> DataFrame:
    """Repeats of a name get -1, -2 and so on from the second on, in the order of ``order``; what another name is already called is passed over.

    The numbers already in use after a name come to its repeats as one array, which is as short as
    the table has such names.
    """
    repeat = F.row_number().over(Window.partitionBy(name).orderBy(order)) - 1
    d = df.withColumn("_k", repeat)
    used = df.select(F.col(name).alias("_u")).distinct().filter(F.col("_u").rlike(r"-\d+$"))
    taken = used.select(F.regexp_replace("_u", r"-\d+$", "").alias("_base"), F.regexp_extract("_u", r"-(\d+)$", 1).cast("long").alias("_s"))
    taken = taken.groupBy("_base").agg(F.array_sort(F.collect_set("_s")).alias("_used"))
    # the k-th number that is not in use: every used one up to it moves it on by one
    free = F.aggregate("_used", F.col("_k").cast("long"), lambda at, s: F.when(s <= at, at + 1).otherwise(at))
    d = d.join(taken, d[name] == taken["_base"], "left").withColumn("_free", F.when(F.col("_used").isNull() | (F.col("_k") == 0), F.col("_k").cast("long")).otherwise(free))
    return d.withColumn(out, F.when(F.col("_k") > 0, F.concat_ws("-", name, F.col("_free").cast("string"))).otherwise(F.col(name))).drop("_k", "_base", "_used", "_free")


def number_rows(df: DataFrame, order: str, out: str = "number", width: int = 4096) -> DataFrame:
    """1, 2, ... by the integer ``order``. Counts of ranges of ``width`` and ``width``^2 values come first, so no task sorts all rows or all ranges."""
    b = df.withColumn("_b", F.floor(F.col(order) / width))
    fine = b.groupBy("_b").agg(F.count(F.lit(1)).alias("_n")).withColumn("_c", F.floor(F.col("_b") / width))
    before = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    coarse = fine.groupBy("_c").agg(F.sum("_n").alias("_n")).select("_c", before(Window.orderBy("_c")).alias("_first_c"))  # one row for 16 million values
    sizes = fine.select("_b", "_c", before(Window.partitionBy("_c").orderBy("_b")).alias("_first")).join(coarse, "_c").select("_b", (F.col("_first") + F.col("_first_c")).alias("_first"))
    within = F.row_number().over(Window.partitionBy("_b").orderBy(order))
    return b.withColumn("_k", within).join(sizes, "_b").withColumn(out, F.col("_first") + F.col("_k")).drop("_b", "_k", "_first")


def dedup_stats(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: outlines found, kept, removed."""
    n = before.agg(F.count(F.lit(1)).alias("found")).crossJoin(F.broadcast(after.agg(F.count(F.lit(1)).alias("kept"))))
    return n.withColumn("removed", F.col("found") - F.col("kept"))


def spot_table(positions: DataFrame, totals: DataFrame, assigned: DataFrame, spot: str = "spot", cell: str = "cell_id") -> DataFrame:
    """spot, x, y, spot_counts, assigned (0 or 1): every spot with its total and whether a cell holds it."""
    t = totals.select(spot, F.col("n").alias("spot_counts"))
    a = assigned.select(spot, F.col(cell).isNotNull().cast("int").alias("assigned"))
    return positions.select(spot, "x", "y").join(t, spot, "left").join(a, spot, "left").fillna(0, ["spot_counts", "assigned"])


def first_per_label(features: DataFrame, label: str, seq: str, y: str, x: str) -> DataFrame:
    """The first feature of each label in the order of ``seq``; label 0 is told apart by its rounded place. Renumbered from 1."""
    place = F.when(F.col(label) == 0, F.struct(F.rint(y).alias("y"), F.rint(x).alias("x")))
    firsts = features.withColumn("_r", F.row_number().over(Window.partitionBy(label, place).orderBy(seq))).filter("_r = 1").drop("_r")
    return number_rows(firsts, seq, "cell_id")


def plot_summary(metrics: DataFrame, columns: list[str]) -> DataFrame:
    """Five-number summaries for box plots."""
    long = metrics.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("x")) for c in columns])).alias("s")).select("s.*")
    long = cut(long)  # the quantiles read it twice
    ends = long.groupBy("metric").agg(F.min("x").alias("lowest"), F.max("x").alias("highest"))
    inner = quantiles(long, "metric", "x", {"q25": 0.25, "median": 0.5, "q75": 0.75})
    return ends.join(F.broadcast(inner), "metric").select("metric", "lowest", "q25", "median", "q75", "highest")
