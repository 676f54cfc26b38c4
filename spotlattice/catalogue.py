"""Queries over the star-schema tables, and their SQL.

Stand-ins: spots are events (x = value, y = user_id), cells are octagons around suppliers, counts
are line items (cell l_suppkey, gene l_partkey, n l_quantity; spot l_orderkey), genes are parts,
clusters of spots are event types and of cells the supplier's nation modulo 5, vectors are embeddings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import assign, expression, geometry, matrix, neighbours, tiler, tiles
from .session import cut

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spots(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(F.col("event_id").alias("spot"), F.col("value").alias("x"), F.col("user_id").cast("double").alias("y"), F.col("event_type").alias("cluster"))


def cells(spark: SparkSession, d: str, radius: float = 4.0) -> DataFrame:
    k = F.col("s_suppkey")
    xs, ys = geometry.octagon((k * 37) % 100 + 0.013, (k * 53) % 100 + 0.017, F.lit(radius) + (k % 3).cast("double"))
    return table(spark, d, "supplier").select(k.alias("cell_id"), xs.alias("xs"), ys.alias("ys")).select("cell_id", geometry.ring_edges(F.col("xs"), F.col("ys")).alias("edges"))


def counts(spark: SparkSession, d: str) -> DataFrame:
    n = F.round("l_quantity").cast("long").alias("n")
    return table(spark, d, "lineitem").select(F.col("l_suppkey").alias("cell"), F.col("l_partkey").alias("gene"), F.col("l_orderkey").alias("spot"), n)


def genes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(F.col("p_partkey").alias("gene"), F.col("p_name").alias("gene_name"), F.col("p_brand").alias("brand"))


def cell_clusters(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").select(F.col("s_suppkey").alias("cell"), (F.col("s_nationkey") % 5).alias("cluster"))


def cell_matrix(spark: SparkSession, d: str) -> DataFrame:
    return matrix.cell_gene_matrix(counts(spark, d).select("cell", "gene", "n"))


def spot_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counts of spots with their cell: orders that are open have none."""
    c = F.when(F.col("o_orderstatus") != "O", F.col("o_custkey")).alias("cell")
    return matrix.assign_counts(counts(spark, d).drop("cell"), table(spark, d, "orders").select(F.col("o_orderkey").alias("spot"), c))


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


VERTICES = ", ".join(f"({i}, {c!r}, {s!r})" for i, (c, s) in enumerate(geometry.OCTAGON))
CELLS_SQL = f"""
v(i, c, s) AS (VALUES {VERTICES}),
p AS (SELECT s_suppkey AS cell_id, i, (s_suppkey * 37) % 100 + 0.013::DOUBLE + (4.0 + s_suppkey % 3)::DOUBLE * c::DOUBLE AS x,
             (s_suppkey * 53) % 100 + 0.017::DOUBLE + (4.0 + s_suppkey % 3)::DOUBLE * s::DOUBLE AS y FROM supplier, v),
e AS (SELECT a.cell_id, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM p a JOIN p b ON a.cell_id = b.cell_id AND b.i = (a.i + 1) % 8),
box AS (SELECT cell_id, min(x) AS xl, max(x) AS xh, min(y) AS yl, max(y) AS yh FROM p GROUP BY 1),
spot AS (SELECT event_id AS spot, value AS x, CAST(user_id AS DOUBLE) AS y, event_type AS cluster FROM events),
pair AS (SELECT spot.*, cell_id FROM spot JOIN box ON x BETWEEN xl AND xh AND y BETWEEN yl AND yh),
hit AS (SELECT spot, x, y, cell_id,
               sum(CASE WHEN (y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / nullif(y2 - y1, 0) + x1 THEN 1 ELSE 0 END) % 2 = 1 AS odd,
               bool_or((x2 - x1) * (y - y1) = (y2 - y1) * (x - x1) AND x BETWEEN least(x1, x2) AND greatest(x1, x2) AND y BETWEEN least(y1, y2) AND greatest(y1, y2)) AS edge
        FROM pair JOIN e USING (cell_id) GROUP BY 1, 2, 3, 4)
"""
COUNTS_SQL = "c AS (SELECT l_suppkey AS cell, l_partkey AS gene, l_orderkey AS spot, CAST(round(l_quantity) AS BIGINT) AS n FROM lineitem)"
MATRIX_SQL = COUNTS_SQL + ", m AS (SELECT cell, gene, CAST(sum(n) AS BIGINT) AS n FROM c GROUP BY 1, 2)"
NORM_SQL = MATRIX_SQL + ", t AS (SELECT cell, CAST(sum(n) AS DOUBLE) AS t FROM m GROUP BY 1), norm AS (SELECT cell, gene, ln(1 + n * 10000.0::DOUBLE / t.t) AS value FROM m JOIN t USING (cell))"
STATS_SQL = NORM_SQL + """, k AS (SELECT count(*) AS k FROM t),
st AS (SELECT gene, sum(value) / max(k) AS mean, greatest(0, (sum(value * value) - sum(value) * sum(value) / max(k)) / (max(k) - 1)) AS var FROM norm, k GROUP BY gene)"""
SPOT_COUNTS_SQL = COUNTS_SQL + ", sc AS (SELECT c.spot, c.gene, c.n, CASE WHEN o_orderstatus <> 'O' THEN o_custkey END AS cell FROM c JOIN orders ON spot = o_orderkey)"


@query(f"WITH {MATRIX_SQL} SELECT * FROM m")
def cell_gene_matrix(spark, d):
    return cell_matrix(spark, d)


@query(f"WITH {COUNTS_SQL} SELECT spot, CAST(sum(n) AS BIGINT) AS n FROM c GROUP BY spot")
def spot_totals(spark, d):
    return counts(spark, d).groupBy("spot").agg(F.sum("n").alias("n"))


QC_SQL = MATRIX_SQL + """, f AS (SELECT p_partkey AS gene, lower(p_brand) LIKE 'brand#1%' AS mt, lower(p_brand) LIKE 'brand#2%' OR lower(p_brand) LIKE 'brand#5%' AS rb FROM part),
r AS (SELECT cell, n, row_number() OVER (PARTITION BY cell ORDER BY n DESC, gene) AS k FROM m),
top AS (SELECT cell, sum(n) AS top FROM r WHERE k <= 5 GROUP BY 1),
b AS (SELECT cell, CAST(sum(n) AS BIGINT) AS n_umi, CAST(count(*) FILTER (n > 0) AS BIGINT) AS n_genes, coalesce(sum(n) FILTER (mt), 0) AS a, coalesce(sum(n) FILTER (rb), 0) AS b FROM m LEFT JOIN f USING (gene) GROUP BY 1),
qc AS (SELECT cell, n_umi, n_genes, coalesce(100 * (a::DOUBLE / nullif(n_umi, 0)::DOUBLE), 0) AS pct_mito, coalesce(100 * (b::DOUBLE / nullif(n_umi, 0)::DOUBLE), 0) AS pct_ribo,
              CASE WHEN n_umi > 0 THEN top::DOUBLE / n_umi::DOUBLE END AS top5_frac FROM b JOIN top USING (cell))"""
MAD_SQL = QC_SQL + """, long AS (SELECT 'n_umi' AS metric, n_umi::DOUBLE AS x FROM qc UNION ALL SELECT 'n_genes', n_genes::DOUBLE FROM qc UNION ALL SELECT 'pct_mito', pct_mito FROM qc),
q AS (SELECT metric, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.25) AS q25, quantile_cont(x, 0.75) AS q75 FROM long GROUP BY 1),
dev AS (SELECT metric, quantile_cont(abs(x - median), 0.5) AS d FROM long JOIN q USING (metric) GROUP BY 1),
mad AS (SELECT metric, median, CASE WHEN d > 0 THEN 1.4826 * d WHEN q75 > q25 THEN (q75 - q25) / 1.349 ELSE 1.0 END AS mad FROM q JOIN dev USING (metric))"""


def _metrics(spark, d, summed=None):
    return matrix.qc_metrics(cell_matrix(spark, d) if summed is None else summed, genes(spark, d), ("brand#1",), ("Brand#2", "Brand#5"), name="brand")


@query(f"WITH {QC_SQL} SELECT cell, n_umi, n_genes, round(pct_mito, 6) AS pct_mito, round(pct_ribo, 6) AS pct_ribo, round(top5_frac, 6) AS top5_frac FROM qc")
def qc_metrics(spark, d):
    return rounded(_metrics(spark, d), "pct_mito", "pct_ribo", "top5_frac")


@query(f"WITH {MAD_SQL} SELECT metric, round(median, 6) AS median, round(mad, 6) AS mad FROM mad")
def qc_mad_thresholds(spark, d):
    return rounded(matrix.robust_scale(cut(_metrics(spark, d)), ["n_umi", "n_genes", "pct_mito"]), "median", "mad")


@query(f"""WITH {MAD_SQL}, lim AS (SELECT max(CASE WHEN metric = 'n_umi' THEN median - 1.5 * mad END) AS u, max(CASE WHEN metric = 'n_genes' THEN median - 1.5 * mad END) AS g,
 max(CASE WHEN metric = 'pct_mito' THEN median + 1.5 * mad END) AS p FROM mad)
SELECT cell, coalesce(n_umi >= u AND n_genes >= g AND pct_mito <= least(p, 60) AND n_genes >= 20 AND n_umi >= 50 AND top5_frac <= 0.9, false) AS qc_keep FROM qc, lim""")
def qc_keep(spark, d):
    return matrix.qc_keep(_metrics(spark, d), 1.5, 20, 50, 60.0, 0.9).select("cell", "qc_keep")


PLOTTED = ["n_umi", "n_genes", "pct_mito", "pct_ribo"]
PLOT_SQL = " UNION ALL ".join(f"SELECT '{c}' AS metric, {c}::DOUBLE AS x FROM qc" for c in PLOTTED)


@query(f"WITH {QC_SQL}, l AS ({PLOT_SQL}) SELECT metric, round(min(x), 6) AS lowest, round(quantile_cont(x, 0.25), 6) AS q25, round(quantile_cont(x, 0.5), 6) AS median, round(quantile_cont(x, 0.75), 6) AS q75, round(max(x), 6) AS highest FROM l GROUP BY 1")
def qc_plot_data(spark, d):
    return rounded(matrix.plot_summary(_metrics(spark, d), PLOTTED), "lowest", "q25", "median", "q75", "highest")


@query(f"WITH {CELLS_SQL} SELECT spot, min(cell_id) AS cell_id FROM hit WHERE odd OR edge GROUP BY spot")
def spot_assign(spark, d):
    return assign.assign_spots(spots(spark, d), cells(spark, d))


@query("""SELECT event_id AS spot, value AS x, CAST(user_id AS DOUBLE) AS y FROM events WHERE value > 20 AND value < 320 AND user_id > 10 AND user_id < 90
UNION ALL SELECT event_id, value, user_id FROM events WHERE value > 350 AND value < 400 AND user_id > 0 AND user_id < 140""")
def roi_filter(spark, d):
    rois = spark.createDataFrame([("a", [20.0, 320.0, 320.0, 20.0], [10.0, 10.0, 90.0, 90.0]), ("b", [350.0, 400.0, 400.0, 350.0], [0.0, 0.0, 140.0, 140.0])], "roi string, xs array<double>, ys array<double>")
    return assign.roi_filter(spots(spark, d), geometry.region_edges(rois, "roi")).select("spot", "x", "y")


@query(f"""WITH {CELLS_SQL}, ctr AS (SELECT cell_id, (s_suppkey * 37) % 100 + 0.013::DOUBLE AS cx, (s_suppkey * 53) % 100 + 0.017::DOUBLE AS cy FROM supplier JOIN box ON s_suppkey = cell_id),
near AS (SELECT spot.spot, x, y, box.cell_id FROM spot JOIN box ON x BETWEEN xl - 2 AND xh + 2 AND y BETWEEN yl - 2 AND yh + 2),
seg AS (SELECT spot, x, y, cell_id, greatest(0, least(1, ((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)))) AS t, x1, y1, x2, y2 FROM near JOIN e USING (cell_id)),
gap AS (SELECT spot, x, y, cell_id, min(sqrt((x - (x1 + t * (x2 - x1))) * (x - (x1 + t * (x2 - x1))) + (y - (y1 + t * (y2 - y1))) * (y - (y1 + t * (y2 - y1))))) AS g,
  sum(CASE WHEN (y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / nullif(y2 - y1, 0) + x1 THEN 1 ELSE 0 END) % 2 = 1 AS odd FROM seg GROUP BY 1, 2, 3, 4),
claim AS (SELECT spot, x, y, cell_id, CASE WHEN odd THEN 0 ELSE g END AS g FROM gap WHERE odd OR g <= 2),
who AS (SELECT spot, cell_id, row_number() OVER (PARTITION BY spot ORDER BY round(sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy)), 9), cell_id) AS k FROM (SELECT DISTINCT spot, x, y FROM claim) CROSS JOIN ctr)
SELECT spot, cell_id, round(g, 6) AS distance FROM claim JOIN (SELECT spot, cell_id FROM who WHERE k = 1) USING (spot, cell_id)""")
def dilated_assign(spark, d):
    return assign.assign_dilated(spots(spark, d), cells(spark, d), 2.0)


@query(f"""WITH {CELLS_SQL}, a AS (SELECT spot, min(cell_id) AS cell_id FROM hit WHERE odd OR edge GROUP BY spot), n AS (SELECT cell_id, count(*) AS n FROM a GROUP BY 1)
SELECT cell_id, round(sum((x1 + x2) * (x1 * y2 - x2 * y1)) / (6 * sum(x1 * y2 - x2 * y1) / 2), 6) AS centroid_x, round(sum((y1 + y2) * (x1 * y2 - x2 * y1)) / (6 * sum(x1 * y2 - x2 * y1) / 2), 6) AS centroid_y,
 round(abs(sum(x1 * y2 - x2 * y1) / 2), 6) AS area_px2, coalesce(max(n), 0) AS n_spots FROM e LEFT JOIN n USING (cell_id) GROUP BY cell_id""")
def cells_meta(spark, d):
    own = cells(spark, d)
    n = assign.assign_spots(spots(spark, d), own).groupBy("cell_id").agg(F.count(F.lit(1)).alias("n"))
    x, y = geometry.centroid(F.col("edges"))
    shape = own.select("cell_id", F.round(x, 6).alias("centroid_x"), F.round(y, 6).alias("centroid_y"), F.round(F.abs(geometry.signed_area(F.col("edges"))), 6).alias("area_px2"))
    return shape.join(n, "cell_id", "left").select("cell_id", "centroid_x", "centroid_y", "area_px2", F.coalesce("n", F.lit(0)).alias("n_spots"))


@query(f"""WITH {SPOT_COUNTS_SQL}, s AS (SELECT spot, cell, sum(n) AS n FROM sc GROUP BY 1, 2)
SELECT count(*) AS n_spots_total, count(cell) AS n_spots_assigned, round(count(cell)::DOUBLE / nullif(count(*), 0), 6) AS spots_assigned_frac, CAST(coalesce(sum(n), 0) AS BIGINT) AS counts_total,
 CAST(coalesce(sum(n) FILTER (cell IS NOT NULL), 0) AS BIGINT) AS counts_assigned, CAST(coalesce(sum(n) FILTER (cell IS NULL), 0) AS BIGINT) AS counts_unassigned,
 round(sum(n) FILTER (cell IS NOT NULL)::DOUBLE / nullif(sum(n), 0)::DOUBLE, 6) AS counts_assigned_frac FROM s""")
def assignment_yield(spark, d):
    return rounded(matrix.assignment_yield(spot_counts(spark, d)), "spots_assigned_frac", "counts_assigned_frac")


YIELD_SQL = SPOT_COUNTS_SQL + """, y AS (SELECT p_partkey AS gene, p_name AS gene_name, CAST(coalesce(sum(n) FILTER (cell IS NOT NULL), 0) AS BIGINT) AS assigned_counts,
 CAST(coalesce(sum(n) FILTER (cell IS NULL), 0) AS BIGINT) AS unassigned_counts, CAST(coalesce(sum(n), 0) AS BIGINT) AS total_counts FROM part LEFT JOIN sc ON gene = p_partkey GROUP BY 1, 2),
z AS (SELECT *, coalesce(assigned_counts::DOUBLE / nullif(total_counts, 0)::DOUBLE, 0) AS f FROM y)"""


@query(f"WITH {YIELD_SQL} SELECT gene, gene_name, assigned_counts, unassigned_counts, total_counts, round(f, 6) AS assigned_frac, round(1 - f, 6) AS unassigned_frac FROM z")
def gene_yield(spark, d):
    return rounded(matrix.gene_yield(spot_counts(spark, d), genes(spark, d).drop("brand")), "assigned_frac", "unassigned_frac")


@query(f"WITH {YIELD_SQL} SELECT gene, gene_name, total_counts, round(1 - f, 6) AS unassigned_frac FROM z WHERE total_counts >= 100 ORDER BY 1 - f DESC, gene LIMIT 30")
def gene_unassigned_top30(spark, d):
    top = matrix.top_unassigned(matrix.gene_yield(spot_counts(spark, d), genes(spark, d).drop("brand")))
    return rounded(top.select("gene", "gene_name", "total_counts", "unassigned_frac"), "unassigned_frac")


@query("""WITH f AS (SELECT event_id AS seq, value AS cx, CAST(user_id AS DOUBLE) AS cy, (user_id * 7 + CAST(floor(value) AS BIGINT)) % 211 AS label FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY label, CASE WHEN label = 0 THEN round_even(cy, 0) END, CASE WHEN label = 0 THEN round_even(cx, 0) END ORDER BY seq) AS k FROM f)
SELECT seq, label, row_number() OVER (ORDER BY seq) AS cell_id FROM r WHERE k = 1""")
def polygon_dedup(spark, d):
    e = table(spark, d, "events")
    label = ((F.col("user_id") * 7 + F.floor("value")) % 211).alias("label")
    f = e.select(F.col("event_id").alias("seq"), F.col("value").alias("cx"), F.col("user_id").cast("double").alias("cy"), label)
    return matrix.first_per_label(f, "label", "seq", "cy", "cx").select("seq", "label", "cell_id")


@query("SELECT p_partkey AS gene, CASE WHEN k > 1 THEN p_name || '-' || (k - 1) ELSE p_name END AS unique_name FROM (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS k FROM part)")
def unique_gene_names(spark, d):
    return matrix.unique_names(genes(spark, d), "gene_name", "gene").select("gene", "unique_name")


@query(f"WITH {NORM_SQL} SELECT cell, gene, round(value, 6) AS value FROM norm")
def norm_log1p(spark, d):
    return rounded(expression.log_normalise(cell_matrix(spark, d)), "value")


def _values(spark, d):
    return expression.log_normalise(cell_matrix(spark, d))


def _stats(spark, d):
    return expression.gene_mean_var(_values(spark, d), counts(spark, d).select("cell").distinct().count())


@query(f"WITH {STATS_SQL} SELECT gene, round(mean, 6) AS mean, round(var, 6) AS var FROM st")
def gene_mean_var(spark, d):
    return rounded(_stats(spark, d), "mean", "var")


@query(f"WITH {STATS_SQL} SELECT cell, gene, round(least(10, (value - mean) / CASE WHEN var > 0 THEN sqrt(var) ELSE 1 END), 5) AS z FROM norm JOIN st USING (gene)")
def scaled_expression(spark, d):
    return rounded(expression.scale(_values(spark, d), _stats(spark, d))[0], "z", places=5)


@query(f"WITH {STATS_SQL} SELECT gene, round(least(10, -mean / CASE WHEN var > 0 THEN sqrt(var) ELSE 1 END), 5) AS z0 FROM st")
def scaled_zeros(spark, d):
    """The other half of scaling: the z-score that every zero of a gene has."""
    return rounded(expression.scale(_values(spark, d), _stats(spark, d))[1], "z0", places=5)


@query(f"""WITH {STATS_SQL}, b AS (SELECT *, coalesce(var / nullif(mean, 0), 0) AS disp, ntile(20) OVER (ORDER BY mean, gene) AS bin FROM st),
n AS (SELECT gene, round((disp - avg(disp) OVER (PARTITION BY bin)) / CASE WHEN stddev_samp(disp) OVER (PARTITION BY bin) > 0 THEN stddev_samp(disp) OVER (PARTITION BY bin) ELSE 1 END, 6) AS norm_dispersion FROM b)
SELECT gene, norm_dispersion FROM n ORDER BY norm_dispersion DESC, gene LIMIT 100""")
def hvg_topn(spark, d):
    return expression.variable_genes(_stats(spark, d), 100).select("gene", "norm_dispersion")


CLUSTERS_SQL = """, cl AS (SELECT s_suppkey AS cell, s_nationkey % 5 AS cluster FROM supplier), sz AS (SELECT cluster, count(*)::DOUBLE AS size FROM cl GROUP BY 1), nn AS (SELECT sum(size) AS cells FROM sz)"""
WILCOXON_SQL = NORM_SQL + CLUSTERS_SQL + """,
dense AS (SELECT g.gene, cl.cell, cl.cluster, coalesce(value, 0) AS value FROM (SELECT DISTINCT gene FROM norm) g CROSS JOIN cl LEFT JOIN norm ON norm.gene = g.gene AND norm.cell = cl.cell),
rk AS (SELECT gene, cluster, rank() OVER (PARTITION BY gene ORDER BY value)::DOUBLE + (count(*) OVER (PARTITION BY gene, value) - 1)::DOUBLE / 2 AS r FROM dense),
test AS (SELECT cluster, gene, (sum(r) - max(size) * (max(cells) + 1) / 2) / sqrt(max(size) * (max(cells) - max(size)) * (max(cells) + 1) / 12) AS z FROM rk JOIN sz USING (cluster), nn GROUP BY 1, 2)"""


def _tests(spark, d):
    return expression.wilcoxon(_values(spark, d), cell_clusters(spark, d))


@query(f"WITH {WILCOXON_SQL} SELECT cluster, gene, round(z, 6) AS z FROM test")
def markers_wilcoxon(spark, d):
    return rounded(_tests(spark, d), "z")


@query(f"WITH {WILCOXON_SQL}, r AS (SELECT cluster, gene, round(z, 6) AS z, row_number() OVER (PARTITION BY cluster ORDER BY round(z, 6) DESC, gene) AS place FROM test) SELECT * FROM r WHERE place <= 100")
def markers_top(spark, d):
    return expression.top_markers(rounded(_tests(spark, d), "z"))


#: Two-sided p of z: 1 - erf(|z| / sqrt 2), erf by its series of positive terms 2^n x^(2n+1) / (1 * 3 * ... * (2n+1)).
P_SQL = """, x AS (SELECT cluster, gene, z, abs(z) / sqrt(2.0::DOUBLE) AS x FROM test),
pv AS (SELECT cluster, gene, z, CASE WHEN x = 0 THEN 1.0::DOUBLE WHEN x > 5.5 THEN 0.0::DOUBLE ELSE greatest(0, 1 - 2 / sqrt(pi()) * list_sum(list_transform(range(0, 160),
  lambda n: exp((2 * n + 1) * ln(x) + 2 * n * ln(2) - lgamma(2 * n + 2) + lgamma(n + 1) - x * x)))) END AS p FROM x)"""
BH_SQL = P_SQL + """, r AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY round(p, 9), gene) AS k, count(*) OVER (PARTITION BY cluster) AS m FROM pv),
adj AS (SELECT cluster, gene, z, p, least(1, min(round(p, 9) * m / k) OVER (PARTITION BY cluster ORDER BY k DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS p_adj FROM r)"""


@query(f"WITH {WILCOXON_SQL}{BH_SQL} SELECT cluster, gene, round(p, 6) AS p, round(p_adj, 5) AS p_adj FROM adj")
def markers_bh(spark, d):
    """p of the rank-sum test of every gene and cluster, and adjusted; p is rounded to 9 places before it is ranked."""
    t = _tests(spark, d).withColumn("p", F.round(expression.two_sided_p(F.col("z")), 9))
    return rounded(rounded(expression.adjust(t, "p"), "p_adj", places=5), "p", places=6).select("cluster", "gene", "p", "p_adj")


OWN_SQL = """,
own AS (SELECT gene, cluster, sum(exp(value) - 1) AS raw, sum(value) AS s, count(*) FILTER (value > 0)::DOUBLE AS k FROM norm JOIN cl USING (cell) GROUP BY 1, 2), tot AS (SELECT gene, sum(raw) AS raw_all FROM own GROUP BY 1),
mean AS (SELECT tot.gene, sz.cluster, raw_all, size, cells, coalesce(raw, 0) AS raw, coalesce(s, 0) AS s, coalesce(k, 0) AS k FROM tot CROSS JOIN sz CROSS JOIN nn LEFT JOIN own ON own.gene = tot.gene AND own.cluster = sz.cluster)"""
MEANS_SQL = NORM_SQL + CLUSTERS_SQL + OWN_SQL


FOLD_SQL = "log2((round(raw / size, 9) + 1e-9) / (round(greatest(0, coalesce((raw_all - raw) / nullif(cells - size, 0), 0)), 9) + 1e-9))"


@query(f"""WITH {WILCOXON_SQL}{BH_SQL}{OWN_SQL}, top AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY round(z, 6) DESC, gene) AS place FROM adj)
SELECT top.cluster, top.gene, round(z, 6) AS score, round({FOLD_SQL}, 5) AS "logFC", round(p_adj, 5) AS p_adj FROM top JOIN mean ON mean.cluster = top.cluster AND mean.gene = top.gene WHERE place <= 100""")
def markers_table(spark, d):
    """cluster, gene, score, logFC, p_adj of the best genes of each cluster."""
    t = _tests(spark, d).withColumn("p", F.round(expression.two_sided_p(F.col("z")), 9))
    fold = expression.log_fold_change(expression.cluster_means(_values(spark, d), cell_clusters(spark, d)))
    top = expression.top_markers(rounded(expression.adjust(t, "p"), "z")).join(fold, ["cluster", "gene"], "left")
    return top.select("cluster", "gene", F.col("z").alias("score"), F.round("logfc", 5).alias("logFC"), F.round("p_adj", 5).alias("p_adj"))


@query(f"WITH {MEANS_SQL} SELECT cluster, gene, round({FOLD_SQL}, 3) AS logfc FROM mean")
def marker_logfc(spark, d):
    return rounded(expression.log_fold_change(expression.cluster_means(_values(spark, d), cell_clusters(spark, d))), "logfc", places=3)


@query(f"""WITH {WILCOXON_SQL}{OWN_SQL}, r AS (SELECT cluster, gene, round(z, 6) AS score, row_number() OVER (PARTITION BY cluster ORDER BY round(z, 6) DESC, gene) AS place FROM test)
SELECT r.cluster, r.gene, place, score, round({FOLD_SQL}, 3) AS logfc FROM r JOIN mean ON mean.cluster = r.cluster AND mean.gene = r.gene WHERE place <= 100""")
def marker_scores(spark, d):
    """The marker table but for its p-values, which SQL has no function for."""
    fold = expression.log_fold_change(expression.cluster_means(_values(spark, d), cell_clusters(spark, d)))
    top = expression.top_markers(rounded(_tests(spark, d), "z")).join(fold, ["cluster", "gene"], "left")
    return rounded(top.select("cluster", "gene", "place", F.col("z").alias("score"), "logfc"), "logfc", places=3)


@query(f"""WITH {MEANS_SQL}, a AS (SELECT *, s / size AS mean, k / size AS fraction FROM mean), b AS (SELECT *, min(mean) OVER (PARTITION BY gene) AS lo, max(mean) OVER (PARTITION BY gene) AS hi FROM a)
SELECT cluster, gene, round(mean, 6) AS mean, round(fraction, 6) AS fraction, round(coalesce((mean - lo) / nullif(hi - lo, 0), 0), 6) AS scaled FROM b""")
def dotplot(spark, d):
    return rounded(expression.dotplot(expression.cluster_means(_values(spark, d), cell_clusters(spark, d))), "mean", "fraction", "scaled")


KNN_SQL = """WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), p AS (SELECT a.vec_id AS a, b.vec_id AS b, {} AS distance FROM v a JOIN v b ON a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY round(distance, 9), b) AS rank FROM p) SELECT a, b, CAST(rank AS INTEGER) AS rank, round(distance, 6) AS distance FROM r WHERE rank <= 19"""


def _vectors(spark, d):
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))


@query(KNN_SQL.format("list_distance(a.v, b.v)"))
def knn_l2(spark, d):
    return rounded(neighbours.nearest(_vectors(spark, d), 19), "distance")


@query(KNN_SQL.format("1 - list_cosine_similarity(a.v, b.v)"))
def knn_cosine(spark, d):
    return rounded(neighbours.nearest(_vectors(spark, d), 19, "cosine"), "distance")


@query()
def graph_clusters(spark, d):
    """Clusters of vectors by label propagation on the fuzzy neighbour graph."""
    return neighbours.label_propagation(neighbours.fuzzy_weights(neighbours.nearest(_vectors(spark, d), 19), 20))


@query()
def pca(spark, d):
    v = _vectors(spark, d)
    mean, comp, _ = neighbours.principal_components(v, 5)
    return neighbours.project(v, mean, comp)


@query()
def doublets(spark, d):
    return neighbours.doublet_scores(_vectors(spark, d))


TILE_SQL = "h AS (SELECT CAST(floor(user_id / 64.0) AS BIGINT) AS ty, CAST(floor(value / 64.0) AS BIGINT) AS tx, event_type AS cluster, count(*) AS n FROM events GROUP BY 1, 2, 3)"
SMALL_SQL = TILE_SQL.replace("64.0", "8.0")
ENTROPY_SQL = """, w AS (SELECT *, sum(n) OVER (PARTITION BY ty, tx) AS total FROM h), x AS (SELECT ty, tx, CAST(max(total) AS BIGINT) AS total, -sum(n / total * log2(n / total)) AS h, count(*) AS k FROM w GROUP BY 1, 2),
ent AS (SELECT ty, tx, total, CASE WHEN total >= {least} AND k > 1 THEN h / log2(k) END AS entropy FROM x)"""


@query(f"WITH {TILE_SQL} SELECT * FROM h")
def tile_histogram(spark, d):
    return tiles.tile_histogram(spots(spark, d))


@query(f"WITH {SMALL_SQL}{ENTROPY_SQL.format(least=5)} SELECT ty, tx, total, round(entropy, 6) AS entropy FROM ent")
def tile_entropy(spark, d):
    return rounded(tiles.tile_entropy(tiles.tile_histogram(spots(spark, d), 8.0), 5), "entropy")


@query(f"""WITH {SMALL_SQL}{ENTROPY_SQL.format(least=5)}, k AS (SELECT i AS d, exp(-0.5 * i * i) / (SELECT sum(exp(-0.5 * j * j)) FROM range(-4, 5) r(j)) AS w FROM range(-4, 5) r(i)),
sz AS (SELECT max(ty) + 1 AS hh, max(tx) + 1 AS ww FROM ent), grid AS (SELECT y.y, x.x FROM sz, range(0, 1000) y(y), range(0, 1000) x(x) WHERE y.y < hh AND x.x < ww),
st AS (SELECT grid.y, grid.x, a.w * b.w AS w, greatest(0, least(hh - 1, grid.y + a.d)) AS sy, greatest(0, least(ww - 1, grid.x + b.d)) AS sx FROM grid, sz, k a, k b)
SELECT st.y AS ty, st.x AS tx, round(sum(w * entropy) / sum(w), 5) AS smoothed FROM st JOIN ent ON ent.ty = sy AND ent.tx = sx WHERE entropy IS NOT NULL GROUP BY 1, 2 HAVING sum(w) > 1e-6""")
def tile_entropy_smoothed(spark, d):
    e = tiles.tile_entropy(tiles.tile_histogram(spots(spark, d), 8.0), 5)
    size = e.agg(F.max("ty").alias("y"), F.max("tx").alias("x")).first()
    return rounded(tiles.smooth(e, "entropy", size["y"] + 1, size["x"] + 1), "smoothed", places=5)


@query("SELECT event_type AS cluster, count(*) AS n FROM events GROUP BY 1")
def cluster_sizes(spark, d):
    return spots(spark, d).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT event_type AS cluster, min(value) - 0.03 * (max(value) - min(value)) AS x0, max(value) + 0.03 * (max(value) - min(value)) AS x1,
 min(user_id) - 0.03::DOUBLE * (max(user_id) - min(user_id)) AS y0, max(user_id) + 0.03::DOUBLE * (max(user_id) - min(user_id)) AS y1 FROM events GROUP BY 1""")
def cluster_bbox(spark, d):
    return tiles.padded_bounds(spots(spark, d), F.lit(0.03), "cluster")


@query("SELECT event_id AS spot, event_type = (SELECT min(event_type) FROM events) AS foreground FROM events")
def cluster_fg_bg(spark, d):
    """Spots of one cluster against all others: a flag on each spot."""
    s = spots(spark, d)
    one = F.broadcast(s.agg(F.min("cluster").alias("_one")))
    return s.crossJoin(one).select("spot", (F.col("cluster") == F.col("_one")).alias("foreground"))


@query("SELECT CAST(floor(user_id / 4) AS BIGINT) AS by, CAST(floor(value / 4) AS BIGINT) AS bx, max(event_id) AS pooled FROM events GROUP BY 1, 2")
def block_pool(spark, d):
    return tiles.block_pool(spots(spark, d), 4, "spot")


@query("""WITH p AS (SELECT CAST(user_id AS INTEGER) AS y, CAST(floor(value) AS INTEGER) AS x, max(1 + event_id % 3) AS label FROM events GROUP BY 1, 2)
SELECT a.y, a.x, a.label FROM p a LEFT JOIN p b ON a.label = b.label AND abs(a.x - b.x) + abs(a.y - b.y) = 1 GROUP BY 1, 2, 3 HAVING count(b.label) < 4""")
def label_boundary(spark, d):
    e = table(spark, d, "events")
    p = e.groupBy(F.col("user_id").cast("int").alias("y"), F.floor("value").cast("int").alias("x")).agg(F.max(1 + F.col("event_id") % 3).alias("label"))
    return tiles.boundary(p)


@query("""WITH RECURSIVE hit AS (SELECT DISTINCT CAST(user_id % 16 AS INTEGER) AS y, CAST(floor(value * 16 / 491) AS INTEGER) AS x FROM events WHERE value < 300),
f(y0, x0, y1, x1) AS (SELECT 0, 0, 16, 16 UNION ALL
 SELECT ys.lo, xs.lo, ys.hi, xs.hi FROM (
  SELECT unnest(CASE WHEN y1 - y0 > 2 THEN [{'lo': y0, 'hi': (y0 + y1) // 2}, {'lo': (y0 + y1) // 2, 'hi': y1}] ELSE [{'lo': y0, 'hi': y1}] END) AS ys, x0, x1 FROM (
   SELECT f.y0, f.x0, f.y1, f.x1, (SELECT count(*) FROM hit WHERE hit.y >= f.y0 AND hit.y < f.y1 AND hit.x >= f.x0 AND hit.x < f.x1)::DOUBLE / ((f.y1 - f.y0) * (f.x1 - f.x0)) AS p FROM f)
  WHERE p > 0.05 AND NOT (y1 - y0 <= 8 AND x1 - x0 <= 8 AND ((p >= 0.6 AND least(y1 - y0, x1 - x0) >= 2) OR (y1 - y0 <= 2 AND x1 - x0 <= 2)))) a,
  LATERAL (SELECT unnest(CASE WHEN a.x1 - a.x0 > 2 THEN [{'lo': a.x0, 'hi': (a.x0 + a.x1) // 2}, {'lo': (a.x0 + a.x1) // 2, 'hi': a.x1}] ELSE [{'lo': a.x0, 'hi': a.x1}] END) AS xs) b),
g AS (SELECT f.y0, f.x0, f.y1, f.x1, (SELECT count(*) FROM hit WHERE hit.y >= f.y0 AND hit.y < f.y1 AND hit.x >= f.x0 AND hit.x < f.x1)::DOUBLE / ((f.y1 - f.y0) * (f.x1 - f.x0)) AS p FROM f),
t AS (SELECT y0 * 128 - 4 AS a, x0 * 128 - 4 AS b, y1 * 128 + 4 AS c, x1 * 128 + 4 AS d FROM g WHERE p > 0.05 AND y1 - y0 <= 8 AND x1 - x0 <= 8 AND ((p >= 0.6 AND least(y1 - y0, x1 - x0) >= 2) OR (y1 - y0 <= 2 AND x1 - x0 <= 2)))
SELECT DISTINCT 1 AS slide, greatest(0, a) AS y0, greatest(0, b) AS x0, least(2048, c) AS y1, least(2048, d) AS x1 FROM t""")
def adaptive_tiles(spark, d):
    """Tiles over a mask of 16 x 16 pixels (128 native pixels each) whose tissue are the places of events."""
    at = F.col("user_id") % 16
    hit = table(spark, d, "events").filter("value < 300").select(at.cast("int").alias("y"), F.floor(F.col("value") * 16 / 491).cast("int").alias("x"), F.lit(1).alias("t")).distinct()
    grid = spark.range(16 * 16).select(F.lit(1).alias("slide"), F.floor(F.col("id") / 16).cast("int").alias("y"), (F.col("id") % 16).cast("int").alias("x"))
    mask = grid.join(hit, ["y", "x"], "left").select("slide", "y", "x", F.coalesce("t", F.lit(0)).cast("long").alias("tissue"))
    boxes = spark.createDataFrame([(1, 0, 0, 16, 16)], "slide int, y0 int, x0 int, y1 int, x1 int")
    return tiler.adaptive_tiles(boxes, tiler.prefix_sums(mask), 128, 2048, 2048, 1024, 256, overlap=8)


@query("""SELECT n_name AS dataset, printf('sdP%.2f_sdN%.2f_vpx%d_cl%s', p.p, n.n, r.r, c.c) AS run_tag FROM nation, (VALUES (0.3::DOUBLE), (0.35)) p(p), (VALUES (0.5::DOUBLE), (0.6)) n(n),
 (VALUES (1), (3), (5)) r(r), (VALUES ('fine'), ('coarse')) c(c)""")
def sweep_grid(spark, d):
    from .plans.sweep import grid_over

    datasets = table(spark, d, "nation").select("n_name")
    return grid_over(datasets, "n_name", prob=[0.3, 0.35], nms=[0.5, 0.6], growth=[1, 3, 5], config=["fine", "coarse"]).select("dataset", "run_tag")


@query("SELECT s_suppkey AS cell_id, 1::BIGINT AS rings, 9::BIGINT AS points, 's' || s_suppkey AS name FROM supplier")
def geojson_roundtrip(spark, d):
    """Outlines as features, one a line, and read back with their properties."""
    from .sources import geojson

    k = F.col("s_suppkey")
    xs, ys = geometry.octagon((k * 37) % 100 + 0.013, (k * 53) % 100 + 0.017, F.lit(4.0) + (k % 3).cast("double"))
    props = F.create_map(F.lit("name"), F.concat(F.lit("s"), k.cast("string")))
    rings = table(spark, d, "supplier").select(k.alias("cell_id"), F.lit(0).alias("part"), F.lit(0).alias("ring"), xs.alias("xs"), ys.alias("ys"), props.alias("props"))
    back = geojson.parse_lines(geojson.to_features(rings))
    return back.groupBy("cell_id").agg(F.count(F.lit(1)).alias("rings"), F.sum(F.size("xs")).alias("points"), F.min(F.col("props")["name"]).alias("name"))


from . import catalogue_pixels, catalogue_shapes  # noqa: E402,F401  register their queries
