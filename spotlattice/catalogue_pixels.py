"""Queries over pixels, outlines and bundles, and their SQL; part of the catalogue.

Stand-ins: a grey picture is made of events, pooled by place, dark inside an ellipse; outlines are
the octagons around suppliers, drawn on a grid of whole numbers.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from . import functions as fn
from .catalogue import CELLS_SQL, MAD_SQL, MATRIX_SQL, QC_SQL, STATS_SQL, _metrics, _stats, _values, cell_matrix, cells, counts, genes, query, rounded, spots, table
from .operators import assign, expression, geometry, matrix, raster, segment, tiles
from .session import spread

GRAY_SQL = """gray AS (SELECT CAST(user_id // 5 AS INTEGER) AS y, CAST(floor(value / 8) AS INTEGER) AS x,
 round(avg((CASE WHEN ((user_id - 75) / 60.0::DOUBLE) * ((user_id - 75) / 60.0::DOUBLE) + ((value - 245) / 200) * ((value - 245) / 200) < 1 THEN 0.3::DOUBLE ELSE 0.9 END) + (event_id % 11) / 100.0::DOUBLE), 6) AS gray
 FROM events GROUP BY 1, 2)"""
OTSU_SQL = GRAY_SQL + """, ge AS (SELECT min(gray) AS lo, max(gray) AS hi FROM gray),
gh AS (SELECT CAST(least(255, floor((gray - lo) / (hi - lo) * 256)) AS INTEGER) AS bin, count(*)::DOUBLE AS n, lo, hi FROM gray, ge GROUP BY 1, lo, hi),
gm AS (SELECT bin, n, lo + (bin + 0.5::DOUBLE) * (hi - lo) / 256 AS mid FROM gh),
gs AS (SELECT bin, mid, sum(n) OVER (ORDER BY bin) AS w0, sum(n * mid) OVER (ORDER BY bin) AS s0, sum(n) OVER () AS w, sum(n * mid) OVER () AS s FROM gm),
otsu AS (SELECT mid AS threshold FROM gs WHERE w > w0 ORDER BY round(w0 * (w - w0) * (s0 / w0 - (s - s0) / (w - w0)) * (s0 / w0 - (s - s0) / (w - w0)), 6) DESC, bin LIMIT 1)"""


def gray_picture(spark, d):
    v, u = F.col("value"), F.col("user_id")
    inside = ((u - 75) / 60.0) * ((u - 75) / 60.0) + ((v - 245) / 200) * ((v - 245) / 200) < 1
    g = F.when(inside, F.lit(0.3)).otherwise(F.lit(0.9)) + (F.col("event_id") % 11) / F.lit(100.0)
    return table(spark, d, "events").groupBy(F.floor(u / 5).cast("int").alias("y"), F.floor(v / 8).cast("int").alias("x")).agg(F.round(F.avg(g), 6).alias("gray"))


def _disk_sql(r: int) -> str:
    return "(VALUES " + ", ".join(f"({a}, {b})" for a, b in raster.disk(r)) + ") o(dy, dx)"


def _dilate_sql(out: str, src: str, r: int) -> str:
    return f"{out} AS (SELECT DISTINCT y + dy AS y, x + dx AS x FROM {src}, {_disk_sql(r)})"


def _erode_sql(out: str, src: str, r: int) -> str:
    return f"{out} AS (SELECT y + dy AS y, x + dx AS x FROM {src}, {_disk_sql(r)} GROUP BY 1, 2 HAVING count(*) = {len(raster.disk(r))})"


def _components_sql(out: str, src: str) -> str:
    """Pixels of ``src`` with the smallest pixel they reach, by closure."""
    return f"""{out}_nb AS (SELECT a.y, a.x, b.y AS y2, b.x AS x2 FROM {src} a JOIN {src} b ON a.y + dy.v = b.y AND a.x + dy.w = b.x),
{out}_reach(ry, rx, y, x) AS (SELECT y, x, y, x FROM {src} UNION SELECT r.ry, r.rx, n.y2, n.x2 FROM {out}_reach r JOIN {out}_nb n ON r.y = n.y AND r.x = n.x),
{out} AS (SELECT y, x, min(CAST(ry AS BIGINT) * 4294967296 + rx) AS label FROM {out}_reach GROUP BY 1, 2)""".replace(
        f"FROM {src} a JOIN {src} b ON a.y + dy.v = b.y AND a.x + dy.w = b.x", f"FROM {src} a, (VALUES (0, 1), (0, -1), (1, 0), (-1, 0)) s(v, w) JOIN {src} b ON a.y + s.v = b.y AND a.x + s.w = b.x"
    )


MORPH_SQL = ", ".join([OTSU_SQL, "dark AS (SELECT y, x FROM gray, otsu WHERE gray < least(threshold, 0.95))", _erode_sql("o1", "dark", 2), _dilate_sql("o2", "o1", 2), _dilate_sql("c1", "o2", 3), _erode_sql("c2", "c1", 3)])
MASK_SQL = MORPH_SQL + """, bx AS (SELECT min(y) AS a, max(y) AS b, min(x) AS c, max(x) AS d FROM c2),
bg AS (SELECT y.y, x.x FROM bx, range(-50, 200) y(y), range(-50, 200) x(x) WHERE y.y BETWEEN a AND b AND x.x BETWEEN c AND d EXCEPT SELECT y, x FROM c2), """ + _components_sql("hole", "bg") + """,
filled AS (SELECT y, x FROM c2 UNION SELECT y, x FROM hole WHERE label IN (SELECT label FROM hole GROUP BY 1 HAVING count(*) < 32)), """ + _components_sql("obj", "filled") + """,
tissue AS (SELECT y, x FROM obj WHERE label IN (SELECT label FROM obj GROUP BY 1 HAVING count(*) >= 64))"""


@query(f"WITH {OTSU_SQL} SELECT round(threshold, 6) AS threshold FROM otsu")
def otsu_threshold(spark, d):
    return rounded(raster.otsu(gray_picture(spark, d)), "threshold")


@query(f"WITH {MORPH_SQL} SELECT CAST(y AS INTEGER) AS y, CAST(x AS INTEGER) AS x FROM c2")
def mask_morphology(spark, d):
    """Open and close by disks."""
    g = gray_picture(spark, d)
    at = raster.otsu(g)
    dark = g.crossJoin(F.broadcast(at)).filter(F.col("gray") < F.least("threshold", F.lit(0.95))).select("y", "x")
    return raster.closed(raster.opened(dark, 2), 3)


@query(f"WITH RECURSIVE {MASK_SQL} SELECT CAST(y AS INTEGER) AS y, CAST(x AS INTEGER) AS x FROM tissue")
def tissue_mask(spark, d):
    return raster.tissue_mask(gray_picture(spark, d))


BRIGHT_SQL = GRAY_SQL + ", lit AS (SELECT y, x FROM gray WHERE gray > 0.96 OR gray < 0.33), " + _components_sql("comp", "lit")


@query(f"WITH RECURSIVE {BRIGHT_SQL} SELECT label, count(*) AS area, min(y) AS y0, min(x) AS x0, max(y) + 1 AS y1, max(x) + 1 AS x1 FROM comp GROUP BY 1")
def mask_components(spark, d):
    g = gray_picture(spark, d).filter("gray > 0.96 or gray < 0.33")
    return raster.component_boxes(raster.label_components(g.select("y", "x")))


@query(f"WITH RECURSIVE {BRIGHT_SQL} SELECT y, x, label FROM comp WHERE label IN (SELECT label FROM comp GROUP BY 1 HAVING count(*) >= 5)")
def objects_kept(spark, d):
    """Small objects dropped."""
    g = gray_picture(spark, d).filter("gray > 0.96 or gray < 0.33")
    return raster.drop_small(raster.label_components(g.select("y", "x")), 5)


def _raster_sql(out: str, grow: int) -> str:
    return f"""{out}_v AS (SELECT s_suppkey AS cell_id, i, (s_suppkey * 37) % 100 + 0.013::DOUBLE + ({4 + grow}.0 + s_suppkey % 3)::DOUBLE * c::DOUBLE AS x, (s_suppkey * 53) % 100 + 0.017::DOUBLE + ({4 + grow}.0 + s_suppkey % 3)::DOUBLE * s::DOUBLE AS y FROM supplier, v),
{out}_e AS (SELECT a.cell_id, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM {out}_v a JOIN {out}_v b ON a.cell_id = b.cell_id AND b.i = (a.i + 1) % 8),
{out}_b AS (SELECT cell_id, min(x) AS xl, max(x) AS xh, min(y) AS yl, max(y) AS yh FROM {out}_v GROUP BY 1),
{out}_p AS (SELECT cell_id, y.y AS py, x.x AS px FROM {out}_b, range(0, 120) y(y), range(0, 120) x(x) WHERE y.y BETWEEN yl AND yh AND x.x BETWEEN xl AND xh),
{out}_h AS (SELECT cell_id, py, px FROM {out}_p JOIN {out}_e USING (cell_id) GROUP BY 1, 2, 3 HAVING sum(CASE WHEN (y1 > py) <> (y2 > py) AND px < (x2 - x1) * (py - y1) / nullif(y2 - y1, 0) + x1 THEN 1 ELSE 0 END) % 2 = 1),
{out} AS (SELECT CAST(py AS INTEGER) AS y, CAST(px AS INTEGER) AS x, max(cell_id) AS cell_id FROM {out}_h GROUP BY 1, 2)"""


BEFORE_SQL = CELLS_SQL + ", " + _raster_sql("rb", 0)
BOTH_SQL = BEFORE_SQL + ", " + _raster_sql("ra", 1)
EDGE_SQL = "{out} AS (SELECT a.y, a.x FROM {src} a LEFT JOIN {src} b ON a.cell_id = b.cell_id AND ((a.y = b.y AND a.x = b.x + 1) OR (a.y = b.y AND a.x = b.x - 1) OR (a.x = b.x AND a.y = b.y + 1) OR (a.x = b.x AND a.y = b.y - 1)) GROUP BY 1, 2 HAVING count(b.cell_id) < 4)"
CHANGE_SQL = "SELECT coalesce(b.y, a.y) AS y, coalesce(b.x, a.x) AS x, CASE WHEN b.y IS NULL THEN 'grown' WHEN a.y IS NULL THEN 'shrunk' ELSE 'both' END AS change FROM {b} b FULL OUTER JOIN {a} a ON a.y = b.y AND a.x = b.x"


def _drawn(spark, d, grow: int = 0):
    return raster.rasterise(cells(spark, d, 4.0 + grow), "cell_id", 120, 120)


@query(f"WITH {BEFORE_SQL} SELECT * FROM rb")
def rasterised_cells(spark, d):
    return _drawn(spark, d)


@query(f"WITH {BEFORE_SQL} SELECT cell_id, round(avg(y), 6) AS cy, round(avg(x), 6) AS cx, count(*) AS area FROM rb GROUP BY 1")
def label_centroids(spark, d):
    return rounded(raster.label_centroids(_drawn(spark, d), "cell_id"), "cy", "cx")


@query(f"WITH {BOTH_SQL} {CHANGE_SQL.format(b='rb', a='ra')}")
def growth_masks(spark, d):
    """Pixels that growing outlines adds, takes or leaves."""
    return raster.changed(_drawn(spark, d), _drawn(spark, d, 1))


@query(f"WITH {BOTH_SQL}, {EDGE_SQL.format(out='eb', src='rb')}, {EDGE_SQL.format(out='ea', src='ra')} {CHANGE_SQL.format(b='eb', a='ea')}")
def boundary_change(spark, d):
    """Outlines drawn before and after: both, only before, only after."""
    own = lambda grow: tiles.boundary(_drawn(spark, d, grow).withColumn("cell_id", F.col("cell_id") + 1), "cell_id").select("y", "x")  # noqa: E731  0 is no label
    return raster.changed(own(0), own(1))


@query("SELECT CAST(y AS INTEGER) AS y, CAST(x AS INTEGER) AS x, max(label) AS label FROM (SELECT user_id AS y, floor(value) AS x, 1 + event_id % 50 AS label FROM events) GROUP BY 1, 2")
def overlap_max_wins(spark, d):
    p = table(spark, d, "events").select(F.col("user_id").cast("int").alias("y"), F.floor("value").cast("int").alias("x"), (1 + F.col("event_id") % 50).alias("label"))
    return raster.max_wins(p)


@query(f"WITH {BEFORE_SQL} SELECT event_id AS spot, coalesce(cell_id, 0) AS cell_id FROM events LEFT JOIN rb ON rb.y = round_even(CAST(user_id AS DOUBLE), 0) AND rb.x = round_even(value, 0)")
def label_lookup(spark, d):
    return raster.label_at(spots(spark, d), _drawn(spark, d), label="cell_id").select("spot", "cell_id")


GATE_SQL = """ok AS (SELECT DISTINCT user_id // 4 AS ty, CAST(floor(value / 4) AS BIGINT) AS tx FROM events WHERE value < 70),
cen AS (SELECT cell_id, sum((x1 + x2) * (x1 * y2 - x2 * y1)) / (6 * sum(x1 * y2 - x2 * y1) / 2) AS cx, sum((y1 + y2) * (x1 * y2 - x2 * y1)) / (6 * sum(x1 * y2 - x2 * y1) / 2) AS cy, abs(sum(x1 * y2 - x2 * y1) / 2) AS area FROM e GROUP BY 1)"""


def _tissue4(spark, d):
    return table(spark, d, "events").filter("value < 70").select(F.floor(F.col("user_id") / 4).alias("y"), F.floor(F.col("value") / 4).alias("x")).distinct()


@query(f"WITH {CELLS_SQL}, {GATE_SQL} SELECT cell_id FROM cen SEMI JOIN ok ON floor(cy / 4) = ty AND floor(cx / 4) = tx WHERE area >= 60")
def polygon_gate(spark, d):
    """Valid, large enough, centroid on tissue."""
    return raster.polygon_gate(cells(spark, d), _tissue4(spark, d), 4, 60.0).select("cell_id")


@query("""WITH ok AS (SELECT DISTINCT user_id // 4 AS ty, CAST(floor(value / 4) AS BIGINT) AS tx FROM events WHERE value < 70)
SELECT event_id AS spot FROM events SEMI JOIN ok ON user_id // 4 = ty AND CAST(floor(value / 4) AS BIGINT) = tx""")
def tissue_lookup(spark, d):
    return raster.on_mask(spots(spark, d), _tissue4(spark, d), 4).select("spot")


@query(f"""WITH {GRAY_SQL}, t AS (SELECT CAST(floor(y / 8) AS BIGINT) AS ty, CAST(floor(x / 8) AS BIGINT) AS tx, avg(CASE WHEN gray < 0.6 THEN 1.0::DOUBLE ELSE 0 END) AS f, stddev_pop(gray) AS s FROM gray GROUP BY 1, 2)
SELECT ty, tx, round(f, 6) AS tissue_frac, round(s, 6) AS std FROM t WHERE f >= 0.02 AND s >= 1e-3""")
def tile_gate(spark, d):
    px = gray_picture(spark, d).withColumn("tissue", (F.col("gray") < 0.6).cast("int"))
    return rounded(raster.tile_gate(px, 8), "tissue_frac", "std")


@query(f"""WITH {GRAY_SQL}, t AS (SELECT *, y // 8 AS ty, x // 8 AS tx FROM gray), q AS (SELECT ty, tx, quantile_cont(gray, 0.01) AS lo, quantile_cont(gray, 0.998) AS hi FROM t GROUP BY 1, 2)
SELECT y, x, round(coalesce((gray - lo) / nullif(hi - lo, 0), 0), 6) AS gray FROM t JOIN q USING (ty, tx)""")
def percentile_normalised(spark, d):
    px = gray_picture(spark, d).withColumn("ty", F.floor(F.col("y") / 8)).withColumn("tx", F.floor(F.col("x") / 8))
    return rounded(raster.percentile_normalise(px, ["ty", "tx"], "gray"), "gray").select("y", "x", "gray")


@query(f"WITH {CELLS_SQL} SELECT cell_id, CAST(i AS INTEGER) AS i, round(x / 2 + 100 * (cell_id % 7), 6) AS x, round(y / 2 + 50 * (cell_id % 5), 6) AS y FROM p")
def tile_to_slide(spark, d):
    """Vertices in tile coordinates (enlarged twice) on the slide; the tile's origin is made of the id."""
    k = F.col("s_suppkey")
    xs, ys = geometry.octagon((k * 37) % 100 + 0.013, (k * 53) % 100 + 0.017, F.lit(4.0) + (k % 3).cast("double"))
    t = table(spark, d, "supplier").select(k.alias("cell_id"), F.arrays_zip(ys.alias("y"), xs.alias("x")).alias("points"))
    out = t.select("cell_id", F.posexplode(raster.tile_to_slide(F.col("points"), 50 * (F.col("cell_id") % 5), 100 * (F.col("cell_id") % 7), 2.0)).alias("i", "p"))
    return out.select("cell_id", "i", F.round("p.x", 6).alias("x"), F.round("p.y", 6).alias("y"))


REP_SQL = """md AS (SELECT cell_id, (min(y) + max(y)) / 2 AS mid FROM p GROUP BY 1), rl AS (SELECT cell_id, (max(y) FILTER (y <= mid) + min(y) FILTER (y > mid)) / 2 AS ry FROM p JOIN md USING (cell_id) GROUP BY 1),
rep AS (SELECT cell_id, ry, (min(c) + max(c)) / 2 AS rx FROM (SELECT cell_id, ry, (x2 - x1) * (ry - y1) / (y2 - y1) + x1 AS c FROM rl JOIN e USING (cell_id) WHERE (y1 > ry) <> (y2 > ry)) GROUP BY 1, 2)"""


@query(f"WITH {CELLS_SQL}, {REP_SQL} SELECT cell_id, round(rx, 6) AS x, round(ry, 6) AS y FROM rep")
def representative_points(spark, d):
    at = F.inline(F.array(geometry.representative(F.col("edges"))))
    return rounded(spread(cells(spark, d), "cell_id").select("cell_id", at), "x", "y")


@query(f"WITH {CELLS_SQL}, {REP_SQL} SELECT cell_id FROM rep WHERE rx > 20 AND rx < 60 AND ry > 10 AND ry < 90")
def roi_cells(spark, d):
    """Outlines with a representative point inside a region of interest."""
    rois = spark.createDataFrame([("a", [20.0, 60.0, 60.0, 20.0], [10.0, 10.0, 90.0, 90.0])], "roi string, xs array<double>, ys array<double>")
    return assign.region_filter(cells(spark, d), geometry.region_edges(rois, "roi")).select("cell_id")


@query("SELECT s_suppkey AS cell_id, s_suppkey % 3 <> 0 AS valid FROM supplier")
def polygon_validity(spark, d):
    """Every third outline is a bow-tie whose edges cross."""
    k, c = F.col("s_suppkey"), lambda v: F.lit(float(v))
    bow = (k % 3) == 0
    xs = F.when(bow, F.array(c(0), c(2), c(0), c(3))).otherwise(F.array(c(0), c(2), c(2), c(0)))
    ys = F.when(bow, F.array(c(0), c(2), c(2), c(-1))).otherwise(F.array(c(0), c(0), c(2), c(2)))
    return table(spark, d, "supplier").select(k.alias("cell_id"), geometry.is_simple(geometry.ring_edges(xs, ys)).alias("valid"))


@query("SELECT event_id AS spot FROM events WHERE value >= 0 AND value < 300 AND user_id >= 0 AND user_id < 100")
def in_bounds(spark, d):
    return raster.in_bounds(spots(spark, d), 100, 300).select("spot")


@query("SELECT event_type AS cluster, greatest(0, min(value) - 50) AS x0, least(400, max(value) + 50) AS x1, greatest(0, min(user_id)::DOUBLE - 50) AS y0, least(150, max(user_id)::DOUBLE + 50) AS y1 FROM events WHERE value < 380 GROUP BY 1")
def cluster_crop_box(spark, d):
    return raster.fixed_bounds(spots(spark, d).filter("x < 380"), 50, 150, 400, "cluster")


@query("""WITH b AS (SELECT event_type AS c, greatest(0, min(value) - 20) AS x0, least(500, max(value) + 20) AS x1, greatest(0, min(user_id)::DOUBLE - 20) AS y0, least(150, max(user_id)::DOUBLE + 20) AS y1 FROM events GROUP BY 1),
s AS (SELECT *, least(1, 300 / greatest(x1 - x0, y1 - y0)) AS k FROM b)
SELECT event_id AS spot, c AS cluster, round((value - x0) * k, 6) AS x, round((user_id - y0) * k, 6) AS y, round(k, 6) AS scale FROM events JOIN s ON event_type = c""")
def cluster_crop(spark, d):
    """Points of a cluster in a picture of its own, scaled down where that is too large."""
    s = spots(spark, d)
    return rounded(raster.crop_points(s, raster.fixed_bounds(s, 20, 150, 500, "cluster"), "cluster", 300.0), "x", "y", "scale")


@query("WITH t AS (SELECT CAST(floor(user_id / 64.0) AS BIGINT) AS ty, CAST(floor(value / 64.0) AS BIGINT) AS tx, count(*) AS n FROM events WHERE value < 400 GROUP BY 1, 2) SELECT event_id AS spot, n FROM events LEFT JOIN t ON CAST(floor(user_id / 64.0) AS BIGINT) = ty AND CAST(floor(value / 64.0) AS BIGINT) = tx")
def tile_value_at(spark, d):
    t = tiles.tile_histogram(spots(spark, d).filter("x < 400").withColumn("cluster", F.lit(1))).select("ty", "tx", "n")
    return raster.tile_value_at(spots(spark, d), t, 64, "n").select("spot", "n")


@query("SELECT s_suppkey AS cell_id FROM supplier ORDER BY md5('7:' || s_suppkey), s_suppkey LIMIT 12")
def cell_sample(spark, d):
    return raster.seeded_sample(table(spark, d, "supplier").select(F.col("s_suppkey").alias("cell_id")), "cell_id", 12, 7)


@query("""WITH t AS (SELECT DISTINCT event_type AS slide, CAST(user_id // 50 * 50 AS INTEGER) AS y0, CAST(floor(value / 100) * 100 AS INTEGER) AS x0 FROM events)
SELECT slide, y0, x0, y0 + 50 AS y1, x0 + 100 AS x1, CAST(row_number() OVER (PARTITION BY slide ORDER BY y0, x0) AS INTEGER) AS place FROM t""")
def tiles_in_order(spark, d):
    y0, x0 = (F.floor(F.col("user_id") / 50) * 50).cast("int"), (F.floor(F.col("value") / 100) * 100).cast("int")
    return raster.tiles_in_order(table(spark, d, "events").select(F.col("event_type").alias("slide"), y0.alias("y0"), x0.alias("x0"), (y0 + 50).alias("y1"), (x0 + 100).alias("x1")))


@query("""WITH px AS (SELECT user_id // 50 AS ty, floor(value / 100) AS tx, user_id % 50 AS y, CAST(floor(value) AS BIGINT) % 100 AS x, max(event_id % 97) AS v FROM events GROUP BY ALL),
b AS (SELECT ty, tx, min(y) AS a, max(y) + 1 AS b, min(x) AS c, max(x) + 1 AS d FROM px WHERE v > 95 GROUP BY 1, 2)
SELECT CAST(ty * 50 AS INTEGER) AS y0, CAST(tx * 100 AS INTEGER) AS x0, CAST(ty * 50 + a AS DOUBLE) AS top, CAST(ty * 50 + b AS DOUBLE) AS bottom, tx * 100 + c AS "left", tx * 100 + d AS "right" FROM b""")
def predicted_outlines(spark, d):
    """The hook for a model: outlines that a stand-in finds in every tile, on the slide."""
    e = table(spark, d, "events").groupBy(F.floor(F.col("user_id") / 50).alias("ty"), F.floor(F.col("value") / 100).alias("tx"), (F.col("user_id") % 50).alias("y"), (F.floor("value") % 100).alias("x")).agg(F.max(F.col("event_id") % 97).alias("v"))
    m = spread(e.groupBy("ty", "tx").agg(F.collect_list(F.struct((F.col("y") * 100 + F.col("x")).cast("int").alias("k"), F.col("v").cast("double").alias("v"))).alias("m")), "ty", "tx")  # one tile of 50 x 100
    px = segment.dense(F.col("m.k"), F.col("m.v"), 5000)
    t = m.select(F.lit(1).alias("slide"), (F.col("ty") * 50).cast("int").alias("y0"), (F.col("tx") * 100).cast("int").alias("x0"), F.lit(50).alias("height"), F.lit(100).alias("width"), px.alias("pixels"))
    o = segment.predict_tiles(t, segment.bright_boxes(95.0), 2.0)
    return o.select("y0", "x0", F.array_min("ys").alias("top"), F.array_max("ys").alias("bottom"), F.array_min("xs").alias("left"), F.array_max("xs").alias("right"))


KEEP_SQL = MAD_SQL + """, lim AS (SELECT max(CASE WHEN metric = 'n_umi' THEN median - 1.5 * mad END) AS u, max(CASE WHEN metric = 'n_genes' THEN median - 1.5 * mad END) AS g, max(CASE WHEN metric = 'pct_mito' THEN median + 1.5 * mad END) AS p FROM mad),
keep AS (SELECT *, coalesce(n_umi >= u AND n_genes >= g AND pct_mito <= least(p, 60) AND n_genes >= 20 AND n_umi >= 50 AND top5_frac <= 0.9, false) AS qc_keep FROM qc, lim)"""


def _kept(spark, d):
    return matrix.qc_keep(_metrics(spark, d), 1.5, 20, 50, 60.0, 0.9)


def _calls(spark, d):
    """Stand-in for doublet calls: every ninth cell."""
    return table(spark, d, "supplier").select(F.col("s_suppkey").alias("cell"), (F.col("s_suppkey") % 9 == 0).alias("doublet_call"))


@query(f"WITH {KEEP_SQL} SELECT cell, n_umi, n_genes FROM keep WHERE qc_keep AND cell % 9 <> 0")
def qc_filtered(spark, d):
    """Cells that pass and are no doublets."""
    return matrix.final_keep(_kept(spark, d), _calls(spark, d)).select("cell", "n_umi", "n_genes")


@query(f"WITH {KEEP_SQL} SELECT m.cell, m.gene, m.n FROM m JOIN keep USING (cell) JOIN part ON gene = p_partkey WHERE qc_keep AND cell % 9 <> 0 AND p_size > 10")
def filtered_bundle(spark, d):
    """The matrix of a filtered bundle: kept cells, chosen genes."""
    obs = matrix.final_keep(_kept(spark, d), _calls(spark, d))
    var = table(spark, d, "part").filter("p_size > 10").select(F.col("p_partkey").alias("gene"))
    return matrix.filter_bundle(cell_matrix(spark, d), obs, var)[0]


@query(f"""WITH {KEEP_SQL} SELECT count(*) AS n_cells_raw, count(*) FILTER (qc_keep AND cell % 9 <> 0) AS n_cells_kept, count(*) FILTER (NOT qc_keep) AS n_failed_qc, count(*) FILTER (cell % 9 = 0) AS n_doublets,
 (SELECT round(median, 6) FROM mad WHERE metric = 'n_umi') AS umi_median, (SELECT round(mad, 6) FROM mad WHERE metric = 'n_umi') AS umi_mad FROM keep""")
def qc_report(spark, d):
    r = matrix.qc_report(_kept(spark, d), _calls(spark, d), {"mad_mult": 1.5})
    lim = lambda k: F.get_json_object("limits", f"$.n_umi.{k}").cast("double")
    return r.select("n_cells_raw", "n_cells_kept", "n_failed_qc", "n_doublets", lim("median").alias("umi_median"), lim("mad").alias("umi_mad"))


@query(f"WITH {QC_SQL} SELECT cell, n_umi FROM qc WHERE n_umi >= 15000")
def min_counts(spark, d):
    return matrix.min_counts(_metrics(spark, d), 15000).select("cell", "n_umi")


@query(f"WITH {QC_SQL} SELECT cell, n_umi, n_genes, 0.0::DOUBLE AS pct_mito, round(pct_ribo, 6) AS pct_ribo FROM qc")
def default_columns(spark, d):
    """A table that lacks columns: counts are counted again, the percentage is 0."""
    bare = _metrics(spark, d).drop("n_umi", "n_genes", "pct_mito")
    return rounded(matrix.with_defaults(bare, cell_matrix(spark, d)), "pct_ribo").select("cell", "n_umi", "n_genes", "pct_mito", "pct_ribo")


@query(f"WITH {MATRIX_SQL}, k AS (SELECT count(DISTINCT cell)::DOUBLE AS k FROM m) SELECT gene, count(*) FILTER (n > 0) AS n_cells, CAST(sum(n) AS BIGINT) AS total_counts, round(sum(n) / max(k), 6) AS mean_counts, round(100 * (1 - count(*) FILTER (n > 0) / max(k)), 6) AS pct_dropout FROM m, k GROUP BY gene")
def gene_metrics(spark, d):
    n = counts(spark, d).select("cell").distinct().count()
    return rounded(matrix.gene_metrics(cell_matrix(spark, d), n), "mean_counts", "pct_dropout")


@query(f"""WITH {QC_SQL}, z AS (SELECT min(n_umi)::DOUBLE AS xl, max(n_umi)::DOUBLE AS xh, min(n_genes)::DOUBLE AS yl, max(n_genes)::DOUBLE AS yh FROM qc)
SELECT CAST(coalesce(least(9, floor((n_umi - xl) / nullif(xh - xl, 0) * 10)), 0) AS INTEGER) AS bx, CAST(coalesce(least(9, floor((n_genes - yl) / nullif(yh - yl, 0) * 10)), 0) AS INTEGER) AS "by", count(*) AS n FROM qc, z GROUP BY 1, 2""")
def qc_scatter_bins(spark, d):
    return matrix.bins_2d(_metrics(spark, d), "n_umi", "n_genes", 10, 10)


@query()
def hvg_stabilised(spark, d):
    """Variable genes by the variance-stabilised flavour; tests compare it with numpy."""
    n = counts(spark, d).select("cell").distinct().count()
    return expression.stabilised_genes(_values(spark, d), n, 100)


@query(f"""WITH {STATS_SQL}, b AS (SELECT *, coalesce(var / nullif(mean, 0), 0) AS disp, ntile(20) OVER (ORDER BY mean, gene) AS bin FROM st),
d AS (SELECT gene, disp - avg(disp) OVER (PARTITION BY bin) AS off, stddev_samp(disp) OVER (PARTITION BY bin) AS sd FROM b),
g AS (SELECT gene FROM d ORDER BY round(off / CASE WHEN sd > 0 THEN sd ELSE 1 END, 6) DESC, gene LIMIT 50) SELECT cell, gene, n FROM m SEMI JOIN g USING (gene)""")
def hvg_subset(spark, d):
    """Counts of the 50 most variable genes."""
    g = expression.variable_genes(_stats(spark, d), 50)
    return expression.gene_subset(cell_matrix(spark, d), g)


@query("""WITH f AS (SELECT event_id AS seq, value AS cx, CAST(user_id AS DOUBLE) AS cy, (user_id * 7 + CAST(floor(value) AS BIGINT)) % 211 AS label FROM events),
r AS (SELECT DISTINCT label, CASE WHEN label = 0 THEN round_even(cy, 0) END AS a, CASE WHEN label = 0 THEN round_even(cx, 0) END AS b FROM f)
SELECT (SELECT count(*) FROM f) AS found, (SELECT count(*) FROM r) AS kept, (SELECT count(*) FROM f) - (SELECT count(*) FROM r) AS removed""")
def dedup_stats(spark, d):
    from .catalogue import polygon_dedup

    return matrix.dedup_stats(table(spark, d, "events"), polygon_dedup(spark, d))


@query(f"""WITH {CELLS_SQL}, a AS (SELECT spot, min(cell_id) AS cell_id FROM hit WHERE odd OR edge GROUP BY spot), t AS (SELECT l_orderkey AS spot, CAST(sum(CAST(round(l_quantity) AS BIGINT)) AS BIGINT) AS n FROM lineitem GROUP BY 1)
SELECT event_id AS spot, value AS x, CAST(user_id AS DOUBLE) AS y, coalesce(n, 0) AS spot_counts, CASE WHEN cell_id IS NULL THEN 0 ELSE 1 END AS assigned FROM events LEFT JOIN t ON t.spot = event_id LEFT JOIN a ON a.spot = event_id""")
def spot_counts_assigned(spark, d):
    s = spots(spark, d)
    totals = counts(spark, d).groupBy("spot").agg(F.sum("n").alias("n"))
    return matrix.spot_table(s, totals, assign.assign_spots(s, cells(spark, d)))


@query("""SELECT c_custkey AS k, 'cell_' || c_custkey AS name, CASE WHEN c_name LIKE '%0' THEN left(c_name, length(c_name) - 1) ELSE c_name END AS stem, CASE WHEN regexp_matches(c_name, '^[A-Za-z0-9_@%+=:,./-]+$') THEN c_name ELSE '''' || replace(c_name, '''', '''"''"''') || '''' END AS quoted,
 round(c_acctbal / 0.5::DOUBLE, 6) AS px, ['#1f77b4', '#ff7f0e', '#2ca02c', '#d62728', '#9467bd', '#8c564b', '#e377c2', '#7f7f7f', '#bcbd22', '#17becf', '#aec7e8', '#ffbb78', '#98df8a', '#ff9896', '#c5b0d5', '#c49c94', '#f7b6d2', '#c7c7c7', '#dbdb8d', '#9edae5'][1 + c_custkey % 20] AS colour FROM customer""")
def naming(spark, d):
    """Scalar helpers: names, suffixes, quoting, units, colours."""
    c = table(spark, d, "customer")
    return c.select(
        F.col("c_custkey").alias("k"), fn.cell_name(F.col("c_custkey")).alias("name"), fn.without_suffix(F.col("c_name"), "0").alias("stem"), fn.shell_quoted(F.col("c_name")).alias("quoted"),
        F.round(fn.pixels_of(F.col("c_acctbal"), 0.5), 6).alias("px"), fn.colour(F.col("c_custkey")).alias("colour"),
    )


@query("SELECT strftime(o_orderdate, '%Y%m%d') AS day, count(*) AS n FROM orders GROUP BY 1")
def day_stamps(spark, d):
    return table(spark, d, "orders").groupBy(fn.day_stamp(F.col("o_orderdate")).alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT p_brand AS brand, CASE WHEN count(DISTINCT p_name) = 1 THEN min(p_name) ELSE left(min(p_name), (SELECT count(*) FROM range(1, 1 + least(length(min(p_name)), length(max(p_name)))) r(k) WHERE left(min(p_name), k) = left(max(p_name), k))) END AS prefix FROM part GROUP BY 1")
def common_prefixes(spark, d):
    """Longest common start of the names of each group, of the least and the largest name: no list of all is made."""
    p = table(spark, d, "part").groupBy(F.col("p_brand").alias("brand")).agg(F.min("p_name").alias("a"), F.max("p_name").alias("b"))
    return p.select("brand", fn.common_prefix(F.array("a", "b")).alias("prefix"))
