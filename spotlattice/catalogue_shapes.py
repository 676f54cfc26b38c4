"""Queries over outlines, graph clusters and components, and their SQL; part of the catalogue.

Where SQL has no outline, it works convex shapes out from half-planes: the corners of an intersection
are those crossings of two lines that no third one cuts off.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .catalogue import CELLS_SQL, STATS_SQL, _metrics, _stats, _values, _vectors, cell_matrix, cells, counts, genes, query, rounded, spots, table
from .catalogue_pixels import BEFORE_SQL, _drawn
from .operators import descent, doublets, expression, geometry, leiden, matrix, neighbours, outline, sparse_pca, voronoi
from .plans import assignment, clustering
from .plans.stages import ClusterSettings
from .session import cut, shared_dir
from .sources import images

SITES_SQL = """s AS MATERIALIZED (SELECT s_suppkey AS k, (s_suppkey * 37) % 100 + 0.013::DOUBLE AS x, (s_suppkey * 53) % 100 + 0.017::DOUBLE AS y,
  4.0::DOUBLE + s_suppkey % 3 AS r FROM supplier)"""
#: Half-planes (nx * x + ny * y <= c) of each site against those within a distance.
BISECTORS_SQL = """SELECT a.k, b.x - a.x AS nx, b.y - a.y AS ny, ((b.x - a.x) * (b.x + a.x) + (b.y - a.y) * (b.y + a.y)) / 2 AS c
  FROM s a JOIN s b ON a.k <> b.k AND (b.x - a.x) * (b.x - a.x) + (b.y - a.y) * (b.y - a.y) < {far} * {far}"""
#: Areas (k, area) of what the half-planes in h leave: corners in order of their angle about the site.
CONVEX_SQL = """i AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY k ORDER BY nx, ny, c) AS n FROM h),
v AS (SELECT a.k, (a.c * b.ny - b.c * a.ny) / (a.nx * b.ny - b.nx * a.ny) AS x, (a.nx * b.c - b.nx * a.c) / (a.nx * b.ny - b.nx * a.ny) AS y
  FROM i a JOIN i b ON a.k = b.k AND a.n < b.n AND abs(a.nx * b.ny - b.nx * a.ny) > 1e-9),
o AS (SELECT DISTINCT k, round(x, 7) AS x, round(y, 7) AS y FROM v WHERE NOT EXISTS
  (SELECT 1 FROM h WHERE h.k = v.k AND h.nx * v.x + h.ny * v.y > h.c + 1e-7 * (1 + abs(h.nx) + abs(h.ny)))),
w AS (SELECT o.k, o.x, o.y, row_number() OVER (PARTITION BY o.k ORDER BY atan2(o.y - s.y, o.x - s.x)) AS n, count(*) OVER (PARTITION BY o.k) AS m FROM o JOIN s ON s.k = o.k),
area AS (SELECT a.k, sum(a.x * b.y - b.x * a.y) / 2 AS area FROM w a JOIN w b ON a.k = b.k AND b.n = a.n % a.m + 1 GROUP BY a.k)"""
BOX_SQL = """b AS (SELECT min(x - r) - 50 AS x0, min(y - r) - 50 AS y0, max(x + r) + 50 AS x1, max(y + r) + 50 AS y1 FROM s)"""


@query(f"""WITH {SITES_SQL}, {BOX_SQL}, h AS MATERIALIZED ({BISECTORS_SQL.format(far=1000)} UNION ALL SELECT k, -1, 0, -x0 FROM s, b
  UNION ALL SELECT k, 1, 0, x1 FROM s, b UNION ALL SELECT k, 0, -1, -y0 FROM s, b UNION ALL SELECT k, 0, 1, y1 FROM s, b), {CONVEX_SQL}
SELECT k AS cell_id, round(area, 3) AS area FROM area""")
def voronoi_cells(spark, d):
    """Areas of the territories of cells, in the cells' box with a border."""
    own = cells(spark, d)
    cx, cy = geometry.centroid(F.col("edges"))
    found = voronoi.voronoi_cells(own.select("cell_id", cx.alias("x"), cy.alias("y")), outline.envelope(own), 16.0, shared=True)
    return rounded(found.select("cell_id", "area"), "area", places=3)


GROWN_AREA_SQL = "16 * sin(pi() / 8) * r * 2 + 4 * 8 * sin(pi() / 4) / 8 * r * r + 32 * 4 * sin(pi() / 32)"


@query(f"""WITH {SITES_SQL} SELECT k AS cell_id, 0 AS part, 0 AS ring, round({GROWN_AREA_SQL}, 4) AS area FROM s""")
def buffered_cells(spark, d):
    """Octagons grown by 2: their own area, a strip along each side, and a polygon of 64 sides in their corners."""
    return rounded(outline.buffered(cells(spark, d), 2.0).select("cell_id", "part", "ring", "area"), "area", places=4)


@query(f"""WITH {SITES_SQL},
q AS (SELECT k, a, n, x + r * cos(pi() / 4 * a) + 2 * cos(pi() / 4 * a - pi() / 8 + pi() / 32 * n) AS x,
             y + r * sin(pi() / 4 * a) + 2 * sin(pi() / 4 * a - pi() / 8 + pi() / 32 * n) AS y FROM s, range(8) t(a), range(9) u(n)),
j AS (SELECT *, 9 * a + n AS p FROM q),
h AS MATERIALIZED (SELECT f.k, t.y - f.y AS nx, f.x - t.x AS ny, (t.y - f.y) * f.x + (f.x - t.x) * f.y AS c FROM j f JOIN j t ON f.k = t.k AND t.p = (f.p + 1) % 72
  UNION ALL {BISECTORS_SQL.format(far=17)}), {CONVEX_SQL},
z AS (SELECT area + 1e-5 < {GROWN_AREA_SQL} AS clipped, greatest(0, area - 2 * sqrt(2.0::DOUBLE) * r * r) AS gain FROM area JOIN s USING (k))
SELECT count(*) AS cells, count(*) FILTER (clipped) AS clipped, round(100 * avg(CAST(clipped AS INTEGER)), 6) AS clipped_pct,
       round(avg(gain), 4) AS mean_gain, round(median(gain), 4) AS median_gain FROM z""")
def dilation_summary(spark, d):
    """Cells grown by 2 within their territories: how many are cut, and what they gain."""
    return rounded(outline.dilation_figures(outline.dilate_capped(cells(spark, d), 2.0)), "mean_gain", "median_gain", places=4)


@query("""SELECT s_suppkey AS cell_id, CAST(p AS INTEGER) AS part, 0 AS ring, round((4.0::DOUBLE + s_suppkey % 3) * (4 + s_suppkey % 3) / 4, 4) AS area
FROM supplier, range(2) t(p)""")
def repaired_outlines(spark, d):
    """Outlines that cross themselves fall into two valid parts."""
    k = F.col("s_suppkey")
    x, y, r = (k * 37) % 100 + 0.013, (k * 53) % 100 + 0.017, 4.0 + k % 3
    edges = geometry.ring_edges(F.array(x, x + r, x + r, x), F.array(y, y + r, y, y + r))
    bow = table(spark, d, "supplier").select(k.alias("cell_id"), edges.alias("edges"))
    return rounded(outline.repaired_parts(bow).select("cell_id", "part", "ring", "area"), "area", places=4)


@query(f"""WITH RECURSIVE {SITES_SQL}, b AS (SELECT k, x - r AS x0, x + r AS x1, y - r AS y0, y + r AS y1 FROM s),
l AS (SELECT p.k AS a, q.k AS b FROM b p JOIN b q ON p.x0 <= q.x1 AND q.x0 <= p.x1 AND p.y0 <= q.y1 AND q.y0 <= p.y1),
c AS (SELECT k AS a, k AS b FROM b UNION SELECT c.a, l.b FROM c JOIN l ON c.b = l.a),
g AS (SELECT a AS k, min(b) AS g FROM c GROUP BY a),
xs AS (SELECT g, v AS lo, lead(v) OVER (PARTITION BY g ORDER BY v) AS hi FROM (SELECT g, unnest([x0, x1]) AS v FROM b JOIN g USING (k))),
ys AS (SELECT g, v AS lo, lead(v) OVER (PARTITION BY g ORDER BY v) AS hi FROM (SELECT g, unnest([y0, y1]) AS v FROM b JOIN g USING (k)))
SELECT xs.g AS "group", round(sum((xs.hi - xs.lo) * (ys.hi - ys.lo)), 4) AS area FROM xs JOIN ys USING (g)
WHERE xs.hi > xs.lo AND ys.hi > ys.lo AND EXISTS (SELECT 1 FROM b JOIN g USING (k) WHERE g.g = xs.g AND x0 <= xs.lo AND x1 >= xs.hi AND y0 <= ys.lo AND y1 >= ys.hi)
GROUP BY xs.g""")
def dissolved_boxes(spark, d):
    """Area of the union of each group of squares that overlap."""
    k = F.col("s_suppkey")
    x, y, r = (k * 37) % 100 + 0.013, (k * 53) % 100 + 0.017, 4.0 + k % 3
    edges = geometry.ring_edges(F.array(x - r, x + r, x + r, x - r), F.array(y - r, y - r, y + r, y + r))
    boxes = table(spark, d, "supplier").select(k.alias("cell_id"), edges.alias("edges"))
    return outline.dissolved(boxes).groupBy("group").agg(F.round(F.sum("area"), 4).alias("area"))


@query()
def knn_descent(spark, d):
    """Approximate neighbours of vectors, by descent."""
    return rounded(descent.descend(_vectors(spark, d), 19), "distance", places=6)


@query()
def leiden_clusters(spark, d):
    """Clusters of vectors by one iteration of Leiden on the fuzzy graph of approximate neighbours."""
    edges = cut(neighbours.fuzzy_weights(descent.descend(_vectors(spark, d), 19), 20))
    return leiden.leiden(edges, iterations=1).select(F.col("a").alias("vec_id"), "cluster")


@query(f"""WITH {STATS_SQL}, t100 AS (SELECT * FROM st ORDER BY var DESC, gene LIMIT 100),
z AS (SELECT g.gene, cell, least(10, (coalesce(value, 0) - mean) / CASE WHEN var > 0 THEN sqrt(var) ELSE 1 END) AS z
  FROM t100 g CROSS JOIN (SELECT DISTINCT cell FROM m) c LEFT JOIN norm USING (gene, cell)),
q AS (SELECT gene, var_samp(z) AS v FROM z GROUP BY gene)
SELECT (SELECT count(DISTINCT cell) FROM z) AS cells, count(*) AS genes, round(sum(v), 4) AS total, round(sum(v), 4) AS components FROM q""")
def component_variance(spark, d):
    """Of the 100 most variable genes, scaled: the total variance, and what all components together have of it."""
    values, stats = _values(spark, d), cut(_stats(spark, d))
    top = cut(stats.orderBy(F.desc("var"), "gene").limit(100))
    scaled, zeros = expression.scale(expression.gene_subset(values, top), top)
    listed = values.select("cell").distinct()
    places = cut(sparse_pca.gene_places(top))
    rows = cut(sparse_pca.sparse_rows(scaled, zeros, listed, places))
    n, genes = rows.count(), places.count()
    _, _, variances, total = sparse_pca.sparse_components(rows, genes, genes)
    return spark.createDataFrame([(n, genes, round(total, 4), round(float(variances.sum()), 4))], "cells long, genes long, total double, components double")


@query()
def clustered_bundle(spark, d):
    """The chain from counts to clusters, written as a bundle and read back: cell, total, cluster, the first component and whether it has a place."""
    got = clustering.clustered(cell_matrix(spark, d), ClusterSettings(n_pcs=20, neighbours=12, variable_genes=500), iterations=1)
    folder = f"{shared_dir(spark)}/clustered-{uuid.uuid4().hex}"
    got.write(folder)
    obs = spark.read.parquet(f"{folder}/obs")
    return obs.select("cell", "total", "cluster", F.round(F.col("pc")[0], 6).alias("pc1"), F.col("x").isNotNull().alias("placed"))


@query()
def doublets_on_counts(spark, d):
    """Scores and calls of cells among sums of pairs of cells."""
    calls, _ = doublets.doublet_calls(cell_matrix(spark, d), n_genes=500)
    return calls


@query()
def qc_called(spark, d):
    """Cells that pass quality control and are not called doublets from their counts."""
    summed = cut(cell_matrix(spark, d))  # read by both
    calls, _ = doublets.doublet_calls(summed, n_genes=500)
    kept = matrix.qc_keep(_metrics(spark, d, summed), min_genes=0, min_umis=0, max_mito=0.0)
    return matrix.final_keep(kept, calls).select("cell", "n_umi", "n_genes")


@query(f"WITH {BEFORE_SQL} SELECT CAST(y AS BIGINT) AS y, CAST(x AS BIGINT) AS x, cell_id + 1 AS label FROM rb")
def label_files(spark, d):
    """Cells drawn as labels from 1, written as tiled files and read back."""
    drawn = _drawn(spark, d).select("y", "x", (F.col("cell_id") + 1).alias("label"))
    folder = f"{shared_dir(spark)}/labels-{uuid.uuid4().hex}"
    return images.read_label_tiles(spark, folder, images.write_label_tiles(drawn, folder, 120, 120, side=64))


@query(f"""WITH {CELLS_SQL}, a AS (SELECT spot, min(cell_id) AS cell_id FROM hit WHERE odd OR edge GROUP BY spot),
k AS (SELECT l_orderkey AS spot, CAST(sum(round(l_quantity)) AS BIGINT) AS n FROM lineitem GROUP BY 1),
s AS (SELECT a.cell_id, coalesce(n, 0) AS n FROM events LEFT JOIN a ON a.spot = event_id LEFT JOIN k ON k.spot = event_id)
SELECT count(*) AS n_spots_total, count(cell_id) AS n_spots_assigned, CAST(sum(n) AS BIGINT) AS counts_total,
       CAST(coalesce(sum(n) FILTER (cell_id IS NOT NULL), 0) AS BIGINT) AS counts_assigned,
       (SELECT count(*) FROM supplier) AS cells, (SELECT count(*) FROM part) AS genes FROM s""")
def assignment_set(spark, d):
    """The stage from spots to cells, all of its tables written; figures read back from them."""
    got = assignment.assigned(spots(spark, d), cells(spark, d), counts(spark, d), genes(spark, d).drop("brand"))
    folder = f"{shared_dir(spark)}/assigned-{uuid.uuid4().hex}"
    got.write(folder)
    told = spark.read.json(f"{folder}/assignment_yield")
    sizes = [spark.read.option("header", True).csv(f"{folder}/{f}").agg(F.count(F.lit(1)).alias(c)) for f, c in (("cells_meta", "cells"), ("gene_assigned_fractions", "genes"))]
    return told.select("n_spots_total", "n_spots_assigned", "counts_total", "counts_assigned").crossJoin(F.broadcast(sizes[0])).crossJoin(F.broadcast(sizes[1]))
