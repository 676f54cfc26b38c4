"""Pixel tables, outlines, bundles and what runs find, against plain Python."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotlattice import __main__ as cli
from spotlattice import functions as fn
from spotlattice.operators import assign, expression, geometry, graph, matrix, raster, segment
from spotlattice.plans import inputs, stages
from spotlattice.sources import geojson


def pixels(spark, a):
    return spark.createDataFrame([(int(y), int(x)) for y, x in zip(*np.nonzero(a), strict=True)], "y int, x int")


def picture(df, shape):
    out = np.zeros(shape, int)
    for r in df.collect():
        out[r.y, r.x] = 1
    return out


def flood(a):
    label, n = np.zeros(a.shape, int), 0
    for s in zip(*np.nonzero(a), strict=True):
        if label[s]:
            continue
        n += 1
        todo = [s]
        while todo:
            y, x = todo.pop()
            if 0 <= y < a.shape[0] and 0 <= x < a.shape[1] and a[y, x] and not label[y, x]:
                label[y, x] = n
                todo += [(y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)]
    return label


def test_components_and_small_objects(spark):
    a = np.random.default_rng(5).random((24, 30)) < 0.55
    got = raster.label_components(pixels(spark, a)).cache()
    want, by = flood(a), {}
    for r in got.collect():
        assert by.setdefault(r.label, want[r.y, r.x]) == want[r.y, r.x]
    assert len(by) == want.max() and got.count() == a.sum()
    boxes = {r.area for r in raster.component_boxes(got).collect()}
    assert boxes == set(np.bincount(want.ravel())[1:].tolist())
    big = np.isin(want, np.flatnonzero(np.bincount(want.ravel()) >= 6)[1:] if (want == 0).sum() >= 6 else np.flatnonzero(np.bincount(want.ravel()) >= 6))
    assert (picture(raster.drop_small(got, 6), a.shape) == big).all()
    assert raster.label_components(pixels(spark, a * 0)).count() == 0
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_few_edges_are_joined_up_in_few_jobs(spark):
    """A path and a tree over many tasks: one bounded task ends what rounds of jobs would, with the same rows."""
    edges = [(i, i + 1) for i in range(300)] + [(1000 + i, 1000 + i // 2) for i in range(1, 200)] + [(5000, 5000), (301, 3), (3, 301)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(16).cache()
    df.count()
    sc, seen = spark.sparkContext, {}
    for most in (600, 200, 1):
        sc.setJobGroup(f"components {most}", "")
        seen[most] = sorted(map(tuple, graph.components(df, most).collect()))
        seen[f"jobs {most}"] = len(sc.statusTracker().getJobIdsForGroup(f"components {most}"))
    sc.setJobGroup("", "")
    assert seen[600] == [(i, 0) for i in range(1, 302)] + [(1000 + i, 1000) for i in range(1, 200)]
    assert seen[600] == seen[200] == seen[1]
    assert seen["jobs 600"] <= 6 < seen["jobs 1"], {k: v for k, v in seen.items() if isinstance(k, str)}


def test_morphology_and_holes(spark):
    a = np.zeros((20, 22), int)
    a[3:15, 4:18] = 1
    a[8, 9] = a[10:12, 12:15] = 0
    a[18, 20] = 1
    disk = raster.disk(1)

    def shifted(m, f, start):
        p = np.pad(m, 1)
        out = np.full(m.shape, start)
        for dy, dx in disk:
            out = f(out, p[1 + dy : 1 + dy + m.shape[0], 1 + dx : 1 + dx + m.shape[1]])
        return out

    grown, shrunk = shifted(a, np.maximum, 0), shifted(a, np.minimum, 1)
    inside = raster.dilate(pixels(spark, a), 1).filter("y between 0 and 19 and x between 0 and 21")
    assert (picture(inside, a.shape) == grown).all() and (picture(raster.erode(pixels(spark, a), 1), a.shape) == shrunk).all()
    filled = a.copy()
    filled[8, 9] = 1
    assert (picture(raster.fill_holes(pixels(spark, a), 6), a.shape) == filled).all()
    filled[10:12, 12:15] = 1
    assert (picture(raster.fill_holes(pixels(spark, a), 7), a.shape) == filled).all()
    assert raster.fill_holes(pixels(spark, a * 0), 7).count() == 0
    gray = spark.createDataFrame([(y, x, 0.2 if filled[y, x] else 0.9) for y in range(20) for x in range(22)], "y int, x int, gray double")
    got = picture(raster.tissue_mask(gray, open_by=1, close_by=1, holes=9, objects=5), a.shape)
    assert got[5:13, 6:16].all() and got[18, 20] == 0
    assert raster.otsu(gray.withColumn("gray", F.lit(0.5))).first().threshold is None and raster.otsu(gray.limit(0)).count() == 1
    assert raster.tissue_mask(gray.withColumn("gray", F.lit(1.0))).count() == 0


def test_rasterise_holes_overlaps_and_clips(spark):
    sq = lambda a, b: ([a, b, b, a], [a, a, b, b])
    rings = [(1, *sq(0.5, 8.5)), (1, *sq(2.5, 5.5)), (2, *sq(6.5, 11.5))]
    regions = geometry.region_edges(spark.createDataFrame(rings, "cell_id int, xs array<double>, ys array<double>"), "cell_id")
    got = {(r.y, r.x): r.cell_id for r in raster.rasterise(regions, height=10, width=10).collect()}
    want = {}
    for y, x in itertools.product(range(10), repeat=2):
        one = 0.5 < y < 8.5 and 0.5 < x < 8.5 and not (2.5 < y < 5.5 and 2.5 < x < 5.5)
        two = 6.5 < y < 11.5 and 6.5 < x < 11.5
        if one or two:
            want[y, x] = 2 if two else 1
    assert got == want
    back = raster.changed(raster.rasterise(regions.filter("cell_id = 1")), raster.rasterise(regions.filter("cell_id = 2"))).groupBy("change").count().collect()
    assert {r.change: r["count"] for r in back} == {"both": 4, "shrunk": 51, "grown": 21}


def test_representative_points_and_validity(spark):
    crescent = ([0.0, 10.0, 10.0, 0.0, 0.0, 8.0, 8.0, 0.0], [0.0, 0.0, 10.0, 10.0, 9.0, 9.0, 1.0, 1.0])
    bow = ([0.0, 2.0, 0.0, 3.0], [0.0, 2.0, 2.0, -1.5])
    spike = ([0.0, 4.0, 4.0, 4.0, 4.0, 0.0], [0.0, 0.0, 8.0, 0.0, 4.0, 4.0])
    df = spark.createDataFrame([(1, *crescent), (2, *bow), (3, *spike), (4, [0.0, 1.0], [0.0, 0.0])], "cell_id int, xs array<double>, ys array<double>")
    r = geometry.region_edges(df, "cell_id")
    x, y = geometry.representative_point(F.col("edges"))
    at = r.select("cell_id", x.alias("x"), y.alias("y"), "edges")
    inside = {q.cell_id: q.ok for q in at.select("cell_id", geometry.contains(F.col("x"), F.col("y"), F.col("edges")).alias("ok")).collect()}
    assert inside[1] and inside[2] and not inside[4]
    assert {q.cell_id: q.v for q in r.select("cell_id", geometry.is_simple(F.col("edges")).alias("v")).collect()} == {1: True, 2: False, 3: True, 4: False}
    assert {q.cell_id: q.n for q in r.select("cell_id", F.size(geometry.repaired(F.col("edges"))).alias("n")).collect()}[4] == 0
    rois = geometry.region_edges(spark.createDataFrame([(1, [8.1, 20.0, 20.0, 8.1], [-1.0, -1.0, 20.0, 20.0])], "roi int, xs array<double>, ys array<double>"), "roi")
    assert [q.cell_id for q in assign.region_filter(r, rois).collect()] == [1]


def test_clipped_edges_decide_as_all_edges(spark):
    r = random.Random(1)
    rings = [(k, *map(list, zip(*[(50 + 45 * np.cos(t) * r.uniform(0.3, 1), 50 + 45 * np.sin(t) * r.uniform(0.3, 1)) for t in np.linspace(0, 6.2, 60)], strict=True))) for k in range(3)]
    rings = [(k, [float(v) for v in a], [float(v) for v in b]) for k, a, b in rings]
    regions = geometry.region_edges(spark.createDataFrame(rings, "cell_id int, xs array<double>, ys array<double>"), "cell_id")
    spots = spark.createDataFrame([(i, r.uniform(0, 100), r.uniform(0, 100)) for i in range(400)], "spot int, x double, y double")
    one = {(q.spot, q.cell_id) for q in assign.assign_spots(spots, regions, size=7.0).collect()}
    assert one == {(q.spot, q.cell_id) for q in assign.assign_spots(spots, regions, size=1000.0).collect()} and len(one) > 50
    a, b = ({(q.spot, q.cell_id, q.distance) for q in assign.assign_dilated(spots, regions, 3.0, size=s).collect()} for s in (7.0, 1000.0))
    assert a == b


def test_quality_control_to_a_bundle(spark):
    m = spark.createDataFrame([(1, 1, 4), (1, 2, 1), (2, 1, 3), (3, 2, 9)], "cell long, gene long, n long")
    kept = matrix.final_keep(spark.createDataFrame([(1, True), (2, True), (3, False)], "cell long, qc_keep boolean"), spark.createDataFrame([(1, True), (2, None)], "cell long, doublet_call boolean"))
    assert [r.cell for r in kept.collect()] == [2]
    x, _, _ = matrix.filter_bundle(m, kept, spark.createDataFrame([(1,)], "gene long"))
    assert [tuple(r) for r in x.collect()] == [(2, 1, 3)]
    bare = spark.createDataFrame([(1,), (4,)], "cell long")
    got = {r.cell: (r.n_umi, r.n_genes, r.pct_mito) for r in matrix.with_defaults(bare, m).collect()}
    assert got == {1: (5, 2, 0.0), 4: (0, 0, 0.0)}
    with pytest.raises(ValueError):
        matrix.with_defaults(bare)
    assert matrix.min_counts(bare, 5).count() == 2
    assert {(r.bx, r.by): r.n for r in matrix.bins_2d(spark.createDataFrame([(0.0, 1.0), (1.0, 1.0), (None, 2.0)], "a double, b double"), "a", "b", 2, 2).collect()} == {(0, 0): 1, (1, 0): 1}


def test_stabilised_genes_match_numpy(spark):
    r = np.random.default_rng(2)
    n, g = 60, 150
    dense = r.poisson(r.gamma(1, 2, g), (n, g)).astype(float)
    rows = [(c, k, float(dense[c, k])) for c in range(n) for k in range(g) if dense[c, k]]
    got = {q.gene: q.norm_var for q in expression.stabilised_genes(spark.createDataFrame(rows, "cell long, gene long, value double"), n, g).collect()}
    mean, var = dense.mean(0), dense.var(0, ddof=1)
    ok = var > 0
    sd = np.sqrt(10 ** expression.local_trend(np.log10(mean[ok]), np.log10(var[ok])))
    z = np.minimum((dense[:, ok] - mean[ok]) / sd, np.sqrt(n))
    want = dict(zip(np.flatnonzero(ok).tolist(), (z * z).sum(0) / (n - 1), strict=True))
    assert all(abs(got[k] - want[k]) < 1e-5 for k in want)
    x = np.linspace(0, 3, 200)
    assert np.allclose(expression.local_trend(x, 1 + 2 * x - x * x), 1 + 2 * x - x * x, atol=1e-3)


def test_trend_of_many_genes_stays_distributed(spark, monkeypatch):
    r = np.random.default_rng(4)
    mean = 10 ** np.concatenate([r.normal(-1, 0.7, 1500), np.full(400, -1.5), r.choice([0.3, 0.5, 0.9], 300)])
    var = np.where(r.random(2200) < 0.3, mean, mean * 10 ** r.normal(0, 0.4, 2200))
    var[1500:1900] = 0.02  # a window of equal points has no reach
    x, y = np.log10(mean), np.log10(var)
    stats = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(mean, var, strict=True))], "gene long, mean double, var double").cache()
    want = {span: np.sqrt(10 ** expression.local_trend(x, y, span)) for span in (0.3, 0.06)}
    genes = spark.createDataFrame([(c, k, float(1 + (c * k) % (2 + k % 7))) for c in range(30) for k in range(40) if (c + k) % 3], "cell long, gene long, value double")
    few = [tuple(q) for q in expression.stabilised_genes(genes, 30, 12).collect()]

    def whole(*_):
        raise AssertionError("a row a gene on the driver")

    monkeypatch.setattr(type(stats), "toPandas", whole)
    for span, sd in want.items():
        got = {q.gene: q.sd for q in expression.expected_sd(stats, span, most=100).collect()}
        near = sorted(abs(got[i] / v - 1) for i, v in enumerate(sd))
        assert len(got) == 2200 and near[-1] < 1e-6, (span, near[-5:])
    monkeypatch.setattr(expression.expected_sd, "__defaults__", (0.3, "gene", 10))
    assert [tuple(q) for q in expression.stabilised_genes(genes, 30, 12).collect()] == few and len(few) == 12


def test_predicted_outlines_come_back_on_the_slide(spark):
    px = np.zeros((8, 10))
    px[2:4, 5:9] = 1.0
    t = spark.createDataFrame([("s", 100, 200, 8, 10, px.ravel().tolist()), ("s", 0, 0, 8, 10, [0.0] * 80)], "slide string, y0 int, x0 int, height int, width int, pixels array<double>")
    got = segment.predict_tiles(t, segment.bright_boxes(0.5), 2.0).collect()
    assert len(got) == 1 and (min(got[0].ys), max(got[0].ys), min(got[0].xs), max(got[0].xs)) == (102.0, 104.0, 205.0, 209.0)


def test_pieces_of_a_multipolygon_are_cells(spark):
    text = '{"type":"FeatureCollection","features":[{"type":"Feature","properties":{"cell_id":7},"geometry":{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[1,1]]],[[[5,5],[6,5],[6,6]]]]}},{"type":"Feature","properties":{"cell_id":8},"geometry":{"type":"Polygon","coordinates":[[[2,2],[3,2],[3,3]]]}}]}'
    got = geojson.pieces(geojson.parse(spark.createDataFrame([(text,)], "value string"))).orderBy("cell_id").collect()
    assert [(r.cell_id, r.xs[0]) for r in got] == [(1, 0.0), (2, 5.0), (3, 2.0)]


def test_what_a_run_finds(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.roi").write_bytes(b"x" * 70)
    (tmp_path / "a.parquet").write_bytes(b"x" * 10)
    found = inputs.discover(spark, str(tmp_path), ["*.roi", "*.parquet"]).collect()
    assert [r.path.rsplit("/", 1)[1] for r in found] == ["b.roi", "a.parquet"]
    assert [r.ok for r in inputs.check_files(inputs.discover(spark, str(tmp_path), ["*.roi", "*.parquet"]), "outlines").collect()] == [True, False]
    assert inputs.roi_tag(["/d/s.tif.left.roi"]) == "left" and inputs.roi_tag(["slide_1.roi", "slide_2.roi"]) == "slide_"
    assert inputs.roi_tag(["ab.roi", "x.roi"]) == "x"
    assert set(inputs.available()) == set(inputs.OPTIONAL)
    with pytest.raises(ValueError):
        inputs.require_rows(spark.range(0), "this")
    before = stages.plan([stages.Stage("a", None, inputs=[str(tmp_path)])], spark)
    (tmp_path / "a.parquet").write_bytes(b"x" * 11)
    assert stages.plan([stages.Stage("a", None, inputs=[str(tmp_path)])], spark) != before
    assert stages.plan([stages.Stage("a", None)]) != stages.plan([stages.Stage("a", None, version=2)])


def test_command_line():
    a = cli.arguments(["q", "--out", "o", "t"])
    assert (a.query, a.tables, a.out) == ("q", "t", "o")
    for bad in ([], ["q", "t"], ["q", "t", "o", "more"]):
        with pytest.raises(SystemExit):
            cli.arguments(bad)


def test_names(spark):
    df = spark.createDataFrame([("it's",), ("plain",), ("a b",)], "t string").select(fn.shell_quoted(F.col("t")).alias("q"))
    import shlex

    assert [shlex.split(r.q)[0] for r in df.collect()] == ["it's", "plain", "a b"]
    got = spark.range(1).select(fn.common_prefix(F.array(F.lit("abc"), F.lit("abd"), F.lit("abzz"))).alias("a"), fn.common_prefix(F.array(F.lit(""), F.lit("b"))).alias("b"), fn.without_suffix(F.lit("x.tar.gz"), ".gz", ".tar").alias("c"), fn.without_suffix(F.lit(".gz"), ".gz").alias("d")).first()
    assert tuple(got) == ("ab", "", "x.tar", ".gz")
    with pytest.raises(ValueError):
        fn.pixels_of(F.lit(1.0), 0.0)
    assert raster.downscale_factor(5000, 4096) == 2 and raster.downscale_factor(10, 0) == 1 and raster.downscale_factor(10, 100, 2) == 2 and raster.default_overlap(2.0) == 8
