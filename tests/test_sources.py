"""Formats: round trips and files made here."""

import gzip
import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotlattice.plans import stages, sweep
from spotlattice.sources import binary, geojson, tables


def test_positions(spark):
    df = spark.createDataFrame([("a", 1, 2)], "spot_id string, pxl_col_in_fullres int, pxl_row_in_fullres int")
    assert tables.coerce_positions(df).collect() == [("a", 1.0, 2.0)]
    for bad in ("q string, x int, y int", "barcode string, a int, b int"):
        with pytest.raises(ValueError):
            tables.coerce_positions(spark.createDataFrame([("a", 1, 2)], bad))


def gz(path, text):
    with gzip.open(path, "wt") as f:
        f.write(text)


def test_mtx(spark, tmp_path):
    gz(tmp_path / "matrix.mtx.gz", "%%MatrixMarket matrix coordinate integer general\n% note\n3 4 4\n1 1 5\n3 1 2\n2 4 7\n1 2 1\n")
    gz(tmp_path / "features.tsv.gz", "g1\tA\tx\ng2\tB\tx\ng3\tA\tx\n")
    gz(tmp_path / "barcodes.tsv.gz", "b1\nb2\nb3\nb4\n")
    counts, genes, barcodes = tables.read_mtx(spark, str(tmp_path))
    assert sorted(tuple(r) for r in counts.collect()) == [("b1", 0, 5.0), ("b1", 2, 2.0), ("b2", 0, 1.0), ("b4", 1, 7.0)]
    assert [tuple(r) for r in genes.orderBy("gene_ix").collect()] == [(0, "g1", "A"), (1, "g2", "B"), (2, "g3", "A")]
    pos = spark.createDataFrame([("b1", 0.0, 0.0), ("b4", 1.0, 1.0), ("zz", 2.0, 2.0)], "barcode string, x double, y double")
    known, own = tables.align(pos, counts, barcodes)
    assert {r.barcode for r in known.collect()} == {"b1", "b4"} and own.count() == 3
    with pytest.raises(ValueError):
        tables.align(pos, counts, barcodes.union(barcodes))


def roi(kind=7, points=((1, 2), (4, 2), (4, 6)), top=10, left=20, version=227, sub=False, late=False):
    head = bytearray(64)
    head[:4] = b"Iout"
    struct.pack_into(">h", head, 4, version)
    head[6] = kind
    struct.pack_into(">hh", head, 8, top, left)
    struct.pack_into(*((">i", head, 18) if late else (">H", head, 16)), len(points))
    struct.pack_into(">h", head, 50, 128 if sub else 0)
    body = b"".join(struct.pack(f">{len(points)}h", *c) for c in zip(*points, strict=True))
    if sub:
        body += b"".join(struct.pack(f">{len(points)}f", *[v + 0.5 for v in c]) for c in zip(*points, strict=True))
    return bytes(head) + body


def test_rois(spark, tmp_path):
    for kind in (0, 7, 8):
        assert binary.parse_roi(roi(kind)) == ([21.0, 24.0, 24.0, 21.0], [12.0, 12.0, 16.0, 12.0])
    assert binary.parse_roi(roi(late=True))[0][0] == 21.0
    assert binary.parse_roi(roi(sub=True)) == ([1.5, 4.5, 4.5, 1.5], [2.5, 2.5, 6.5, 2.5])
    assert binary.parse_roi(roi(sub=True, version=200))[0][0] == 21.0
    for bad in (roi(1), b"Iouu" + roi()[4:], b"Iout", roi(points=((1, 1), (2, 2)))):
        with pytest.raises(ValueError):
            binary.parse_roi(bad)
    (tmp_path / "a.roi").write_bytes(roi())
    (tmp_path / "b.roi").write_bytes(roi(1))
    (tmp_path / "c.roi").write_bytes(roi()[:66])
    got = {r.roi: r for r in binary.read_rois(spark, str(tmp_path)).collect()}
    assert got["a"].xs[0] == 21.0 and got["a"].error is None
    assert got["b"].xs is None and "outline" in got["b"].error and "short" in got["c"].error


def tiff(px, order="<"):
    h, w, c = px.shape
    data = px.astype(order + px.dtype.str[1:]).tobytes()
    tags = [(256, 3, w), (257, 3, h), (258, 3, px.dtype.itemsize * 8), (259, 3, 1), (273, 4, 8), (277, 3, c), (278, 3, h), (279, 4, len(data))]
    out = (b"II" if order == "<" else b"MM") + struct.pack(order + "HI", 42, 8 + len(data)) + data + struct.pack(order + "H", len(tags))
    for tag, kind, v in tags:
        out += struct.pack(order + "HHI", tag, kind, 1) + (struct.pack(order + "HH", v, 0) if kind == 3 else struct.pack(order + "I", v))
    return out + bytes(4)


@pytest.mark.parametrize("order", ["<", ">"])
def test_tiff(spark, tmp_path, order):
    grey = (np.arange(6, dtype=np.uint16) * 10000).reshape(2, 3, 1)
    (tmp_path / "a.tif").write_bytes(tiff(grey, order))
    size = binary.image_sizes(spark, str(tmp_path)).first()
    assert (size.height, size.width, size.channels) == (2, 3, 1)
    strip = binary.read_strips(spark, str(tmp_path)).first()
    assert np.allclose(np.array(strip.pixels).reshape(2, 3, 3)[:, :, 1], grey[:, :, 0] / 65535)
    with pytest.raises(ValueError):
        binary.tiff_tags(b"nothing at all")


def test_geojson(spark, tmp_path):
    square = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
    hole = [[1, 1], [1, 2], [2, 2], [1, 1]]
    features = [
        {"type": "Feature", "properties": {"cell_id": 5, "k": "v"}, "geometry": {"type": "Polygon", "coordinates": [square, hole]}},
        {"type": "Feature", "properties": {}, "geometry": {"type": "MultiPolygon", "coordinates": [[square], [hole]]}},
        {"type": "Feature", "properties": {"cell_id": 7}, "geometry": {"type": "Point", "coordinates": [1, 2]}},
    ]
    (tmp_path / "a.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    got = geojson.read(spark, str(tmp_path / "a.geojson")).orderBy("feature", "part", "ring").collect()
    assert [(r.cell_id, r.part, r.ring) for r in got] == [(5, 0, 0), (5, 0, 1), (None, 0, 0), (None, 1, 0)]
    assert got[0].xs == [0.0, 4.0, 4.0, 0.0, 0.0] and got[0].props["k"] == "v"
    rings = geojson.read(spark, str(tmp_path / "a.geojson")).withColumn("cell_id", F.coalesce("cell_id", F.lit(6)))
    back = geojson.parse_lines(geojson.to_features(rings)).orderBy("cell_id", "part", "ring").collect()
    assert [(r.cell_id, r.part, r.ring, r.xs, r.ys) for r in back] == [(r.cell_id or 6, r.part, r.ring, r.xs, r.ys) for r in got]


def test_bundle(spark, tmp_path):
    x = spark.createDataFrame([(1, 2, 3)], "cell long, gene long, n long")
    tables.write_bundle(str(tmp_path / "b"), x, x.select("cell"), x.select("gene"), {"h": 5})
    a, obs, var, uns = tables.read_bundle(spark, str(tmp_path / "b"))
    assert a.collect() == x.collect() and obs.count() == var.count() == 1 and uns == {"h": 5}
    tables.write_csv(x, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == x.columns


def test_stages_are_kept_and_planned(spark, tmp_path):
    ran = []

    def make(name):
        return lambda s, have: (ran.append(name), s.range(3 + len(have)))[1]

    own = [stages.Stage("a", make("a"), stages.QcSettings()), stages.Stage("b", make("b"), None, ["a"])]
    assert [n for n, _ in stages.plan(own)] == ["a", "b"] and not ran
    assert stages.run(spark, own, str(tmp_path))["b"].count() == 4 and ran == ["a", "b"]
    stages.run(spark, own, str(tmp_path))
    assert ran == ["a", "b"]
    own[0].settings = stages.QcSettings(min_genes=1)
    stages.run(spark, own, str(tmp_path))
    assert ran == ["a", "b", "a", "b"]
    with pytest.raises(ValueError):
        stages.plan(own[1:])
    with pytest.raises(ValueError):
        stages.require(spark.range(1), ["id", "x"], "table")


def test_sweep_goes_on_after_a_failure(spark, tmp_path):
    runs = sweep.grid(spark, dataset=["d"], prob=[0.3], nms=[0.5], growth=[1, 3], config=["c"])
    assert [r.run_tag for r in runs.orderBy("run_tag").collect()] == ["sdP0.30_sdN0.50_vpx1_clc", "sdP0.30_sdN0.50_vpx3_clc"]

    def one(r):
        if r["growth"] == 1:
            raise RuntimeError("no")

    log = sweep.sweep(runs, one, str(tmp_path / "log"))
    assert sorted(r.status for r in log.collect()) == ["failed", "ok"] and spark.read.parquet(str(tmp_path / "log")).count() == 2
