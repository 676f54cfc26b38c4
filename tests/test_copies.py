"""Points beyond a picture, and outlines that come many times: nothing is dropped, copies share a result and are worked out once."""

import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from spotlattice.operators import assign, outline, raster, segment
from spotlattice.operators import geometry as g


def octagons(spark, n):
    """Cells of which those with equal last two digits have one centre and three sizes."""
    k = F.col("id")
    xs, ys = g.octagon((k * 37) % 100 + 0.013, (k * 53) % 100 + 0.017, F.lit(4.0) + (k % 3).cast("double"))
    return spark.range(n).select(k.alias("cell_id"), g.ring_edges(xs, ys).alias("edges"))


def test_crop_keeps_points_beyond_the_picture(spark):
    p = spark.createDataFrame([(1, "a", 10.0, 10.0), (2, "a", 30.0, 190.0)], "spot long, cluster string, x double, y double")
    got = raster.crop_points(p, raster.fixed_bounds(p, 5, 100, 100, "cluster"), "cluster", 300.0)
    assert {r.spot: (r.x, r.y, r.scale) for r in got.collect()} == {1: (5.0, 5.0, 1.0), 2: (25.0, 185.0, 1.0)}


def test_cells_about_one_point_tie_by_id(spark):
    at = spark.range(2000).select(F.col("id").alias("spot"), (F.col("id") * 7 % 1000 / 10).alias("x"), (F.col("id") * 13 % 1000 / 10).alias("y"))
    got = {r.spot: r.cell_id for r in assign.assign_dilated(at, octagons(spark, 300), 2.0).collect()}
    one = {r.spot: r.cell_id for r in assign.assign_dilated(at, octagons(spark, 100), 2.0).collect()}
    # the first of a place speaks for it, and no other takes what is its
    assert set(one) <= set(got) and all(got[s] == c for s, c in one.items()) and max(got.values()) < 100


def shuffled(spark):
    sc = spark.sparkContext._jsc.sc()
    sc.listenerBus().waitUntilEmpty()
    told = sc.statusStore().executorList(True)
    return sum(told.apply(i).totalShuffleWrite() for i in range(told.size()))


def test_copies_of_a_cell_are_not_paired_with_spots(spark):
    at = spark.range(500).select(F.col("id").alias("spot"), (F.col("id") * 7 % 1000 / 10).alias("x"), (F.col("id") * 13 % 1000 / 10).alias("y"))
    flat = spark.range(1).select((F.col("id") - 1).alias("cell_id"), g.ring_edges(F.array(*map(F.lit, (0.0, 90.0, 90.0, 0.0))), F.array(*map(F.lit, (50.0, 50.0, 50.0, 50.0)))).alias("edges"))
    one = sorted(map(tuple, assign.assign_dilated(at, octagons(spark, 300), 2.0).collect()))
    before = shuffled(spark)
    many = sorted(map(tuple, assign.assign_dilated(at, octagons(spark, 6000).unionByName(flat), 2.0).collect()))
    # the smallest ids speak for their copies, and a region without area has no centroid and takes nothing
    assert many == one and len(one) > 400 and shuffled(spark) - before < 1e6


def test_copies_share_the_cell_of_their_place(spark):
    few, many = octagons(spark, 100), octagons(spark, 400)
    one = {r.cell_id: r for r in outline.dilate_capped(few, 2.0).collect()}
    got = {r.cell_id: r for r in outline.dilate_capped(many, 2.0).filter("part = 0 and ring = 0").collect()}
    assert len(got) == 400 and all(got[k + 300].out_area == got[k].out_area for k in range(100))  # 300 on: same size too
    assert all(abs(got[k].out_area - one[k].out_area) < 1e-6 for k in range(100))


def test_equal_outlines_are_worked_out_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def one(e):
        calls.add(1)
        return outline.numbered(outline.outline(e.reshape(-1, 4), outline.odd))

    df = octagons(spark, 100).unionByName(octagons(spark, 100).withColumn("cell_id", F.col("cell_id") + 1000)).withColumn("_e", outline.flat_edges(F.col("edges")))
    got = outline._mapped(df, ["cell_id"], ["_e"], outline.RINGS, one).collect()
    assert len(got) == 200 and calls.value == 100


def test_pieces_of_many_edges_take_bounded_memory():
    n = 5000
    e = np.stack([np.arange(n) * 2.0, np.zeros(n), np.arange(n) * 2.0 + 1, np.ones(n)], 1)
    tracemalloc.start()
    assert len(outline.split(e, 2.0**-20)) == n
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 60e6


def test_union_of_copies_counts_them_once(spark):
    squares = spark.range(2000).select((F.col("id") + 7).alias("cell_id"), (F.col("id") % 2 * 3.0).alias("x"))
    xs, ys = F.array(*[F.col("x") + v for v in (0, 4, 4, 0)]), F.array(*[F.lit(v) for v in (0.0, 0.0, 4.0, 4.0)])
    got = outline.dissolved(squares.select("cell_id", g.ring_edges(xs, ys).alias("edges"))).collect()
    assert [(r.group, r.part, r.ring, r.area) for r in got] == [(7, 0, 0, 28.0)]


def test_dense_tiles(spark):
    df = spark.createDataFrame([(1, [3, 0], [5.0, 2.0]), (2, [], [])], "t long, k array<int>, v array<double>")
    got = {r.t: r.px for r in df.select("t", segment.dense(F.col("k"), F.col("v"), 5).alias("px")).collect()}
    assert got == {1: [2.0, 0.0, 0.0, 5.0, 0.0], 2: [0.0] * 5}


def test_points_of_a_small_file_use_all_cores(spark, tmp_path):
    octagons(spark, 50).coalesce(1).write.parquet(str(tmp_path / "cells"))
    roi = spark.createDataFrame([("a", [0.0, 60.0, 60.0, 0.0], [0.0, 0.0, 90.0, 90.0])], "roi string, xs array<double>, ys array<double>")
    one = spark.read.parquet(str(tmp_path / "cells"))
    at = {r.cell_id: (r.x, r.y) for r in one.select("cell_id", F.inline(F.array(g.representative(F.col("edges"))))).collect()}
    assert len(at) == 50 and all(abs(x - (k * 37 % 100 + 0.013)) < 1e-9 for k, (x, _) in at.items())
    inside = assign.region_filter(one, g.region_edges(roi, "roi"))
    assert {r.cell_id for r in inside.collect()} == {k for k, (x, y) in at.items() if 0 < x < 60 and 0 < y < 90}
    assert "REPARTITION_BY_NUM" in inside._jdf.queryExecution().toString()
