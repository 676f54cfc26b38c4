"""The stage that turns spots, outlines and counts into cells, and what it writes."""

import json

from pyspark.sql import functions as F

from spotlattice.operators import geometry as g
from spotlattice.plans import assignment
from spotlattice.sources import tables


def test_the_whole_set_is_written(spark, tmp_path):
    spots = spark.createDataFrame([("a", 1.0, 1.0), ("b", 3.0, 3.0), ("c", 50.0, 50.0), ("d", 2.0, 1.0)], "spot string, x double, y double")
    rings = [(0, [0.0, 4.0, 4.0, 0.0], [0.0, 0.0, 4.0, 4.0]), (1, [2.0, 6.0, 6.0, 2.0], [2.0, 2.0, 6.0, 6.0]), (2, [90.0, 91.0, 91.0], [90.0, 90.0, 91.0])]
    regions = spark.createDataFrame(rings, "cell_id long, xs array<double>, ys array<double>").select("cell_id", g.ring_edges(F.col("xs"), F.col("ys")).alias("edges"))
    counts = spark.createDataFrame([("a", 1, 5), ("b", 1, 2), ("b", 2, 1), ("c", 1, 200), ("z", 1, 9)], "spot string, gene long, n long")
    genes = spark.createDataFrame([(1, "G"), (2, "H"), (3, "I")], "gene long, gene_name string")
    got = assignment.assigned(spots, regions, counts, genes)
    got.write(str(tmp_path / "out"), {"source": "made"})
    x, cells, names, notes = tables.read_bundle(spark, str(tmp_path / "out/cells"))
    assert sorted(map(tuple, x.select("cell_id", "gene", "n").collect())) == [(0, 1, 7), (0, 2, 1)]
    assert sorted((r.cell_id, r.centroid_x, r.area_px2, r.n_spots) for r in cells.collect())[:2] == [(0, 2.0, 16.0, 3), (1, 4.0, 16.0, 0)]
    assert {r.gene: (r.assigned_counts, r.unassigned_counts, r.unassigned_frac) for r in names.collect()} == {1: (7, 200, 1 - 7 / 207), 2: (1, 0, 0.0), 3: (0, 0, 1.0)}
    told = json.loads(spark.read.text(str(tmp_path / "out/assignment_yield"), wholetext=True).first()[0])
    assert told == {"n_spots_total": 4, "n_spots_assigned": 3, "spots_assigned_frac": 0.75, "counts_total": 208, "counts_assigned": 8, "counts_unassigned": 200, "counts_assigned_frac": 8 / 208}
    assert notes == {"source": "made", **told}
    read = lambda name: spark.read.option("header", True).csv(str(tmp_path / "out" / name))
    assert sorted((r.spot, r.spot_counts, r.assigned) for r in read("per_spot_counts_assigned").collect()) == [("a", "5", "1"), ("b", "3", "1"), ("c", "200", "0"), ("d", "0", "1")]
    assert sorted((r.spot, r.cell_id) for r in read("spot_to_cell").collect()) == [("a", "0"), ("b", "0"), ("c", "-1"), ("d", "0")]
    assert [r.gene_name for r in read("gene_unassigned_top30").collect()] == ["G"] and read("cells_meta").count() == 3


def test_nothing_gives_nothing(spark):
    spots = spark.createDataFrame([], "spot string, x double, y double")
    regions = spark.createDataFrame([], f"cell_id long, edges {g.EDGES}")
    got = assignment.assigned(spots, regions, spark.createDataFrame([], "spot string, gene long, n long"), spark.createDataFrame([(1, "G")], "gene long, gene_name string"))
    assert got.yields.first().asDict()["spots_assigned_frac"] is None and got.x.isEmpty() and got.genes.first().unassigned_frac == 1.0
