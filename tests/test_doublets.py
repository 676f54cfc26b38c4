"""Doublets planted in counts, and the parts of the search."""

import numpy as np
from pyspark.sql import functions as F

from spotlattice import catalogue, catalogue_shapes
from spotlattice.operators import doublets, matrix, neighbours


def test_planted_doublets_are_found(spark):
    r = np.random.default_rng(3)
    rate = r.gamma(0.5, 1.0, (3, 80)) * 4
    cells = [r.poisson(rate[i % 3]) for i in range(150)]
    planted = {150 + i: cells[3 * i] + cells[3 * i + 1 + i % 2] for i in range(12)}
    rows = [(c, g, int(v)) for c, x in [*enumerate(cells), *planted.items()] for g, v in enumerate(x) if v]
    df = spark.createDataFrame(rows, "cell long, gene long, n long").cache()
    calls, limit = doublets.doublet_calls(df, n_pcs=10, n_genes=60)
    got = {x.cell: x for x in calls.collect()}
    assert set(got) == set(range(162)) and limit is not None
    own, rest = [got[c].doublet_score for c in planted], [got[c].doublet_score for c in range(150)]
    assert np.mean([a > b for a in own for b in rest]) > 0.95
    found = {c for c, x in got.items() if x.doublet_call}
    assert len(found & set(planted)) >= 10 and len(found - set(planted)) <= 8


def test_pairs_and_sums(spark):
    cells = spark.range(100).withColumnRenamed("id", "cell")
    pairs = doublets.cell_pairs(cells, 100, 3, 1).collect()
    assert 200 <= len(pairs) <= 300 and all(p.id < 0 and p.left != p.right for p in pairs) and len({p.id for p in pairs}) == len(pairs)
    m = spark.createDataFrame([(1, 5, 2), (2, 5, 3), (2, 6, 1), (3, 5, 9)], "cell long, gene long, n long")
    two = spark.createDataFrame([(-1, 1, 2)], "id long, left long, right long")
    assert sorted(map(tuple, doublets.simulated(m, two).collect())) == [(-1, 5, 5), (-1, 6, 1)]


def test_valley():
    x = np.arange(256)
    h = 100 * np.exp(-(((x - 60) / 20) ** 2)) + 60 * np.exp(-(((x - 190) / 25) ** 2)) + np.random.default_rng(0).random(256)
    assert 100 < doublets.valley(h) < 150
    assert doublets.valley(np.zeros(256)) is None and doublets.valley(np.arange(256.0)) is None


def test_few_cells(spark):
    df = spark.createDataFrame([(1, 1, 1), (2, 1, 4)], "cell long, gene long, n long")
    calls, limit = doublets.doublet_calls(df)
    assert limit is None and sorted((r.cell, r.doublet_score, r.doublet_call) for r in calls.collect()) == [(1, None, False), (2, None, False)]


def test_neighbours_are_counted_without_being_listed(spark, monkeypatch):
    """Copies, ties and several pieces: the counts are those of the list, and neither search for doublets makes the list."""
    r = np.random.default_rng(5)
    points = [*r.integers(0, 4, (120, 2)).tolist(), *([[0, 0]] * 60), *r.integers(0, 40, (120, 2)).tolist(), [90, 90], None]
    df = spark.createDataFrame([(i - 150, p and [float(x) for x in p]) for i, p in enumerate(points)], "id long, v array<double>").cache()
    for k, block in ((1, 2048), (7, 2048), (7, 40), (500, 40)):
        near = neighbours.nearest(df, k, block=block, pieces_wanted=4, most_block=50)
        want = {x.a: (x.n, x.c) for x in near.groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("b") < 0).alias("c")).collect()}
        tally = neighbours.nearest_tally(df, k, F.col("b") < 0, block=block, pieces_wanted=4, most_block=50)
        assert {x.a: (x.n, x.chosen) for x in tally.collect()} == want and len(want) == 301
    alone = neighbours.nearest_tally(df.filter("id = 0"), 3, F.col("b") < 0)
    assert alone.count() == 0

    def listed(*_):
        raise AssertionError("neighbours listed row by row")

    monkeypatch.setattr(neighbours, "_spread", listed)
    counts = spark.createDataFrame([(c, c % 7, 1 + c % 3) for c in range(40)], "cell long, gene long, n long")
    wide = []
    own = doublets.simulated
    monkeypatch.setattr(doublets, "simulated", lambda m, *rest: wide.append(m.select("gene").distinct().count()) or own(m, *rest))
    assert doublets.doublet_calls(counts, n_pcs=3, n_genes=5)[0].count() == 40 and wide == [5]  # pairs over the listed genes alone
    assert neighbours.doublet_scores(df.filter("id >= 0"), k=5).count() == 151


def test_qc_called_sums_the_counts_once(spark, monkeypatch):
    d = "/root/testdata/sf0.001"
    kept = matrix.qc_keep(catalogue._metrics(spark, d), min_genes=0, min_umis=0, max_mito=0.0).filter("qc_keep")
    want = sorted(map(tuple, kept.select("cell", "n_umi", "n_genes").collect()))  # too few cells for calls
    summed = []
    for m in (catalogue, catalogue_shapes):
        monkeypatch.setattr(m, "cell_matrix", lambda *a, own=m.cell_matrix: summed.append(a) or own(*a))
    assert sorted(map(tuple, catalogue_shapes.qc_called(spark, d).collect())) == want and want and len(summed) == 1
