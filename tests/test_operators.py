"""Hand-made cases of the operators."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spotlattice.functions import cluster_order, share, starts_with_any
from spotlattice.operators import assign, expression, geometry, matrix, neighbours, quantiles, tiler, tiles

SQUARE = [0.0, 4.0, 4.0, 0.0], [0.0, 0.0, 4.0, 4.0]


def regions(spark, rings):
    return geometry.region_edges(spark.createDataFrame(rings, "cell_id long, xs array<double>, ys array<double>"), "cell_id")


def grid(spark, lo, hi):
    return spark.createDataFrame([(i * 100 + j, float(i), float(j)) for i in range(lo, hi) for j in range(lo, hi)], "spot long, x double, y double")


def test_covers_and_contains_on_a_square(spark):
    r, s = regions(spark, [(1, *SQUARE)]), grid(spark, -1, 6)
    assert assign.assign_spots(s, r).count() == 25
    assert assign.assign_spots(s, r, use_covers=False).count() == 9
    assert assign.roi_filter(s, r).count() == 9


def test_overlap_goes_to_the_smallest_id(spark):
    r = regions(spark, [(2, *SQUARE), (1, [2.0, 6.0, 6.0, 2.0], SQUARE[1])])
    got = {x.spot: x.cell_id for x in assign.assign_spots(grid(spark, 0, 7), r).collect()}
    assert got[302] == 1 and got[102] == 2 and got[502] == 1


def test_hole_and_two_parts(spark):
    rings = [(1, *SQUARE), (1, [1.0, 1.0, 3.0, 3.0], [1.0, 3.0, 3.0, 1.0]), (1, [10.0, 12.0, 12.0, 10.0], [0.0, 0.0, 2.0, 2.0])]
    r = regions(spark, rings)
    got = {x.spot for x in assign.assign_spots(grid(spark, 0, 13), r, use_covers=False).collect()}
    assert 202 not in got and 1101 in got and 103 not in got
    x, y = geometry.centroid(F.col("edges"))
    one = r.select(geometry.signed_area(F.col("edges")).alias("a"), x.alias("x"), y.alias("y")).first()
    assert one.a == 16 - 4 + 4 and abs(one.x - (12 * 2 + 4 * 11) / 16) < 1e-9


def test_bow_tie_is_even_odd(spark):
    r = regions(spark, [(1, [0.0, 4.0, 0.0, 4.0], [0.0, 4.0, 4.0, 0.0])])
    s = spark.createDataFrame([(1, 2.0, 3.0), (2, 2.0, 1.0), (3, 0.5, 2.0), (4, 3.5, 2.0)], "spot long, x double, y double")
    assert {x.spot for x in assign.assign_spots(s, r, use_covers=False).collect()} == {1, 2}


def test_dilation_is_capped_and_disjoint(spark):
    r = regions(spark, [(1, *SQUARE), (2, [5.0, 9.0, 9.0, 5.0], SQUARE[1])])
    s = grid(spark, -4, 14)
    at = {rad: {x.spot: x.cell_id for x in assign.assign_dilated(s, r, rad).collect()} for rad in (0.0, 1.0, 3.0)}
    assert len(at[0.0]) == 50 and set(at[0.0]) <= set(at[1.0]) <= set(at[3.0])
    column = {i * 100 + j: i for i in range(-4, 14) for j in range(-4, 14)}
    assert all(c == (1 if column[spot] <= 4 else 2) for spot, c in at[3.0].items())
    shape = {x.cell_id: x for x in assign.dilate_stars(r, 1.0, rays=512).collect()}
    full = 16 + 4 * 4 + math.pi
    assert abs(shape[1].uncapped_area - full) < 0.05 and shape[1].grown_area < shape[1].uncapped_area and shape[1].clipped


@pytest.mark.parametrize(("v", "want"), [([1, 2, 3, 4, 100], 1.4826), ([5] * 6 + [9] * 3, 4 / 1.349), ([7] * 4, 1.0)])
def test_mad_branches(spark, v, want):
    got = matrix.robust_scale(spark.createDataFrame([(float(x),) for x in v], "x double"), ["x"]).first()
    assert abs(got["mad"] - want) < 1e-9 and got["median"] == float(np.median(v))


@pytest.mark.parametrize("accuracy", [10_000, 100])
def test_quantiles_are_exact(spark, accuracy):
    r = np.random.default_rng(5)
    x = {"spread": r.normal(0, 1, 5000), "skewed": np.exp(r.normal(0, 6, 4001)), "ties": r.integers(0, 3, 3000) * 1.0, "hot": np.where(r.random(2000) < 0.7, 0.0, r.random(2000)), "few": r.random(3), "one": r.random(1)}
    rows = [(g, float(v)) for g, vs in x.items() for v in vs] + [("spread", None), ("nulls", None), (None, 2.0)]
    probs = {"least": 0.0, "low": 0.003, "q25": 0.25, "median": 0.5, "high": 0.998, "most": 1.0}
    got = {q.g: q for q in quantiles.quantiles(spark.createDataFrame(rows, "g string, v double"), "g", "v", probs, accuracy).collect()}
    assert set(got) == {*x, "nulls", None}
    for g, vs in x.items():
        assert np.allclose([got[g][n] for n in probs], [np.quantile(vs, p) for p in probs.values()], rtol=1e-12, atol=1e-12), g
    assert all(got["nulls"][n] is None for n in probs) and got[None]["median"] == 2.0
    assert quantiles.quantiles(spark.createDataFrame([], "g string, v double"), "g", "v", probs).count() == 0


def test_qc_and_yields(spark):
    m = spark.createDataFrame([(1, 1, 5), (1, 2, 3), (2, 1, 0), (3, 3, 10)], "cell long, gene long, n long")
    g = spark.createDataFrame([(1, "mt-A"), (2, "Rps1"), (3, "X"), (4, None)], "gene long, gene_name string")
    got = {r.cell: r for r in matrix.qc_metrics(m, g, ("MT-",), ("rps", "rpl")).collect()}
    assert (got[1].n_umi, got[1].n_genes, got[1].pct_mito, got[1].pct_ribo, got[1].top5_frac) == (8, 2, 62.5, 37.5, 1.0)
    assert got[2].n_genes == 0 and got[2].top5_frac is None and got[2].pct_mito == 0.0
    c = spark.createDataFrame([(1, 1, 4, 7), (2, 1, 6, None)], "spot long, gene long, n long, cell long")
    y = {r.gene: r for r in matrix.gene_yield(c, g.select("gene")).collect()}
    assert y[1].assigned_frac == 0.4 and y[4].assigned_frac == 0.0 and y[4].unassigned_frac == 1.0
    t = matrix.assignment_yield(c).first()
    assert (t.n_spots_total, t.n_spots_assigned, t.counts_assigned) == (2, 1, 4)
    empty = matrix.assignment_yield(c.limit(0)).first()
    assert empty.n_spots_total == 0 and empty.spots_assigned_frac is None and empty.counts_total == 0


def test_unique_names_and_numbers(spark):
    df = spark.createDataFrame([(i, n) for i, n in enumerate("aaba")], "ix long, name string")
    assert [r.unique_name for r in matrix.unique_names(df, "name", "ix").orderBy("ix").collect()] == ["a", "a-1", "b", "a-2"]
    taken = spark.createDataFrame([(i, n) for i, n in enumerate(["a", "a", "a-1", "a", "a-3", "a", "a-1", None])], "ix long, name string")
    assert [r.unique_name for r in matrix.unique_names(taken, "name", "ix").orderBy("ix").collect()] == ["a", "a-2", "a-1", "a-4", "a-3", "a-5", "a-1-1", None]
    many = spark.range(0, 30000, 3)
    for width in (4096, 8):
        got = matrix.number_rows(many, "id", width=width).orderBy("id").collect()
        assert [r.number for r in got] == list(range(1, 10001))


def test_entropy_edges(spark):
    pts = [(0.5, 0.5, "a")] * 30 + [(64.5, 0.5, "a")] * 15 + [(64.5, 0.5, "b")] * 15 + [(130.0, 0.5, "a")] * 20 + [(130.0, 0.5, "b")] * 9
    h = tiles.tile_histogram(spark.createDataFrame(pts, "x double, y double, cluster string"))
    got = {r.tx: (r.total, r.entropy) for r in tiles.tile_entropy(h).collect()}
    assert got == {0: (30, None), 1: (30, 1.0), 2: (29, None)}
    assert {r.tx: r.entropy for r in tiles.tile_entropy(h, single=0.0).collect()}[0] == 0.0


def test_smoothing_repeats_edges_and_skips_holes(spark):
    v = np.random.default_rng(0).random((6, 7))
    v[0, 0] = v[3, 3] = np.nan
    df = spark.createDataFrame([(i, j, None if np.isnan(v[i, j]) else float(v[i, j])) for i in range(6) for j in range(7)], "ty int, tx int, e double")
    got = {(r.ty, r.tx): r.smoothed for r in tiles.smooth(df, "e", 6, 7).collect()}
    k = np.exp(-0.5 * np.arange(-4, 5) ** 2)
    k /= k.sum()
    pad = lambda a: np.pad(a, 4, mode="edge")

    def blur(a):
        p = pad(a)
        return np.array([[(p[i : i + 9, j : j + 9] * k[:, None] * k[None]).sum() for j in range(7)] for i in range(6)])

    want = blur(np.nan_to_num(v)) / blur((~np.isnan(v)).astype(float))
    assert len(got) == 42 and all(abs(got[i, j] - want[i, j]) < 1e-9 for i in range(6) for j in range(7))


def test_adjusted_p_are_monotone(spark):
    p = [0.01, 0.02, 0.02, 0.5, 1.0, 0.03]
    got = expression.adjust(spark.createDataFrame([(0, i, x) for i, x in enumerate(p)], "cluster int, gene int, p double"), "p").orderBy("p", "gene").collect()
    q = [r.p_adj for r in got]
    assert q == sorted(q) and q[-1] == 1.0 and abs(q[0] - 0.04) < 1e-12
    z = spark.createDataFrame([(float(x),) for x in (0, 1, 1.96, 4.5, 8, -3)], "z double").select("z", expression.two_sided_p(F.col("z")).alias("p")).collect()
    fixed = {0.0: 1.0, 1.0: 0.31731050786291415, 1.96: 0.04999579029644087, 4.5: 6.795346249460121e-06, 8.0: 1.2441921148543575e-15, -3.0: 0.0026997960632601866}
    assert all(abs(r.p - fixed[r.z]) <= 1e-12 * max(1e-3, fixed[r.z]) for r in z)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=4, max_size=4), min_size=3, max_size=8))
def test_wilcoxon_ranks_zeros(spark, dense):
    values = [(c, g, float(v)) for c, row in enumerate(dense) for g, v in enumerate(row) if v]
    clusters = spark.createDataFrame([(c, c % 2) for c in range(len(dense))], "cell long, cluster int")
    got = {(r.cluster, r.gene): r.z for r in expression.wilcoxon(spark.createDataFrame(values, "cell long, gene long, value double"), clusters).collect()}
    n = len(dense)
    for g in range(4):
        col = np.array([row[g] for row in dense])
        if not col.any():
            continue
        ranks = np.array([(col < x).sum() + ((col == x).sum() + 1) / 2 for x in col])
        assert ranks.sum() == n * (n + 1) / 2
        for k in (0, 1):
            own = np.arange(n) % 2 == k
            z = (ranks[own].sum() - own.sum() * (n + 1) / 2) / math.sqrt(own.sum() * (~own).sum() * (n + 1) / 12)
            assert abs(got[k, g] - z) < 1e-9


def test_neighbours_graph_and_components(spark):
    r = np.random.default_rng(1)
    x = np.concatenate([r.normal(0, 0.1, (30, 5)), r.normal(3, 0.1, (30, 5))])
    v = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "id long, v array<double>")
    near = neighbours.nearest(v, 6, block=16)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    np.fill_diagonal(d, np.inf)
    want = {(i, int(j)) for i in range(60) for j in np.argsort(d[i])[:6]}
    assert {(q.a, q.b) for q in near.collect()} == want
    edges = neighbours.fuzzy_weights(near, 6)
    assert all(0 < e.weight <= 1 for e in edges.collect())
    labels = neighbours.label_propagation(edges, 6)
    by = {q.a: q.cluster for q in labels.collect()}
    assert not {by[i] for i in range(30)} & {by[i] for i in range(30, 60)}
    assert neighbours.modularity(edges, labels).first()[0] > 0.3
    mean, comp, var = neighbours.principal_components(v, 3)
    assert np.allclose(mean, x.mean(0)) and np.allclose(var, np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1][:3])
    assert neighbours.project(v, mean, comp).count() == 60
    s = neighbours.doublet_scores(v, k=5).collect()
    assert len(s) == 60 and all(q.doublet_score >= 0 for q in s)


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
@pytest.mark.parametrize("block", [2048, 64])
def test_nearest_of_equal_vectors_takes_the_smallest_ids(spark, metric, block):
    r = np.random.default_rng(3)
    x = np.concatenate([np.tile(r.normal(0, 1, 6), (100, 1)), np.zeros((40, 6)), r.normal(0, 1, (20, 6))])[r.permutation(160)]
    got = neighbours.nearest(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>"), 19, metric, block=block)
    n = np.linalg.norm(x, axis=1)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)) if metric == "euclidean" else 1 - (x[:, None] * x[None]).sum(2) / np.maximum(n[:, None] * n[None], 1e-300)
    want = {(i, rank, j) for i in range(160) for rank, j in enumerate(sorted(set(range(160)) - {i}, key=lambda j: (round(d[i, j], 9), j))[:19], 1)}
    assert {(q.a, q["rank"], q.b) for q in got.collect()} == want


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_nearest_leaves_far_pieces_out_and_stays_exact(spark, metric):
    r = np.random.default_rng(11)
    mid = r.normal(0, 40, (12, 8))
    x = np.concatenate([m + r.normal(0, 1, (40, 8)) for m in mid] + [np.tile(mid[0], (150, 1)), np.zeros((5, 8)), r.normal(0, 60, (30, 8))])
    x = x[r.permutation(len(x))]
    ids = r.permutation(4 * len(x))[: len(x)]
    odd = [(10_000, None), (10_001, []), (10_002, [1.0] * 7 + [float("nan")]), (10_003, [1.0] * 7 + [float("inf")]), (10_004, [1.0] * 7 + [None])]
    rows = [(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)] + odd
    got = neighbours.nearest(spark.createDataFrame(rows, "id long, v array<double>"), 7, metric, block=32).collect()
    n = np.linalg.norm(x, axis=1)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2)) if metric == "euclidean" else 1 - (x[:, None] * x[None]).sum(2) / np.maximum(n[:, None] * n[None], 1e-300)
    of = {int(i): p for p, i in enumerate(ids)}
    want = {(a, rank, b) for a in of for rank, b in enumerate(sorted(set(of) - {a}, key=lambda b: (round(d[of[a], of[b]], 9), b))[:7], 1)}
    assert {(q.a, q["rank"], q.b) for q in got} == want and len(got) == len(want)
    assert all(abs(q.distance - d[of[q.a], of[q.b]]) < 1e-9 for q in got)


@pytest.mark.parametrize("rows", [[], [(1, [0.0, 0.0])], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nearest_of_few(spark, rows):
    for metric in ("euclidean", "cosine"):
        got = neighbours.nearest(spark.createDataFrame(rows, "id long, v array<double>"), 3, metric).collect()
        assert {(q.a, q.b) for q in got} == ({(1, 2), (2, 1)} if len(rows) == 2 else set())


def test_tiles_cover_the_tissue_once(spark):
    mask = np.zeros((32, 32), int)
    mask[:20, :24] = 1
    m = spark.createDataFrame([(1, i, j, int(mask[i, j])) for i in range(32) for j in range(32)], "slide int, y int, x int, tissue long")
    sums = tiler.prefix_sums(m)
    p = {(r.y, r.x): r.s for r in sums.collect()}
    assert p[32, 32] == mask.sum() and p[10, 5] == mask[:10, :5].sum() and p[0, 7] == 0
    boxes = spark.createDataFrame([(1, 0, 0, 32, 32)], "slide int, y0 int, x0 int, y1 int, x1 int")
    got = tiler.adaptive_tiles(boxes, sums, 16, 512, 512, 256, 64).collect()
    area = sum((t.y1 - t.y0) * (t.x1 - t.x0) for t in got)
    assert len(set(got)) == len(got) and area >= mask.sum() * 256 and all(0 <= t.y0 < t.y1 <= 512 and 0 <= t.x0 < t.x1 <= 512 for t in got)
    assert tiler.adaptive_tiles(boxes, tiler.prefix_sums(m.withColumn("tissue", F.lit(0).cast("long"))), 16, 512, 512).count() == 0
    g = tiler.grid_tiles(spark.createDataFrame([(1, 500, 300)], "slide int, height int, width int"), 256, 32).collect()
    assert max(t.y1 for t in g) == 500 and max(t.x1 for t in g) == 300


def test_column_functions(spark):
    df = spark.createDataFrame([("10",), ("9",), ("b",), ("a",), (None,)], "c string")
    assert [r.c for r in df.orderBy(*cluster_order(F.col("c"))).collect() if r.c] == ["9", "10", "a", "b"]
    got = df.select(starts_with_any(F.col("c"), ("A", "1")).alias("s"), share(F.lit(1), F.lit(0)).alias("n"), share(F.lit(1), F.lit(0), 0.5).alias("h")).collect()
    assert [r.s for r in got] == [True, False, False, True, False] and got[0].n is None and got[0].h == 0.5


def test_adjusted_p_of_ties_nulls_and_clusters(spark):
    from spotlattice.operators import expression

    rng = np.random.default_rng(5)
    rows = [(c, g, None if c == 2 or (c == 1 and g % 50 == 0) else float(round(p, 2))) for c in (0, 1, 2, None) for g, p in enumerate(rng.random(300) ** 2)]
    got = expression.adjust(spark.createDataFrame(rows, "cluster int, gene int, p double"), "p")
    assert not [x for x in got._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Window" in x and "gene" in x]  # no window holds a cluster's genes
    expected = {}
    for c in (0, 1, 2, None):
        own = sorted((x for x in rows if x[0] == c), key=lambda x: (x[2] is not None, x[2] or 0.0, x[1]))
        m, low = sum(x[2] is not None for x in own), 1.0
        for k in range(len(own), 0, -1):
            low = low if own[k - 1][2] is None else min(low, own[k - 1][2] * m / k)
            expected[own[k - 1][:2]] = low
    assert {(x.cluster, x.gene): x.p_adj for x in got.collect()} == expected


def test_markers_are_ranked_in_tasks_that_are_not_merged(spark):
    from spotlattice.operators import expression

    values = spark.createDataFrame([(c, g, float(1 + (c * g) % 3)) for c in range(8) for g in range(5)], "cell int, gene int, value double")
    clusters = spark.createDataFrame([(c, c % 2) for c in range(8)], "cell int, cluster int")
    plan = expression.wilcoxon(values, clusters)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") >= 2
