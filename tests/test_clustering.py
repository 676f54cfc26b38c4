"""Leiden, sparse components and the chain to a clustered bundle, against serial and dense versions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotlattice.operators import expression, leiden, neighbours, sparse_pca
from spotlattice.plans import clustering
from spotlattice.plans.stages import ClusterSettings
from spotlattice.sources import tables


def serial(edges, resolution=1.0, seed=0):
    """Local moving and contraction, node by node, until nothing moves."""
    r = random.Random(seed)
    graph = {}
    for a, b, w in edges:
        graph.setdefault(a, {})[b] = w
    place = {a: a for a in graph}
    m2 = sum(w for n in graph.values() for w in n.values())
    while True:
        k = {a: sum(n.values()) for a, n in graph.items()}
        c = {a: a for a in graph}
        total = dict(k)
        moved, again = False, True
        while again:
            again = False
            for a in r.sample(sorted(graph), len(graph)):
                near = {c[a]: 0.0}
                for b, w in graph[a].items():
                    if b != a:
                        near[c[b]] = near.get(c[b], 0.0) + w
                total[c[a]] -= k[a]
                best = max(near, key=lambda x: (near[x] - resolution * k[a] * total[x] / m2, x == c[a]))
                again |= best != c[a]
                moved |= best != c[a]
                c[a] = best
                total[best] += k[a]
        place = {x: c[y] for x, y in place.items()}
        if not moved:
            return place
        small = {}
        for a, n in graph.items():
            for b, w in n.items():
                to = small.setdefault(c[a], {})
                to[c[b]] = to.get(c[b], 0.0) + w
        graph = small


def quality(edges, labels, resolution=1.0):
    m2 = sum(w for _, _, w in edges)
    inside, degree = {}, {}
    for a, b, w in edges:
        degree[labels[a]] = degree.get(labels[a], 0.0) + w
        if labels[a] == labels[b]:
            inside[labels[a]] = inside.get(labels[a], 0.0) + w
    return sum(inside.get(c, 0.0) / m2 - resolution * (d / m2) ** 2 for c, d in degree.items())


def planted(n, groups, within, between, seed):
    r = random.Random(seed)
    out = []
    for i in range(n):
        for j in range(i):
            if r.random() < (within if i % groups == j % groups else between):
                out += [(i, j, 1.0), (j, i, 1.0)]
    return out


def frame(spark, edges):
    return spark.createDataFrame(edges, "a long, b long, weight double")


def test_leiden_finds_planted_groups(spark):
    edges = planted(160, 4, 0.4, 0.02, 1)
    got = {r.a: r.cluster for r in leiden.leiden(frame(spark, edges), iterations=1).collect()}
    groups = {}
    for a, c in got.items():
        groups.setdefault(c, set()).add(a % 4)
    assert len(groups) == 4 and all(len(x) == 1 for x in groups.values())
    assert sorted(set(got.values())) == [0, 1, 2, 3]


def test_leiden_is_as_good_as_serial_and_resolution_counts(spark):
    edges = planted(120, 8, 0.5, 0.06, 2)
    df = frame(spark, edges).cache()
    found = {x: {r.a: r.cluster for r in leiden.leiden(df, x, iterations=n).collect()} for x, n in ((0.2, 1), (1.0, 2))}
    assert len(set(found[0.2].values())) < len(set(found[1.0].values()))
    q = quality(edges, found[1.0])
    assert q >= 0.98 * max(quality(edges, serial(edges, seed=i)) for i in range(3))
    lp = {r.a: r.cluster for r in neighbours.label_propagation(df).collect()}
    assert q >= quality(edges, lp)


def test_leiden_parts_are_connected(spark):
    edges = planted(60, 6, 0.6, 0.02, 3)
    got = {r.a: r.cluster for r in leiden.leiden(frame(spark, edges), 0.7, iterations=1).collect()}
    near = {}
    for a, b, _ in edges:
        near.setdefault(a, set()).add(b)
    for c in set(got.values()):
        own = {a for a, x in got.items() if x == c}
        seen, todo = set(), [min(own)]
        while todo:
            a = todo.pop()
            if a not in seen:
                seen.add(a)
                todo += near[a] & own
        assert seen == own


@pytest.mark.parametrize("edges", [[], [(1, 1, 2.0)], [(1, 2, 1.0), (2, 1, 1.0), (1, 2, 1.0), (2, 1, 1.0)], [(1, 2, 0.0), (2, 1, 0.0)]])
def test_leiden_of_little(spark, edges):
    got = {r.a: r.cluster for r in leiden.leiden(frame(spark, edges)).collect()}
    assert got == {a: 0 for a, _, w in edges if w}


def matrix(spark, cells, genes, seed, groups=3):
    r = np.random.default_rng(seed)
    rate = r.gamma(0.6, 1.0, (groups, genes)) * 3
    x = r.poisson(rate[np.arange(cells) % groups])
    rows = [(int(i), int(j), int(x[i, j])) for i, j in np.argwhere(x > 0)]
    return x, spark.createDataFrame(rows, "cell long, gene long, n long")


@pytest.mark.parametrize("genes", [40, 8])
def test_components_equal_a_dense_decomposition(spark, genes):
    x, df = matrix(spark, 90, genes, 5)
    n, k = len(x), 5
    values = expression.log_normalise(df)
    stats = expression.gene_mean_var(values, n)
    scaled, zeros = expression.scale(values, stats, 2.0)
    places = sparse_pca.gene_places(stats)
    rows = sparse_pca.sparse_rows(scaled, zeros, spark.range(n).withColumnRenamed("id", "cell"), places).cache()
    mean, comp, variances, whole = sparse_pca.sparse_components(rows, places.count(), k, passes=12)
    total = np.maximum(x.sum(1, keepdims=True), 1)
    y = np.log1p(x * 1e4 / total)
    y = y[:, x.sum(0) > 0]
    z = np.minimum(2.0, (y - y.mean(0)) / np.where(y.std(0, ddof=1) > 0, y.std(0, ddof=1), 1))
    z -= z.mean(0)
    u, s, vt = np.linalg.svd(z, full_matrices=False)
    assert np.allclose(variances, s[:k] ** 2 / (n - 1), rtol=1e-4) and np.isclose(whole, (z**2).sum() / (n - 1))
    got = {r.cell: r.pc for r in sparse_pca.sparse_scores(rows, mean, comp).collect()}
    own = np.array([got[i] for i in range(n)])
    assert own.shape == (n, k) and np.allclose(np.abs(own), np.abs(u[:, :k] * s[:k]), atol=2e-2)
    assert np.allclose(comp @ comp.T, np.eye(k), atol=1e-9)


def test_rows_of_cells_without_values(spark):
    scaled = spark.createDataFrame([(1, "a", 2.0), (1, "x", 9.0), (9, "a", 1.0)], "cell long, gene string, z double")
    zeros = spark.createDataFrame([("a", -1.0), ("b", -0.5)], "gene string, z0 double")
    places = sparse_pca.gene_places(zeros)
    rows = sparse_pca.sparse_rows(scaled, zeros, spark.createDataFrame([(1,), (2,), (2,)], "cell long"), places)
    assert sorted((r.cell, r.ix, r.s) for r in rows.collect()) == [(1, [0], [3.0]), (2, [], [])]
    mean, comp, variances, whole = sparse_pca.sparse_components(rows.filter("cell = 2"), 2, 1)
    assert not variances.any() and whole == 0 and comp.shape == (1, 2)


def test_bundle_of_planted_cells(spark, tmp_path):
    _, df = matrix(spark, 120, 60, 7)
    s = ClusterSettings(n_pcs=8, neighbours=12, variable_genes=40, min_counts=5)
    got = clustering.clustered(df, s, iterations=1)
    got.write(str(tmp_path / "bundle"))
    x, obs, var, notes = tables.read_bundle(spark, str(tmp_path / "bundle"))
    cells = obs.collect()
    assert len(cells) == 120 and all(len(r.pc) == 8 for r in cells) and var.count() == 40
    groups = {}
    for r in cells:
        groups.setdefault(r.cluster, []).append(r.cell % 3)
    assert sum(max(g.count(i) for i in range(3)) for g in groups.values()) >= 114
    assert 0 < clustering.explained(notes).sum() <= 1 and notes["cells"] == 120
    assert spark.read.parquet(str(tmp_path / "bundle/edges")).filter(F.col("weight") > 1).isEmpty()


def test_weights_equal_a_serial_bisection(spark):
    r = random.Random(4)
    near = [(a, b, r.choice([0.0, 0.5, 2.0 * r.random()])) for a in range(40) for b in r.sample([x for x in range(40) if x != a], 1 + a % 9)]
    df = spark.createDataFrame(near, "a long, b long, distance double")
    found = neighbours.fuzzy_weights(df, 6)
    # no bisection in an expression, row by row and once for each of the joins that read it
    assert "sequence(" not in found._jdf.queryExecution().toString()
    w = {}
    for a in range(40):
        own = {b: d for x, b, d in near if x == a}
        low, at, lo, hi = min(own.values()), 1.0, 0.0, math.inf
        for _ in range(40):
            high = sum(math.exp(-(d - low) / at) for d in own.values()) > math.log2(6)
            lo, hi = (lo, at) if high else (at, hi)
            at = at * 2 if hi == math.inf else (lo + hi) / 2
        w |= {(a, b): math.exp(-(d - low) / max(at, 1e-12)) for b, d in own.items()}
    wanted = {(x, y): w.get((x, y), 0.0) + w.get((y, x), 0.0) - w.get((x, y), 0.0) * w.get((y, x), 0.0) for p in w for x, y in (p, p[::-1])}
    got = {(x.a, x.b): x.weight for x in found.collect()}
    assert got.keys() == wanted.keys() and all(abs(got[p] - wanted[p]) < 1e-9 for p in got)
    assert neighbours.fuzzy_weights(df.limit(0), 6).collect() == []


def test_no_row_a_gene_comes_to_the_driver(spark, monkeypatch):
    counts = spark.createDataFrame([(c, g, 1 + (c * g) % (2 + g % 5)) for c in range(30) for g in range(300) if (c + g) % 3], "cell long, gene long, n long")
    sizes, own = [], type(counts).toPandas
    monkeypatch.setattr(type(counts), "toPandas", lambda df: sizes.append(len(own(df))) or own(df))
    monkeypatch.setattr(expression.expected_sd, "__defaults__", (0.3, "gene", 50))
    monkeypatch.setattr(leiden, "leiden", lambda edges, *_, **__: edges.select("a", F.lit(0).alias("cluster")).distinct())
    got = clustering.clustered(counts, ClusterSettings(n_pcs=3, neighbours=4, variable_genes=12), place=False)
    assert got.obs.count() == 30 and got.var.count() == 12 and max(sizes) <= 50
