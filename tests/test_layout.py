"""Places of a graph's nodes: how many neighbours stay near, seeds, and little graphs."""

import random

import numpy as np
import pytest

from spotlattice.operators import layout
from spotlattice.session import Scratch


def ring_graph(groups, size, seed):
    """Groups of points in 5 dimensions, each point joined to its 8 nearest."""
    r = np.random.default_rng(seed)
    x = np.concatenate([r.normal(0, 1, (size, 5)) + 9 * r.normal(0, 1, 5) for _ in range(groups)])
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    near = np.argsort(d, axis=1)[:, 1:9]
    pairs = {(i, int(j)) for i in range(len(x)) for j in near[i]}
    return near, [(i, j, 0.9) for i, j in pairs | {(j, i) for i, j in pairs}]


def kept_near(near, places):
    p = np.array([places[i] for i in range(len(near))])
    d = ((p[:, None] - p[None]) ** 2).sum(2)
    own = np.argsort(d, axis=1)[:, 1:9]
    return np.mean([len(set(a) & set(b)) / 8 for a, b in zip(near, own, strict=True)])


def test_layout_keeps_more_neighbours_than_its_start(spark):
    near, edges = ring_graph(3, 40, 1)
    df = spark.createDataFrame(edges, "a long, b long, weight double").cache()
    first = layout.spectral_start(df, Scratch(spark, "start"), rounds=12).cache()
    start = {r.a: (r.x, r.y) for r in first.collect()}
    got = {r.a: (r.x, r.y) for r in layout.layout(df, rounds=12, block=50, start=first).collect()}
    assert set(got) == set(range(120)) and np.isfinite(list(got.values())).all()
    assert kept_near(near, got) > max(0.35, kept_near(near, start))
    groups = np.array([np.array([got[i] for i in range(40 * g, 40 * g + 40)]).mean(0) for g in range(3)])
    inside = max(np.linalg.norm(np.array(got[i]) - groups[i // 40]) for i in range(120))
    assert min(np.linalg.norm(groups[i] - groups[j]) for i in range(3) for j in range(i)) > inside / 2
    again = {r.a: (r.x, r.y) for r in layout.layout(df, rounds=12, block=50, start=first).collect()}
    assert all(np.allclose(again[i], got[i]) for i in got)


def test_spectral_start_separates_parts(spark):
    r = random.Random(2)
    pairs = {(i, j) for i in range(30) for j in range(i) if i // 15 == j // 15 and r.random() < 0.5} | {(20, 3)}
    edges = [(i, j, 1.0) for i, j in pairs] + [(j, i, 1.0) for i, j in pairs]
    got = {x.a: x.x for x in layout.spectral_start(spark.createDataFrame(edges, "a long, b long, weight double"), Scratch(spark, "s"), rounds=20).collect()}
    low, high = [got[i] for i in range(15)], [got[i] for i in range(15, 30)]
    assert max(low) < min(high) or max(high) < min(low)


def test_curve_and_little_graphs(spark):
    a, b = layout.curve(0.1, 1.0)
    assert a == pytest.approx(1.577, abs=0.02) and b == pytest.approx(0.895, abs=0.02)
    a, b = layout.curve(0.5, 1.0)
    assert a == pytest.approx(0.583, abs=0.02) and b == pytest.approx(1.334, abs=0.03)
    none = spark.createDataFrame([(1, 1, 1.0)], "a long, b long, weight double")
    assert layout.layout(none).collect() == []
    two = spark.createDataFrame([(1, 2, 1.0), (2, 1, 1.0)], "a long, b long, weight double")
    start = spark.createDataFrame([(1, 0.0, 0.0), (2, 1.0, 0.0)], "a long, x double, y double")
    assert {r.a for r in layout.layout(two, rounds=2, start=start).collect()} == {1, 2}
