"""Voronoi cells and outlines by winding, against rasters and by hand."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotlattice.operators import geometry as g
from spotlattice.operators import outline as o
from spotlattice.operators import voronoi


def ring(*points):
    return np.array(points, dtype=float)


SQUARE = ring((0, 0), (4, 0), (4, 4), (0, 4))
BOW_TIE = ring((0, 0), (2, 2), (2, 0), (0, 2))
COMB = ring((0, 0), (9, 0), (9, 6), (6, 6), (6, 1), (5, 1), (5, 6), (0, 6), (0, 4), (3, 4), (3, 3), (0, 3))


def area(rings):
    return o.area_of(o.all_edges(rings))


def test_bow_tie_becomes_two_parts():
    rings = o.outline(o.edges_of(BOW_TIE), o.odd)
    assert len(rings) == 2 and all(np.isclose(o.area_of(o.edges_of(r)), 1.0) for r in rings)
    assert [r[:2] for r in o.numbered(rings)] == [(0, 0), (1, 0)]


def test_spikes_and_repeats_vanish():
    spiked = ring((0, 0), (4, 0), (9, 0), (4, 0), (4, 4), (0, 4))
    rings = o.outline(o.edges_of(spiked), o.odd)
    assert len(rings) == 1 and np.isclose(area(rings), 16)
    twice = np.concatenate([o.edges_of(SQUARE), o.edges_of(SQUARE)])
    assert o.outline(twice, o.odd) == [] and np.isclose(area(o.outline(twice, lambda w: w != 0)), 16)
    assert o.outline(np.zeros((0, 4)), o.odd) == []


def test_union_and_intersection_of_squares():
    two = np.concatenate([o.edges_of(SQUARE), o.edges_of(SQUARE + 2)])
    union, both = o.outline(two, lambda w: w > 0), o.outline(two, lambda w: w > 1)
    assert len(union) == 1 and np.isclose(area(union), 28) and len(both) == 1 and np.isclose(area(both), 4)
    beside = np.concatenate([o.edges_of(SQUARE), o.edges_of(SQUARE + [4, 0])])
    rings = o.outline(beside, lambda w: w > 0)
    assert len(rings) == 1 and np.isclose(area(rings), 32)
    frame = np.concatenate([o.edges_of(ring((0, 0), (9, 0), (9, 9), (0, 9))), o.edges_of(ring((3, 3), (3, 6), (6, 6), (6, 3)))])
    rows = o.numbered(o.outline(frame, lambda w: w > 0))
    assert [(p, k) for p, k, *_ in rows] == [(0, 0), (0, 1)] and np.isclose(sum(r[4] for r in rows), 72)


def raster_area(e, radius, step=0.02):
    lo, hi = e[:, :2].min(0) - radius - 1, e[:, :2].max(0) + radius + 1
    total = 0
    p, d = e[:, :2], e[:, 2:] - e[:, :2]
    xs = np.arange(lo[0], hi[0], step)
    for y in np.arange(lo[1], hi[1], step):
        inside = o.winding(xs, np.full(len(xs), y), e) != 0
        q = np.stack([xs, np.full(len(xs), y)], 1)[:, None] - p[None]
        t = np.clip((q * d).sum(2) / (d * d).sum(1), 0, 1)
        near = (((q - t[..., None] * d) ** 2).sum(2) <= radius * radius).any(1)
        total += (inside | near).sum()
    return total * step * step


@pytest.mark.parametrize("radius", [0.3, 0.7, 2.0])
def test_growth_of_a_concave_ring(radius):
    got = area(o.grown(o.outline(o.edges_of(COMB), o.odd), radius))
    assert abs(got / raster_area(o.edges_of(COMB), radius) - 1) < 0.005


def test_growth_of_a_convex_ring_is_exact():
    got = area(o.grown([SQUARE], 1.0))
    assert np.isclose(got, 16 + 16 + 64 / 2 * math.sin(2 * math.pi / 64))
    assert np.isclose(area(o.grown([SQUARE], 0.0)), 16)


def test_growth_closes_a_hole():
    frame = [ring((0, 0), (9, 0), (9, 9), (0, 9)), ring((4, 4), (4, 5), (5, 5), (5, 4))]
    assert [(r[0], r[1]) for r in o.numbered(o.grown(frame, 0.4))] == [(0, 0), (0, 1)]
    assert [(r[0], r[1]) for r in o.numbered(o.grown(frame, 0.6))] == [(0, 0)]


def test_random_growth_against_rasters():
    r = random.Random(4)
    for _ in range(4):
        pts = ring(*[((2 + 3 * r.random()) * math.cos(a), (2 + 3 * r.random()) * math.sin(a)) for a in np.linspace(0, 2 * math.pi, 14, endpoint=False)])
        e = o.edges_of(pts)
        valid = o.outline(e, o.odd)
        assert abs(area(o.grown(valid, 0.5)) / raster_area(o.all_edges(valid), 0.5, 0.04) - 1) < 0.01


def regions(spark, rings):
    rows = [(k, [float(x) for x, _ in r], [float(y) for _, y in r]) for k, r in rings]
    df = spark.createDataFrame(rows, "cell_id long, xs array<double>, ys array<double>")
    return df.select("cell_id", g.ring_edges(F.col("xs"), F.col("ys")).alias("edges"))


def test_repair_and_dissolve_in_spark(spark):
    df = regions(spark, [(1, SQUARE), (2, SQUARE + 3), (3, BOW_TIE + 20), (4, SQUARE + 100), (5, [(0, 0), (1, 1)]), (6, [])])
    parts = sorted((r.cell_id, r.part, r.ring, round(r.area, 9)) for r in o.repaired_parts(df).collect())
    assert parts == [(1, 0, 0, 16.0), (2, 0, 0, 16.0), (3, 0, 0, 1.0), (3, 1, 0, 1.0), (4, 0, 0, 16.0)]
    union = sorted((r.group, r.part, round(r.area, 9)) for r in o.dissolved(df).collect())
    assert union == [(1, 0, 31.0), (3, 0, 1.0), (3, 1, 1.0), (4, 0, 16.0)]


def test_voronoi_cells_tile_the_box(spark):
    r = random.Random(3)
    pts = [(i, r.random() * 100, r.random() * 40) for i in range(150)] + [(900 + i, 70 + r.random(), 20 + r.random()) for i in range(80)] + [(990, 5.0, 5.0), (991, 5.0, 5.0), (992, None, 1.0)]
    df = spark.createDataFrame(pts, "cell_id long, x double, y double")
    cells = {c.cell_id: c for c in voronoi.voronoi_cells(df, (-10, -10, 110, 50), 6.0).collect()}
    assert len(cells) == 232 and cells[991].ring == [] and np.isclose(sum(c.area for c in cells.values()), 120 * 60)
    own = {k: np.array([(p.x, p.y) for p in c.ring]) for k, c in cells.items() if c.ring}
    at = {k: (x, y) for k, x, y in pts if x is not None}
    for _ in range(300):
        x, y = r.random() * 120 - 10, r.random() * 60 - 10
        best = min(own, key=lambda k: (at[k][0] - x) ** 2 + (at[k][1] - y) ** 2)
        assert o.winding(np.array([x]), np.array([y]), o.edges_of(own[best]))[0] == 1


def test_voronoi_of_one_and_of_collinear_sites(spark):
    one = voronoi.voronoi_cells(spark.createDataFrame([(1, 3.0, 3.0)], "cell_id long, x double, y double"), (0, 0, 10, 10), 2.0).collect()
    assert [(c.cell_id, c.area) for c in one] == [(1, 100.0)]
    line = spark.createDataFrame([(i, float(i), 5.0) for i in range(11)], "cell_id long, x double, y double")
    got = {c.cell_id: round(c.area, 9) for c in voronoi.voronoi_cells(line, (0, 0, 10, 10), 1.0).collect()}
    assert got == {i: 5.0 if i in (0, 10) else 10.0 for i in range(11)}
    assert voronoi.voronoi_cells(line.filter("false"), (0, 0, 1, 1), 1.0).collect() == []


def test_dilation_is_capped_and_falls_back(spark):
    df = regions(spark, [(1, SQUARE), (2, SQUARE + [5, 0]), (3, SQUARE + [50, 0])])
    got = {r.cell_id: r for r in o.dilate_capped(df, 2.0).collect()}
    free = 16 + 32 + 4 * 32 * math.sin(2 * math.pi / 64)
    assert np.isclose(got[3].out_area, free) and not got[3].clipped and got[1].clipped and got[2].clipped
    # beyond the line halfway between the two, nothing of either
    assert max(got[1].xs) == pytest.approx(4.5) and min(got[2].xs) == pytest.approx(4.5)
    f = o.dilation_figures(o.dilate_capped(df, 2.0)).first()
    assert (f.cells, f.clipped) == (3, 2) and f.clipped_pct == pytest.approx(66.666667)
