"""Outlines by winding: repair, union, growth and intersection of polygons with one rule.

All four are the same question about a set of directed edges: which of their pieces have the inside
on one side only. Edges are split where they meet, the winding number beside each piece is counted,
pieces between inside and outside are kept with the inside on their left, and walked into rings.

* repair: inside where the number is odd; what crosses itself falls into valid parts.
* union: counter-clockwise rings, inside where the number is not 0.
* growth: every edge moved outwards, arcs at corners that turn outwards, through the corner at the
  others; inside where the number is positive (Chen and McMains, 2005). No star shape is assumed.
* intersection: inside where two outlines are both counted.

A region is worked on in one task, in numpy; regions that overlap are brought together first by a
grid join and connected components, so a task sees one group of overlapping regions at a time.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut, ship, spread
from . import geometry as g
from .graph import components
from .voronoi import envelope, voronoi_cells

#: Comparisons that numpy makes at a time.
AT_ONCE = 4_000_000
#: Segments of a quarter of a circle, as in common geometry libraries.
QUARTER = 16
RINGS = "part int, ring int, xs array<double>, ys array<double>, area double"


def odd(w: np.ndarray) -> np.ndarray:
    return w % 2 != 0


def area_of(e: np.ndarray) -> float:
    return float((e[:, 0] * e[:, 3] - e[:, 2] * e[:, 1]).sum() / 2)


def split(e: np.ndarray, grid: float) -> np.ndarray:
    """Pieces of edges (x1, y1, x2, y2) between all points where they meet, on a grid of coordinates."""
    p, r = e[:, :2], e[:, 2:] - e[:, :2]
    lo, hi = np.minimum(e[:, :2], e[:, 2:]) - grid, np.maximum(e[:, :2], e[:, 2:]) + grid
    met, rows = [], max(1, AT_ONCE // len(e))
    for a in range(0, len(e), rows):
        x, y = np.nonzero((lo[a : a + rows, None] <= hi[None, a:]).all(2) & (lo[None, a:] <= hi[a : a + rows, None]).all(2))
        met.append(np.stack([x, y])[:, x < y] + a)
    i, j = np.concatenate(met, axis=1)
    den = r[i, 0] * r[j, 1] - r[i, 1] * r[j, 0]
    q = p[j] - p[i]
    with np.errstate(divide="ignore", invalid="ignore"):
        t = (q[:, 0] * r[j, 1] - q[:, 1] * r[j, 0]) / den
        u = (q[:, 0] * r[i, 1] - q[:, 1] * r[i, 0]) / den
    size = np.sqrt((r * r).sum(1))
    slack_t, slack_u = grid / np.maximum(size[i], grid), grid / np.maximum(size[j], grid)
    meet = (np.abs(den) > 1e-12 * size[i] * size[j]) & (t >= -slack_t) & (t <= 1 + slack_t) & (u >= -slack_u) & (u <= 1 + slack_u)
    at = p[i[meet]] + t[meet, None] * r[i[meet]]
    owner, point = [i[meet], j[meet]], [at, at]
    # ends of one edge that lie on another: touching and overlapping edges
    for a, b in ((i, j), (j, i)):
        for end in (e[b, :2], e[b, 2:]):
            w = ((end - p[a]) * r[a]).sum(1) / np.maximum(size[a] ** 2, grid**2)
            off = np.abs((end[:, 0] - p[a][:, 0]) * r[a][:, 1] - (end[:, 1] - p[a][:, 1]) * r[a][:, 0]) / np.maximum(size[a], grid)
            on = (off <= grid) & (w > 0) & (w < 1)
            owner.append(a[on])
            point.append(end[on])
    n = np.arange(len(e))
    owner, point = np.concatenate([n, n, *owner]), np.concatenate([e[:, :2], e[:, 2:], *point])
    along = ((point - p[owner]) * r[owner]).sum(1)
    order = np.lexsort((along, owner))
    owner, point = owner[order], np.round(point[order] / grid) * grid + 0.0
    same = (owner[1:] == owner[:-1]) & (point[1:] != point[:-1]).any(1)
    return np.concatenate([point[:-1][same], point[1:][same]], axis=1)


def winding(x: np.ndarray, y: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Winding number of the edges about each point."""
    up = (e[None, :, 1] <= y[:, None]) & (e[None, :, 3] > y[:, None])
    down = (e[None, :, 1] > y[:, None]) & (e[None, :, 3] <= y[:, None])
    left = (e[None, :, 2] - e[None, :, 0]) * (y[:, None] - e[None, :, 1]) - (x[:, None] - e[None, :, 0]) * (e[None, :, 3] - e[None, :, 1])
    return (up & (left > 0)).sum(1).astype(np.int64) - (down & (left < 0)).sum(1)


def outline(e: np.ndarray, inside: Callable[[np.ndarray], np.ndarray]) -> list[np.ndarray]:
    """Rings (points in order, inside on the left) of the region of closed edges where ``inside`` holds of the winding number."""
    e = e[(e[:, :2] != e[:, 2:]).any(1)] if len(e) else e
    if not len(e):
        return []
    scale = max(1e-6, float(np.abs(e - np.tile(e[0, :2], 2)).max()))
    base = np.tile(e[0, :2], 2)
    grid = 2.0 ** (math.ceil(math.log2(scale)) - 34)  # a power of two, so that short binary fractions stay as they are
    s = split(e - base, grid)
    if not len(s):
        return []
    turn = (s[:, 0] > s[:, 2]) | ((s[:, 0] == s[:, 2]) & (s[:, 1] > s[:, 3]))
    one_way = np.where(turn[:, None], s[:, [2, 3, 0, 1]], s)
    u, at = np.unique(one_way, axis=0, return_inverse=True)
    net = np.bincount(at.ravel(), np.where(turn, -1, 1), len(u)).astype(np.int64)
    d = u[:, 2:] - u[:, :2]
    size = np.sqrt((d * d).sum(1))
    mid = (u[:, :2] + u[:, 2:]) / 2
    step = np.minimum(size * 1e-3, grid * 64)[:, None] * np.stack([d[:, 1], -d[:, 0]], 1) / size[:, None]
    rows = max(1, AT_ONCE // len(s))
    right = np.concatenate([winding(*(mid + step)[a : a + rows].T, s) for a in range(0, len(u), rows)])
    in_left, in_right = inside(right + net), inside(right)
    kept = np.concatenate([u[in_left & ~in_right], u[in_right & ~in_left][:, [2, 3, 0, 1]]])
    return [r + base[:2] for r in _rings(kept)]


def _rings(e: np.ndarray) -> list[np.ndarray]:
    """Rings of directed edges; where several leave a point the one that bounds the same wedge is taken, so that parts that touch stay apart."""
    out: dict[tuple, list[int]] = {}
    for i, (x, y) in enumerate(e[:, :2].tolist()):
        out.setdefault((x, y), []).append(i)
    angle = np.arctan2(e[:, 3] - e[:, 1], e[:, 2] - e[:, 0])
    used = np.zeros(len(e), dtype=bool)
    rings = []
    for first in range(len(e)):
        if used[first]:
            continue
        ring, i = [], first
        while not used[i]:
            used[i] = True
            ring.append(e[i, :2])
            ways = [k for k in out.get(tuple(e[i, 2:].tolist()), []) if not used[k]]
            if not ways:
                break
            back = angle[i] + math.pi
            i = min(ways, key=lambda k: (back - angle[k] - 1e-12) % (2 * math.pi))
        if len(ring) >= 3:
            rings.append(np.array(ring))
    return rings


def edges_of(ring: np.ndarray) -> np.ndarray:
    return np.concatenate([ring, np.roll(ring, -1, axis=0)], axis=1)


def all_edges(rings: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([edges_of(r) for r in rings]) if rings else np.zeros((0, 4))


def moved(rings: list[np.ndarray], radius: float) -> np.ndarray:
    """Edges of rings (inside on the left) moved to their right by ``radius``, with arcs at left turns."""
    out = []
    for ring in rings:
        d = np.roll(ring, -1, axis=0) - ring
        d /= np.sqrt((d * d).sum(1))[:, None]
        normal = np.stack([d[:, 1], -d[:, 0]], 1)
        path = []
        for k in range(len(ring)):
            v, a, b = ring[k], normal[k - 1], normal[k]
            bend = math.atan2(d[k - 1, 0] * d[k, 1] - d[k - 1, 1] * d[k, 0], float(d[k - 1] @ d[k]))
            if bend >= 0:
                n = max(1, math.ceil(bend / (math.pi / 2 / QUARTER) - 1e-9))
                start = math.atan2(a[1], a[0])
                path += [v + radius * np.array([math.cos(start + bend * i / n), math.sin(start + bend * i / n)]) for i in range(n + 1)]
            else:
                path += [v + radius * a, v, v + radius * b]
        out.append(np.array(path))
    return all_edges(out)


def grown(rings: list[np.ndarray], radius: float) -> list[np.ndarray]:
    return outline(moved(rings, radius), lambda w: w > 0) if radius > 0 else rings


def within(points: np.ndarray, cell: np.ndarray) -> bool:
    """Whether all points lie in a convex cell of counter-clockwise edges, or on its edge."""
    d = cell[:, 2:] - cell[:, :2]
    left = d[None, :, 0] * (points[:, None, 1] - cell[None, :, 1]) - d[None, :, 1] * (points[:, None, 0] - cell[None, :, 0])
    return bool((left >= -1e-12 * np.abs(cell).max() ** 2).all())


def numbered(rings: list[np.ndarray]) -> list[tuple[int, int, list[float], list[float], float]]:
    """Rows of RINGS: an outer ring is ring 0 of its part, holes follow; parts by area, largest first."""
    areas = [area_of(edges_of(r)) for r in rings]
    outer = sorted((i for i, a in enumerate(areas) if a > 0), key=lambda i: (-areas[i], rings[i].min(0).tolist()))
    held: dict[int, list[int]] = {i: [] for i in outer}
    for h in (i for i, a in enumerate(areas) if a < 0):
        x, y = ((rings[h][0] + rings[h][1]) / 2).tolist()
        around = [i for i in outer if areas[i] > -areas[h] and winding(np.array([x]), np.array([y]), edges_of(rings[i]))[0]]
        if around:
            held[min(around, key=lambda i: areas[i])].append(h)
    rows = []
    for part, i in enumerate(outer):
        rows += [(part, k, rings[r][:, 0].tolist(), rings[r][:, 1].tolist(), areas[r]) for k, r in enumerate([i, *held[i]])]
    return rows


def flat_edges(edges: Column) -> Column:
    return F.flatten(F.transform(edges, lambda e: F.array(e["x1"], e["y1"], e["x2"], e["y2"])))


def _mapped(df: DataFrame, keys: list[str], columns: list[str], schema: str, f: Callable[..., list[tuple]]) -> DataFrame:
    """Rows f(*numpy of the columns) of each row, behind its keys. Columns are flat arrays of numbers; null is an empty one.

    Rows with equal columns are worked out once, over all cores, and their result goes to each of their keys.
    """
    ship(df.sparkSession)
    own = ", ".join(f"`{c}` array<double>" for c in columns)
    names = [c.strip().split(" ")[0] for c in schema.split(", ")]

    def run(batches):
        for b in batches:
            rows, at = [], []
            for r in range(b.num_rows):
                found = f(*[np.array(c[r].as_py(), dtype=np.float64) for c in b.columns])
                rows += found
                at += [r] * len(found)
            given = [c.take(pa.array(at, pa.int64())) for c in b.columns]
            types = {"int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "array<double>": pa.list_(pa.float64())}
            made = [pa.array([x[i] for x in rows], types[c.strip().split(" ")[1]]) for i, c in enumerate(schema.split(", "))]
            yield pa.RecordBatch.from_arrays([*given, *made], names=[*columns, *names])

    none = F.array().cast("array<double>")
    given = df.select(*keys, *[F.coalesce(c, none).alias(c) for c in columns])
    once = spread(given.select(*columns).distinct(), *columns).mapInArrow(run, f"{own}, {schema}")
    return given.join(once, columns).select(*keys, *names)


def repaired_parts(regions: DataFrame, key: str = "cell_id") -> DataFrame:
    """key, part, ring, xs, ys, area: valid rings of each region's even-odd inside; ring 0 of a part is its outline (area above 0), the others holes.

    A ring that crosses itself falls into parts, spikes and edges that come twice vanish, touching parts stay apart. A
    region without an inside, or without edges, has no row.
    """
    return _mapped(regions.withColumn("_e", flat_edges(F.col("edges"))), [key], ["_e"], RINGS, lambda e: numbered(outline(e.reshape(-1, 4), odd)))


def dissolved(regions: DataFrame, key: str = "cell_id", size: float = 16.0) -> DataFrame:
    """The union of overlapping regions: group (smallest key of regions that hang together by overlapping boxes), part, ring, xs, ys, area.

    Boxes meet on a grid of ``size``, so no pair of far regions is looked at. Regions with equal edges
    count once. The different edges of a group have to fit a task, which compares AT_ONCE pairs of
    them at a time. Regions whose boxes meet without overlapping are parts of one group.
    """
    regions = regions.filter(F.size("edges") > 0).groupBy("edges").agg(F.min(key).alias(key))
    regions = cut(regions.select(key, "edges"))
    boxed = regions.select(F.col(key).alias("k"), *g.bounds(F.col("edges"))).filter("x_lo is not null")
    slots = [F.explode(F.sequence(*[F.floor(F.col(f"{a}_{s}") / size).cast("long") for s in ("lo", "hi")])) for a in "xy"]
    dealt = cut(boxed.withColumn("gx", slots[0]).withColumn("gy", slots[1]))
    other = dealt.select("gx", "gy", F.col("k").alias("o"), *[F.col(c).alias(f"o_{c}") for c in ("x_lo", "x_hi", "y_lo", "y_hi")])
    meet = " and ".join(f"{a}_lo <= o_{a}_hi and o_{a}_lo <= {a}_hi" for a in "xy")
    links = dealt.join(other, ["gx", "gy"]).filter("k > o").filter(meet).select(F.col("k").alias("a"), F.col("o").alias("b")).distinct()
    group = regions.join(components(links).select(F.col("a").alias(key), F.col("b").alias("_g")), key, "left").withColumn("group", F.coalesce("_g", key))
    # each region's own inside first, counter-clockwise, so that windings add up
    valid = repaired_parts(group.select("group", key, "edges").withColumn("_k", F.struct("group", key)), "_k")
    told = valid.withColumn("_e", flat_edges(g.ring_edges(F.col("xs"), F.col("ys")))).groupBy(F.col("_k.group").alias("group")).agg(F.flatten(F.collect_list("_e")).alias("_e"))
    return _mapped(told, ["group"], ["_e"], RINGS, lambda e: numbered(outline(e.reshape(-1, 4), lambda w: w > 0)))


def buffered(regions: DataFrame, radius: float, key: str = "cell_id") -> DataFrame:
    """key, part, ring, xs, ys, area of all within ``radius`` of each region, round at corners; radius 0 repairs only."""

    def one(e: np.ndarray) -> list[tuple]:
        return numbered(grown(outline(e.reshape(-1, 4), odd), radius))

    return _mapped(regions.withColumn("_e", flat_edges(F.col("edges"))), [key], ["_e"], RINGS, one)


def dilate_capped(regions: DataFrame, radius: float, key: str = "cell_id", pad: float = 50.0, size: float = 16.0) -> DataFrame:
    """Grown outlines, cut at the Voronoi cell of the region's centroid: key, part, ring, xs, ys, area and the region's
    region_area, grown_area, out_area, gain and clipped.

    The cells lie in the regions' box, wider by ``pad``; regions with one centroid share its cell. Where nothing of a grown region is in its
    cell the region stays as it is. Regions without an area have no row.
    """
    box = envelope(regions, pad)
    cx, cy = g.centroid(F.col("edges"))
    held = cut(regions.select(key, flat_edges(F.col("edges")).alias("_e"), cx.alias("x"), cy.alias("y")).filter("x is not null"))
    cells = voronoi_cells(held, box, size, key, shared=True)
    ring = F.flatten(F.transform("ring", lambda p: F.array(p["x"], p["y"])))
    both = held.join(cells.select(key, ring.alias("_v")), key)

    def one(e: np.ndarray, v: np.ndarray) -> list[tuple]:
        own = outline(e.reshape(-1, 4), odd)
        big = grown(own, radius)
        area, large = area_of(all_edges(own)), area_of(all_edges(big))
        cell = edges_of(v.reshape(-1, 2)) if len(v) else np.zeros((0, 4))
        if len(cell) and big and within(np.concatenate(big), cell):
            out = big  # as it is: cutting would put its points on another grid
        else:
            out = (outline(np.concatenate([all_edges(big), cell]), lambda w: w > 1) if len(cell) else []) or own
        size_ = area_of(all_edges(out))
        return [(*row, area, large, size_, max(0.0, size_ - area), size_ + 1e-9 < large) for row in numbered(out)]

    return _mapped(both, [key], ["_e", "_v"], RINGS + ", region_area double, grown_area double, out_area double, gain double, clipped boolean", one)


def dilation_figures(dilated: DataFrame, key: str = "cell_id") -> DataFrame:
    """One row: cells, clipped, clipped_pct, mean_gain, median_gain of what ``dilate_capped`` gives."""
    per = dilated.filter("part = 0 and ring = 0").select(key, "gain", "clipped")
    return per.agg(
        F.count(F.lit(1)).alias("cells"), F.count_if("clipped").alias("clipped"), F.round(100 * F.avg(F.col("clipped").cast("int")), 6).alias("clipped_pct"),
        F.round(F.avg("gain"), 6).alias("mean_gain"), F.round(F.percentile("gain", F.lit(0.5)), 6).alias("median_gain"),
    )
