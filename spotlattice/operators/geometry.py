"""Polygons as arrays of edges, and tests of points against them, in column expressions.

A region is one row with an array of edges (x1, y1, x2, y2) of all its rings; inside is decided by
the even-odd rule, so holes and several parts need no extra care.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cosine and sine of multiples of 45 degrees.
OCTAGON = [(1.0, 0.0), (0.7071067811865476, 0.7071067811865476), (0.0, 1.0), (-0.7071067811865476, 0.7071067811865476),
           (-1.0, 0.0), (-0.7071067811865476, -0.7071067811865476), (0.0, -1.0), (0.7071067811865476, -0.7071067811865476)]
EDGES = "array<struct<x1:double,y1:double,x2:double,y2:double>>"


def octagon(cx: Column, cy: Column, radius: Column) -> tuple[Column, Column]:
    """Vertex arrays xs, ys of an octagon."""
    return F.array(*[cx + radius * F.lit(c) for c, _ in OCTAGON]), F.array(*[cy + radius * F.lit(s) for _, s in OCTAGON])


def ring_edges(xs: Column, ys: Column) -> Column:
    """Edges of a ring, closed if it is not."""
    n = F.size(xs)

    def edge(x: Column, i: Column) -> Column:
        j = (i + 1) % n
        return F.struct(x.alias("x1"), ys[i].alias("y1"), xs[j].alias("x2"), ys[j].alias("y2"))

    return F.filter(F.transform(xs, edge), lambda e: (e["x1"] != e["x2"]) | (e["y1"] != e["y2"]))


def region_edges(rings: DataFrame, key: str, xs: str = "xs", ys: str = "ys") -> DataFrame:
    """One row per region from one row per ring."""
    return rings.groupBy(key).agg(F.flatten(F.collect_list(ring_edges(F.col(xs), F.col(ys)))).alias("edges"))


def on_boundary(x: Column, y: Column, edges: Column) -> Column:
    def touches(e: Column) -> Column:
        flat = (e["x2"] - e["x1"]) * (y - e["y1"]) == (e["y2"] - e["y1"]) * (x - e["x1"])
        return flat & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])) & y.between(F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"]))

    return F.exists(edges, touches)


def odd_crossings(x: Column, y: Column, edges: Column) -> Column:
    def crosses(e: Column) -> Column:
        return ((e["y1"] > y) != (e["y2"] > y)) & (x < (e["x2"] - e["x1"]) * (y - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"])

    return F.size(F.filter(edges, crosses)) % 2 == 1


def covers(x: Column, y: Column, edges: Column) -> Column:
    """Interior or boundary."""
    return odd_crossings(x, y, edges) | on_boundary(x, y, edges)


def contains(x: Column, y: Column, edges: Column) -> Column:
    """Interior only."""
    return odd_crossings(x, y, edges) & ~on_boundary(x, y, edges)


def edge_distance(x: Column, y: Column, edges: Column) -> Column:
    """Distance to the nearest edge."""

    def one(e: Column) -> Column:
        dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((x - e["x1"]) * dx + (y - e["y1"]) * dy) / (dx * dx + dy * dy)))
        px, py = x - (e["x1"] + t * dx), y - (e["y1"] + t * dy)
        return F.sqrt(px * px + py * py)

    return F.array_min(F.transform(edges, one))


def bounds(edges: Column) -> list[Column]:
    return [
        F.array_min(F.transform(edges, lambda e: F.least(e["x1"], e["x2"]))).alias("x_lo"),
        F.array_max(F.transform(edges, lambda e: F.greatest(e["x1"], e["x2"]))).alias("x_hi"),
        F.array_min(F.transform(edges, lambda e: F.least(e["y1"], e["y2"]))).alias("y_lo"),
        F.array_max(F.transform(edges, lambda e: F.greatest(e["y1"], e["y2"]))).alias("y_hi"),
    ]


def _total(edges: Column, f) -> Column:
    return F.aggregate(edges, F.lit(0.0), lambda acc, e: acc + f(e))


def signed_area(edges: Column) -> Column:
    return _total(edges, lambda e: e["x1"] * e["y2"] - e["x2"] * e["y1"]) / 2


def centroid(edges: Column) -> tuple[Column, Column]:
    """Area-weighted; rings of a hole run the other way round."""
    a = F.nullif(signed_area(edges), F.lit(0.0))
    return (
        _total(edges, lambda e: (e["x1"] + e["x2"]) * (e["x1"] * e["y2"] - e["x2"] * e["y1"])) / (6 * a),
        _total(edges, lambda e: (e["y1"] + e["y2"]) * (e["x1"] * e["y2"] - e["x2"] * e["y1"])) / (6 * a),
    )


def is_simple(edges: Column) -> Column:
    """Whether a region has an area and no two of its edges cross. Edges that only share an end, or touch, do not cross."""

    def side(a: Column, px: Column, py: Column) -> Column:
        return F.signum((a["x2"] - a["x1"]) * (py - a["y1"]) - (a["y2"] - a["y1"]) * (px - a["x1"]))

    def crosses(a: Column, b: Column) -> Column:
        return (side(a, b["x1"], b["y1"]) * side(a, b["x2"], b["y2"]) < 0) & (side(b, a["x1"], a["y1"]) * side(b, a["x2"], a["y2"]) < 0)

    return (F.abs(signed_area(edges)) > 0) & ~F.exists(edges, lambda a: F.exists(edges, lambda b: crosses(a, b)))


def scan_spans(y: Column, edges: Column) -> Column:
    """Array of (a, b): what of the line at ``y`` lies inside, in order."""
    met = F.filter(edges, lambda s: (s["y1"] > y) != (s["y2"] > y))
    crossings = F.array_sort(F.transform(met, lambda s: (s["x2"] - s["x1"]) * (y - s["y1"]) / (s["y2"] - s["y1"]) + s["x1"]))

    def pairs(at: Column) -> Column:
        each = F.transform(at, lambda v, i: F.struct(v.alias("a"), F.get(at, i + 1).alias("b"), (i % 2 == 0).alias("own")))
        return F.filter(each, lambda p: p["own"] & p["b"].isNotNull())

    return F.transform(F.array(crossings), pairs)[0]  # bound by a lambda, so that it is sorted once


def representative(edges: Column) -> Column:
    """Struct x, y of a point inside: the middle of the widest span of the line halfway between the vertices next to the middle of the box."""

    def halfway(ys: Column) -> Column:
        mid = (F.array_min(ys) + F.array_max(ys)) / 2
        line = lambda m: (F.array_max(F.filter(ys, lambda v: v <= m)) + F.array_min(F.filter(ys, lambda v: v > m))) / 2
        return F.transform(F.array(mid), line)[0]

    def point(y: Column) -> Column:
        widest = F.array_max(F.transform(scan_spans(y, edges), lambda p: F.struct((p["b"] - p["a"]).alias("w"), ((p["a"] + p["b"]) / 2).alias("x"))))
        return F.struct(widest["x"].alias("x"), y.alias("y"))

    # bound by lambdas, so that heights and line are worked out once and not once an edge
    ys = F.flatten(F.transform(edges, lambda e: F.array(e["y1"], e["y2"])))
    return F.transform(F.transform(F.array(ys), halfway), point)[0]


def representative_point(edges: Column) -> tuple[Column, Column]:
    """x, y of ``representative``."""
    p = representative(edges)
    return p["x"], p["y"]


def repaired(edges: Column) -> Column:
    """Edges without those of no length and those that come twice in opposite directions: what even-odd filling sees of a ring that is not valid.

    A ring that crosses itself keeps its edges; inside is then what an odd number of them surrounds.
    """
    back = lambda e: F.exists(edges, lambda o: (o["x1"] == e["x2"]) & (o["y1"] == e["y2"]) & (o["x2"] == e["x1"]) & (o["y2"] == e["y1"]))
    return F.filter(edges, lambda e: ((e["x1"] != e["x2"]) | (e["y1"] != e["y2"])) & ~back(e))
