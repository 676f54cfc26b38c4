"""Spatial joins of spots and cells on a grid, so that Spark joins on keys instead of ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut, spread
from . import geometry as g


def _cell(v: Column, size: float) -> Column:
    return F.floor(v / F.lit(float(size))).cast("long")


def grid_join(spots: DataFrame, regions: DataFrame, size: float, pad: float = 0.0, x: str = "x", y: str = "y") -> DataFrame:
    """Pairs of a spot and a region whose bounding box, grown by ``pad``, holds it.

    ``regions`` has an ``edges`` column. Every region is dealt to the grid cells its box meets; every
    spot is in one cell, so no pair comes twice. ``size`` near a region's own keeps both sides small.
    Of the edges only those in reach of the grid row travel with a pair: all that a ray along the row,
    or a distance up to ``pad``, can meet.
    """
    boxed = regions.select("*", *g.bounds(F.col("edges")))
    steps = [F.sequence(_cell(F.col(f"{a}_lo") - pad, size), _cell(F.col(f"{a}_hi") + pad, size)) for a in "xy"]
    low, high = F.col("_gy") * size - pad, (F.col("_gy") + 1) * size + pad
    rows = boxed.withColumn("_gy", F.explode(steps[1])).withColumn("edges", F.filter("edges", lambda e: (F.greatest(e["y1"], e["y2"]) >= low) & (F.least(e["y1"], e["y2"]) <= high)))
    dealt = rows.filter(F.size("edges") > 0).withColumn("_gx", F.explode(steps[0]))
    placed = spots.withColumn("_gx", _cell(F.col(x), size)).withColumn("_gy", _cell(F.col(y), size))
    near = F.col(x).between(F.col("x_lo") - pad, F.col("x_hi") + pad) & F.col(y).between(F.col("y_lo") - pad, F.col("y_hi") + pad)
    return placed.join(dealt, ["_gx", "_gy"]).filter(near).drop("_gx", "_gy", "x_lo", "x_hi", "y_lo", "y_hi")


def assign_spots(spots: DataFrame, regions: DataFrame, spot: str = "spot", cell: str = "cell_id", size: float = 12.0, use_covers: bool = True) -> DataFrame:
    """spot, cell of every spot inside a region; of several regions the smallest id."""
    test = g.covers if use_covers else g.contains
    pairs = grid_join(spots, regions, size).filter(test(F.col("x"), F.col("y"), F.col("edges")))
    return pairs.groupBy(spot).agg(F.min(cell).alias(cell))


def region_filter(regions: DataFrame, rois: DataFrame, cell: str = "cell_id", size: float = 64.0) -> DataFrame:
    """Regions of which a representative point lies strictly inside a region of interest."""
    dealt = spread(regions.select(cell, "edges"), cell)
    points = dealt.select(cell, F.inline(F.array(g.representative(F.col("edges"))))).filter("x is not null")  # a generator, so that a point is worked out once
    return regions.join(roi_filter(points, rois, cell, size).select(cell), cell, "left_semi")


def roi_filter(spots: DataFrame, rois: DataFrame, spot: str = "spot", size: float = 64.0) -> DataFrame:
    """Spots strictly inside the union of the regions of interest."""
    inside = grid_join(spots, rois, size).filter(g.contains(F.col("x"), F.col("y"), F.col("edges")))
    return inside.groupBy(spot).agg(F.min("x").alias("x"), F.min("y").alias("y"))


def assign_dilated(spots: DataFrame, regions: DataFrame, radius: float, spot: str = "spot", cell: str = "cell_id", size: float = 12.0, pad_cap: float = 50.0) -> DataFrame:
    """Spots in regions grown by ``radius`` but capped by the territory of the nearest centroid.

    A spot is in a grown region if it lies within ``radius`` of it and no other centroid is nearer
    than its own (the smaller id of equals, distances taken to 9 decimals: those of regions about one
    point differ by rounding). So only the nearest centroid is asked for its outline. The nearest centroid of a box that,
    grown by ``radius``, holds the spot bounds how far the nearest of all can be. Equal outlines have one
    centroid, and the smallest id of them speaks for all.
    """
    r = min(radius, pad_cap)
    own = regions.groupBy("edges").agg(F.min(cell).alias(cell))
    cx, cy = g.centroid(F.col("edges"))
    centred = cut(own.select(cell, "edges", cx.alias("_cx"), cy.alias("_cy"), *g.bounds(F.col("edges"))))  # read three times
    centred = centred.filter("_cx is not null and _cy is not null")  # here, or Spark works centroids out before it groups
    x, y, edges = F.col("x"), F.col("y"), F.col("edges")
    away = F.sqrt((x - F.col("_cx")) ** 2 + (y - F.col("_cy")) ** 2)
    at = spots.select(F.col(spot), "x", "y", _cell(x, size).alias("_gx"), _cell(y, size).alias("_gy"))
    dealt = centred.select("_cx", "_cy", "x_lo", "x_hi", "y_lo", "y_hi")
    for a in "xy":
        dealt = dealt.withColumn(f"_g{a}", F.explode(F.sequence(_cell(F.col(f"{a}_lo") - r, size), _cell(F.col(f"{a}_hi") + r, size))))
    held = x.between(F.col("x_lo") - r, F.col("x_hi") + r) & y.between(F.col("y_lo") - r, F.col("y_hi") + r)
    near = at.join(dealt, ["_gx", "_gy"]).filter(held).groupBy(spot).agg(F.min("x").alias("x"), F.min("y").alias("y"), F.min(away).alias("_best"))
    near = spread(near, spot)  # all that follows is work on these rows
    box = F.col("_best") + 1e-6
    cells = [F.explode(F.sequence(_cell(F.col(a) - box, size), _cell(F.col(a) + box, size))) for a in "xy"]
    sought = near.withColumn("_gx", cells[0]).withColumn("_gy", cells[1]).drop("_best")
    placed = centred.select(cell, "_cx", "_cy", _cell(F.col("_cx"), size).alias("_gx"), _cell(F.col("_cy"), size).alias("_gy"))
    first = F.min(F.struct(F.round(away, 9).alias("_away"), F.col(cell))).alias("_near")
    nearest = sought.join(placed, ["_gx", "_gy"]).groupBy(spot).agg(F.min("x").alias("x"), F.min("y").alias("y"), first)
    asked = nearest.select(spot, "x", "y", F.col(f"_near.{cell}").alias(cell)).join(centred.select(cell, "edges"), cell)
    gap = F.when(g.covers(x, y, edges), F.lit(0.0)).otherwise(g.edge_distance(x, y, edges))
    return asked.select(spot, cell, gap.alias("_gap")).filter(F.col("_gap") <= r).select(spot, cell, F.round("_gap", 6).alias("distance"))


def dilate_stars(regions: DataFrame, radius: float, cell: str = "cell_id", size: float = 16.0, rays: int = 64) -> DataFrame:
    """Grown and capped outlines: cell, area, grown_area, gained, clipped, of regions that are star-shaped about their centroid.

    The outline is sampled on ``rays`` fixed angles: the farthest point within ``radius`` of the
    region on each ray, cut at the bisectors with neighbours that are near enough to matter.
    """
    import math

    cx, cy = g.centroid(F.col("edges"))
    c = regions.withColumn("_cx", cx).withColumn("_cy", cy)
    reach = F.array_max(F.transform("edges", lambda e: F.sqrt((e["x1"] - F.col("_cx")) ** 2 + (e["y1"] - F.col("_cy")) ** 2))) + radius
    c = c.withColumn("_reach", reach)
    me = c.select(cell, "_cx", "_cy", "_reach")
    hops = [F.explode(F.sequence(_cell(F.col(a) - 2 * F.col("_reach"), size), _cell(F.col(a) + 2 * F.col("_reach"), size))) for a in ("_cx", "_cy")]
    mine = me.withColumn("_gx", hops[0]).withColumn("_gy", hops[1])
    other = me.select(F.col(cell).alias("_o"), F.col("_cx").alias("_ox"), F.col("_cy").alias("_oy"), _cell(F.col("_cx"), size).alias("_gx"), _cell(F.col("_cy"), size).alias("_gy"))
    dx, dy = F.col("_ox") - F.col("_cx"), F.col("_oy") - F.col("_cy")
    near = mine.join(other, ["_gx", "_gy"]).filter((F.col(cell) != F.col("_o")) & (F.sqrt(dx * dx + dy * dy) < 2 * F.col("_reach")))
    cuts = near.groupBy(cell).agg(F.collect_list(F.struct(dx.alias("dx"), dy.alias("dy"))).alias("_cuts"))
    angles = F.array(*[F.lit(2 * math.pi * k / rays) for k in range(rays)])
    none = F.array().cast("array<struct<dx:double,dy:double>>")

    def grown(e_x: Column, e_y: Column, a: Column, edges: Column) -> Column:
        """Largest t with the point at t on the ray within radius of an edge."""
        ux, uy = F.cos(a), F.sin(a)

        def far(e: Column) -> Column:
            vx, vy = e["x2"] - e["x1"], e["y2"] - e["y1"]
            length = F.sqrt(vx * vx + vy * vy)
            nx, ny = vy / length, -vx / length
            side = F.signum((e["x1"] - e_x) * nx + (e["y1"] - e_y) * ny)
            side = F.when(side == 0, F.lit(1.0)).otherwise(side)
            nx, ny = nx * side, ny * side
            den = ux * nx + uy * ny
            t = F.when(F.abs(den) > 1e-12, ((e["x1"] - e_x) * nx + (e["y1"] - e_y) * ny + radius) / den)
            along = ((e_x + t * ux - e["x1"]) * vx + (e_y + t * uy - e["y1"]) * vy) / (length * length)
            flat = F.when((t > 0) & along.between(0.0, 1.0), t)

            def corner(px: Column, py: Column) -> Column:
                bx, by = px - e_x, py - e_y
                mid = bx * ux + by * uy
                off = bx * bx + by * by - mid * mid
                return F.when(off <= radius * radius, mid + F.sqrt(F.greatest(F.lit(0.0), radius * radius - off)))

            return F.greatest(F.coalesce(flat, F.lit(0.0)), F.coalesce(corner(e["x1"], e["y1"]), F.lit(0.0)), F.coalesce(corner(e["x2"], e["y2"]), F.lit(0.0)))

        return F.array_max(F.transform(edges, far))

    def capped(a: Column, cuts_: Column) -> Column:
        ux, uy = F.cos(a), F.sin(a)
        return F.array_min(F.transform(cuts_, lambda k: F.when(k["dx"] * ux + k["dy"] * uy > 1e-12, (k["dx"] * k["dx"] + k["dy"] * k["dy"]) / 2 / (k["dx"] * ux + k["dy"] * uy))))

    s = c.join(cuts, cell, "left").withColumn("_cuts", F.coalesce("_cuts", none))
    s = s.withColumn("_g", F.transform(angles, lambda a: grown(F.col("_cx"), F.col("_cy"), a, F.col("edges"))))
    s = s.withColumn("_t", F.transform(F.arrays_zip(angles.alias("a"), F.col("_g").alias("g")), lambda p: F.least(p["g"], F.coalesce(capped(p["a"], F.col("_cuts")), p["g"]))))
    wedge = math.sin(2 * math.pi / rays) / 2

    def fan(v: str) -> Column:
        n = F.transform(v, lambda t, i: t * F.element_at(F.col(v), ((i + 1) % rays + 1).cast("int")) * wedge)
        return F.aggregate(n, F.lit(0.0), lambda acc, t: acc + t)

    area = F.abs(g.signed_area(F.col("edges")))
    out = s.select(cell, area.alias("area"), fan("_g").alias("uncapped_area"), fan("_t").alias("grown_area"))
    return out.withColumn("gained", F.greatest(F.lit(0.0), F.col("grown_area") - F.col("area"))).withColumn("clipped", F.col("grown_area") + 1e-9 < F.col("uncapped_area"))
