"""Adaptive tiles over a tissue mask: a quadtree whose frontier is a DataFrame, level by level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


def prefix_sums(mask: DataFrame) -> DataFrame:
    """slide, y, x, s: tissue pixels above and left of (y, x), both exclusive; ``mask``: slide, y, x, tissue (0 or 1), all pixels."""
    rows = Window.partitionBy("slide", "y").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cols = Window.partitionBy("slide", "x").orderBy("y").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = mask.withColumn("r", F.sum("tissue").over(rows)).withColumn("s", F.sum("r").over(cols)).select("slide", (F.col("y") + 1).alias("y"), (F.col("x") + 1).alias("x"), "s")
    ends = mask.groupBy("slide").agg((F.max("y") + 1).alias("h"), (F.max("x") + 1).alias("w"))
    top = ends.select("slide", F.lit(0).alias("y"), F.explode(F.sequence(F.lit(0), F.col("w"))).alias("x"), F.lit(0).cast("long").alias("s"))
    side = ends.select("slide", F.explode(F.sequence(F.lit(1), F.col("h"))).alias("y"), F.lit(0).alias("x"), F.lit(0).cast("long").alias("s"))
    return s.unionByName(top).unionByName(side)


def adaptive_tiles(
    boxes: DataFrame, sums: DataFrame, scale: int, height: int, width: int, largest: int = 2048, smallest: int = 512, target: float = 0.6, low: float = 0.05, overlap: int = 0
) -> DataFrame:
    """slide, y0, x0, y1, x1 in native pixels, unique.

    ``boxes``: slide, y0, x0, y1, x1 at mask resolution, one per tissue component. A box with at
    most ``low`` of tissue is dropped first; one larger than ``largest`` is split; one with
    ``target`` of tissue and no side under ``smallest`` is taken; any other is split while a side
    is over ``smallest`` and taken when none is. Tiles are padded by half the overlap, grown to
    the smallest side, and clipped.
    """
    big, small = max(1, largest // scale), max(1, smallest // scale)
    frontier, taken = boxes, None
    corner = sums.select("slide", "y", "x", "s")

    def at(df: DataFrame, y: str, x: str, out: str) -> DataFrame:
        return df.join(corner.select("slide", F.col("y").alias(y), F.col("x").alias(x), F.col("s").alias(out)), ["slide", y, x])

    while True:
        f = at(at(at(at(frontier, "y1", "x1", "a"), "y0", "x1", "b"), "y1", "x0", "c"), "y0", "x0", "d")
        h, w = F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0")
        part = F.try_divide((F.col("a") - F.col("b") - F.col("c") + F.col("d")).cast("double"), (h * w).cast("double"))
        f = f.withColumn("p", F.coalesce(part, F.lit(0.0))).filter(F.col("p") > low)
        over = (h > big) | (w > big)
        good = ~over & (((F.col("p") >= target) & (F.least(h, w) >= small)) | ((h <= small) & (w <= small)))
        f = cut(f.withColumn("good", good))
        own = f.filter("good").select("slide", "y0", "x0", "y1", "x1")
        taken = own if taken is None else taken.unionByName(own)
        rest = f.filter("not good")
        if rest.isEmpty():
            break
        my, mx = F.floor((F.col("y0") + F.col("y1")) / 2).cast("int"), F.floor((F.col("x0") + F.col("x1")) / 2).cast("int")

        def halves(a: str, m: Column, b: str, side: Column) -> Column:
            cut = F.array(F.struct(F.col(a).alias("lo"), m.alias("hi")), F.struct(m.alias("lo"), F.col(b).alias("hi")))
            return F.when(side > small, cut).otherwise(F.array(F.struct(F.col(a).alias("lo"), F.col(b).alias("hi"))))

        frontier = (
            rest.withColumn("ys", F.explode(halves("y0", my, "y1", h))).withColumn("xs", F.explode(halves("x0", mx, "x1", w)))
            .select("slide", F.col("ys.lo").alias("y0"), F.col("xs.lo").alias("x0"), F.col("ys.hi").alias("y1"), F.col("xs.hi").alias("x1"))
        )
    pad = overlap // 2

    def grown(a: str, b: str, most: int) -> tuple[Column, Column]:
        lo, hi = F.col(a) * scale - pad, F.col(b) * scale + pad
        short = F.greatest(F.lit(0), F.lit(smallest) - (hi - lo))
        lo, hi = lo - F.floor(short / 2).cast("int"), hi + (short - F.floor(short / 2).cast("int"))
        return F.greatest(F.lit(0), lo), F.least(F.lit(most), hi)

    (y0, y1), (x0, x1) = grown("y0", "y1", height), grown("x0", "x1", width)
    return taken.select("slide", y0.alias("y0"), x0.alias("x0"), y1.alias("y1"), x1.alias("x1")).distinct()


def grid_tiles(slides: DataFrame, side: int, overlap: int) -> DataFrame:
    """Fallback: a regular grid over each slide (slide, height, width)."""
    step = max(64, side - overlap)
    at = lambda c: F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.col(c) - 1), F.lit(step)))
    t = slides.withColumn("y0", at("height")).withColumn("x0", at("width"))
    return t.select("slide", "y0", "x0", F.least(F.col("y0") + side, F.col("height")).alias("y1"), F.least(F.col("x0") + side, F.col("width")).alias("x1"))
