"""Grid maps: histograms of clusters by tile, their entropy, smoothing, and pooling."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def tile_of(v: Column, size: float, tiles: int | None = None) -> Column:
    t = F.floor(v / F.lit(float(size))).cast("long")
    return t if tiles is None else F.greatest(F.lit(0).cast("long"), F.least(F.lit(tiles - 1).cast("long"), t))


def tile_histogram(points: DataFrame, size: float = 64.0, x: str = "x", y: str = "y", cluster: str = "cluster") -> DataFrame:
    return points.groupBy(tile_of(F.col(y), size).alias("ty"), tile_of(F.col(x), size).alias("tx"), cluster).agg(F.count(F.lit(1)).alias("n"))


def tile_entropy(histogram: DataFrame, least: int = 30, single: float | None = None) -> DataFrame:
    """ty, tx, total, entropy: Shannon entropy over log2 of the clusters seen; null below ``least`` points.

    A tile of one cluster has no defined value (0 / 0): null, or ``single`` if given.
    """
    h = histogram.filter("n > 0").withColumn("total", F.sum("n").over(Window.partitionBy("ty", "tx")))
    p = F.col("n") / F.col("total")
    t = h.groupBy("ty", "tx").agg(F.first("total").alias("total"), (-F.sum(p * F.log2(p))).alias("h"), F.count(F.lit(1)).alias("k"))
    value = F.when(F.col("k") > 1, F.col("h") / F.log2(F.col("k").cast("double"))).otherwise(F.lit(single).cast("double"))
    return t.select("ty", "tx", "total", F.when(F.col("total") >= least, value).alias("entropy"))


def smooth(tiles: DataFrame, value: str, height: int, width: int, sigma: float = 1.0, truncate: float = 4.0) -> DataFrame:
    """Gaussian smoothing of a ``height`` x ``width`` grid that ignores nulls; edges repeat.

    Numerator and weight are spread along rows and then along columns, so a tile makes
    2 * (2 * radius + 1) rows and not their square. A source beyond an edge is the edge's tile.
    """
    r = int(truncate * sigma + 0.5)
    weights = [math.exp(-0.5 * (d / sigma) ** 2) for d in range(-r, r + 1)]
    total = sum(weights)
    kernel = F.array(*[F.struct(F.lit(d).alias("d"), F.lit(w / total).alias("w")) for d, w in zip(range(-r, r + 1), weights, strict=True)])

    def spread(df: DataFrame, axis: str, n: int, keep: str) -> DataFrame:
        """Every target within reach of a source, with the sum of the weights that lead to it."""
        lo, hi = F.lit(0), F.lit(n - 1)
        a = F.col(axis)
        targets = F.sequence(F.greatest(lo, a - r), F.least(hi, a + r))
        t = df.withColumn("_o", F.explode(targets))
        reach = F.filter(kernel, lambda k: F.greatest(lo, F.least(hi, F.col("_o") + k["d"])) == F.col(axis))
        w = F.aggregate(reach, F.lit(0.0), lambda acc, k: acc + k["w"])
        return t.withColumn("_w", w).groupBy(keep, F.col("_o").alias(axis)).agg(F.sum(F.col("_v") * F.col("_w")).alias("_v"), F.sum(F.col("_m") * F.col("_w")).alias("_m"))

    src = tiles.filter(F.col(value).isNotNull()).select(F.col("ty").cast("int").alias("ty"), F.col("tx").cast("int").alias("tx"), F.col(value).alias("_v"), F.lit(1.0).alias("_m"))
    out = spread(spread(src, "tx", width, "ty"), "ty", height, "tx")
    return out.filter(F.col("_m") > 1e-6).select(F.col("ty").cast("long").alias("ty"), F.col("tx").cast("long").alias("tx"), (F.col("_v") / F.col("_m")).alias("smoothed"))


def block_pool(pixels: DataFrame, factor: int, value: str, how: str = "max", x: str = "x", y: str = "y") -> DataFrame:
    """Maximum or mean of blocks of factor x factor."""
    f = {"max": F.max, "mean": F.avg}[how]
    return pixels.groupBy(F.floor(F.col(y) / factor).cast("long").alias("by"), F.floor(F.col(x) / factor).cast("long").alias("bx")).agg(f(value).alias("pooled"))


def boundary(labels: DataFrame, label: str = "label", x: str = "x", y: str = "y") -> DataFrame:
    """Labelled pixels of which one of the four neighbours has another label or none."""
    steps = F.array(*[F.struct(F.lit(a).alias("dy"), F.lit(b).alias("dx")) for a, b in ((0, 1), (0, -1), (1, 0), (-1, 0))])
    own = labels.filter(F.col(label) != 0)
    lent = own.select(label, F.explode(steps).alias("s"), x, y).select(F.col(label).alias("_l"), (F.col(y) + F.col("s.dy")).alias(y), (F.col(x) + F.col("s.dx")).alias(x))
    same = own.join(lent, [y, x]).filter(F.col(label) == F.col("_l")).groupBy(y, x).agg(F.count(F.lit(1)).alias("_n"))
    return own.join(same, [y, x], "left").filter(F.coalesce("_n", F.lit(0)) < 4).select(y, x, label)


def padded_bounds(points: DataFrame, pad: Column, by: str | None = None, x: str = "x", y: str = "y") -> DataFrame:
    """Bounding box grown by ``pad`` times its extent (an extent of 0 counts as 1)."""
    g = points.groupBy(by) if by else points
    b = g.agg(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1"))
    w = F.when(F.col("x1") > F.col("x0"), F.col("x1") - F.col("x0")).otherwise(F.lit(1.0))
    h = F.when(F.col("y1") > F.col("y0"), F.col("y1") - F.col("y0")).otherwise(F.lit(1.0))
    keys = [by] if by else []
    return b.select(*keys, (F.col("x0") - w * pad).alias("x0"), (F.col("x1") + w * pad).alias("x1"), (F.col("y0") - h * pad).alias("y0"), (F.col("y1") + h * pad).alias("y1"))
