"""Outlines from tiles by a model that the caller brings."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship
from . import raster

Predict = Callable[[np.ndarray], list[tuple[list[float], list[float]]]]


def dense(places: Column, values: Column, size: int) -> Column:
    """Array of ``size`` numbers: each value at its place, 0 elsewhere, in one pass over the values."""

    def fill(at: pd.Series, v: pd.Series) -> pd.Series:
        rows = []
        for p, x in zip(at, v, strict=True):
            row = np.zeros(size)
            row[np.asarray(p, dtype=np.int64)] = np.asarray(x, dtype=np.float64)
            rows.append(row)
        return pd.Series(rows, index=at.index, dtype=object)

    ship(SparkSession.getActiveSession())
    return F.pandas_udf(fill, "array<double>")(places, values)


def predict_tiles(tiles: DataFrame, predict: Predict, scale: float = 1.0) -> DataFrame:
    """slide, y0, x0, number, xs, ys: outlines on the slide of what ``predict`` finds in each tile.

    ``tiles``: slide, y0, x0, height, width, pixels (row by row). ``predict`` takes a tile enlarged
    ``scale`` times (each pixel repeated) and gives (ys, xs) of each outline in its coordinates; it is
    sent to the executors once, with whatever weights it holds. A tile without outlines has no rows.
    """
    spark = ship(tiles.sparkSession)
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(predict))
    times = max(1, round(scale))

    def run(frames):
        model = cloudpickle.loads(packed.value)
        for f in frames:
            rows = []
            for t in f.itertuples():
                px = np.asarray(t.pixels, dtype=np.float64).reshape(t.height, t.width)
                found = model(np.kron(px, np.ones((times, times))) if times > 1 else px)
                rows += [(t.slide, t.y0, t.x0, i, [{"y": float(y), "x": float(x)} for y, x in zip(ys, xs, strict=True)]) for i, (ys, xs) in enumerate(found)]
            yield pd.DataFrame(rows, columns=["slide", "y0", "x0", "number", "points"])

    schema = "slide {}, y0 int, x0 int, number int, points array<struct<y:double,x:double>>".format(tiles.schema["slide"].dataType.simpleString())
    got = tiles.select("slide", "y0", "x0", "height", "width", "pixels").mapInPandas(run, schema)
    placed = got.withColumn("p", raster.tile_to_slide(F.col("points"), F.col("y0"), F.col("x0"), float(times)))
    return placed.select("slide", "y0", "x0", "number", F.col("p.x").alias("xs"), F.col("p.y").alias("ys"))


def bright_boxes(level: float) -> Predict:
    """A stand-in for a model: the box of all pixels over ``level``."""

    def predict(px: np.ndarray) -> list[tuple[list[float], list[float]]]:
        y, x = np.nonzero(px > level)
        if not len(y):
            return []
        a, b, c, d = (float(v) for v in (y.min(), y.max() + 1, x.min(), x.max() + 1))
        return [([a, a, b, b], [c, d, d, c])]

    return predict
