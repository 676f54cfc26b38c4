"""Binary formats: regions of interest and image headers and strips, read where the files lie."""

from __future__ import annotations

import struct

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship

#: Fixed values of the region file: places of its fields, and the types that are outlines.
MAGIC, VERSION_AT, TYPE_AT, TOP_AT, LEFT_AT, COUNT_AT, OTHER_COUNT_AT, OPTIONS_AT, BODY_AT = b"Iout", 4, 6, 8, 10, 16, 18, 50, 64
OUTLINES, SUBPIXEL, SUBPIXEL_VERSION = (0, 7, 8), 128, 222


def parse_roi(data: bytes) -> tuple[list[float], list[float]]:
    """Closed ring of a region file; raises ValueError for what is no outline."""
    if data[:4] != MAGIC or len(data) < BODY_AT:
        raise ValueError("not a region file")
    short = lambda at: struct.unpack_from(">h", data, at)[0]
    version, kind, top, left = short(VERSION_AT), data[TYPE_AT], short(TOP_AT), short(LEFT_AT)
    if kind not in OUTLINES:
        raise ValueError(f"region type {kind} is no outline")
    n = struct.unpack_from(">H", data, COUNT_AT)[0] or struct.unpack_from(">i", data, OTHER_COUNT_AT)[0]
    if n < 3 or len(data) < BODY_AT + 4 * n:
        raise ValueError("fewer than three points" if n < 3 else "cut short")
    if short(OPTIONS_AT) & SUBPIXEL and version >= SUBPIXEL_VERSION and len(data) >= BODY_AT + 12 * n:
        x, y = (np.frombuffer(data, ">f4", n, BODY_AT + 4 * n + 4 * n * k).astype(float) for k in (0, 1))
    else:
        x, y = (np.frombuffer(data, ">i2", n, BODY_AT + 2 * n * k).astype(float) + o for k, o in ((0, left), (1, top)))
    xs, ys = x.tolist(), y.tolist()
    if (xs[0], ys[0]) != (xs[-1], ys[-1]):
        xs, ys = [*xs, xs[0]], [*ys, ys[0]]
    return xs, ys


def read_rois(spark: SparkSession, path: str) -> DataFrame:
    """roi, xs, ys, error of every region file under ``path``; a file that is no outline has no ring and says why."""
    ship(spark)

    def one(data: bytes) -> tuple:
        try:
            return (*parse_roi(data), None)
        except (ValueError, struct.error) as e:
            return None, None, str(e)

    def run(frames):
        for f in frames:
            rings = [one(bytes(c)) for c in f["content"]]
            yield pd.DataFrame({"roi": f["roi"], **{k: pd.Series([r[i] for r in rings], index=f.index, dtype=object) for i, k in enumerate(("xs", "ys", "error"))}})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.roi").load(path)
    return files.select(F.regexp_extract("path", r"([^/]+)\.roi$", 1).alias("roi"), "content").mapInPandas(run, "roi string, xs array<double>, ys array<double>, error string")


#: Numbers of image tags, and bytes of their types.
WIDTH, HEIGHT, BITS, COMPRESSION, OFFSETS, SAMPLES, ROWS, COUNTS, FORMAT = 256, 257, 258, 259, 273, 277, 278, 279, 339
TYPES = {1: "B", 3: "H", 4: "I", 16: "Q"}


def tiff_tags(data: bytes) -> dict[int, list[int]]:
    """Whole-number tags of the first page of a classic or big TIFF."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None:
        raise ValueError("not a TIFF file")
    magic = struct.unpack_from(order + "H", data, 2)[0]
    if magic not in (42, 43):
        raise ValueError("not a TIFF file")
    big = magic == 43
    at = struct.unpack_from(order + ("Q" if big else "I"), data, 8 if big else 4)[0]
    n = struct.unpack_from(order + ("Q" if big else "H"), data, at)[0]
    at, step, room = at + (8 if big else 2), 20 if big else 12, 8 if big else 4
    tags = {}
    for k in range(n):
        tag, kind = struct.unpack_from(order + "HH", data, at + k * step)
        count = struct.unpack_from(order + ("Q" if big else "I"), data, at + k * step + 4)[0]
        if kind not in TYPES:
            continue
        value = at + k * step + (12 if big else 8)
        if struct.calcsize(TYPES[kind]) * count > room:
            value = struct.unpack_from(order + ("Q" if big else "I"), data, value)[0]
        tags[tag] = list(struct.unpack_from(f"{order}{count}{TYPES[kind]}", data, value))
    return tags


def image_sizes(spark: SparkSession, path: str) -> DataFrame:
    """path, height, width, channels of TIFF files, from their headers."""
    ship(spark)

    def run(frames):
        for f in frames:
            t = [tiff_tags(bytes(c)) for c in f["content"]]
            yield pd.DataFrame({"path": f["path"], "height": [x[HEIGHT][0] for x in t], "width": [x[WIDTH][0] for x in t], "channels": [x.get(SAMPLES, [1])[0] for x in t]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, height long, width long, channels int")


def read_strips(spark: SparkSession, path: str) -> DataFrame:
    """path, y0, rows, width, channels, pixels (doubles in 0..1, row by row, three channels) of uncompressed TIFF strips.

    One grey channel becomes three, channels beyond three are left out, whole numbers are divided
    by the largest of their type; floating values stay.
    """
    ship(spark)

    def run(frames):
        for f in frames:
            for name, content in zip(f["path"], f["content"], strict=True):
                data = bytes(content)
                t = tiff_tags(data)
                if t.get(COMPRESSION, [1])[0] != 1:
                    raise ValueError(f"{name}: compressed strips are not read")
                order, width, channels, bits = "<" if data[:2] == b"II" else ">", t[WIDTH][0], t.get(SAMPLES, [1])[0], t.get(BITS, [1])[0]
                kind = f"{order}f{bits // 8}" if t.get(FORMAT, [1])[0] == 3 else f"{order}u{bits // 8}"
                step = t.get(ROWS, [t[HEIGHT][0]])[0]
                for k, (at, size) in enumerate(zip(t[OFFSETS], t[COUNTS], strict=True)):
                    px = np.frombuffer(data, kind, size // (bits // 8), at).reshape(-1, width, channels)
                    px = px.astype(float) / (np.iinfo(kind).max if kind[1] == "u" else 1.0)
                    px = np.repeat(px, 3, axis=2) if channels == 1 else px[:, :, :3]
                    yield pd.DataFrame({"path": [name], "y0": [k * step], "rows": [len(px)], "width": [width], "pixels": [px.ravel().tolist()]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, y0 long, rows long, width long, pixels array<double>")
