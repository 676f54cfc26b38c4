"""Image files as blocks of pixels: strips and tiles of TIFF files in, tiled label files out.

Spark reads the files; a first pass cuts them at their strips or tiles without decoding anything,
the blocks are dealt out, and each is decoded where it falls. A file that cannot be read is a row
that says why. One file is read by one task in the first pass, so it has to fit there (Spark's
binary files end at 2 GB).
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship
from .binary import BITS, COMPRESSION, COUNTS, FORMAT, HEIGHT, OFFSETS, ROWS, SAMPLES, WIDTH, tiff_tags

#: More tags, and the numbers of compressions.
PLANAR, PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS, PHOTOMETRIC = 284, 317, 322, 323, 324, 325, 262
PLAIN, LZW, DEFLATE, OLD_DEFLATE, PACKBITS = 1, 5, 8, 32946, 32773
BLOCKS = pa.schema(
    [("path", pa.string()), ("y0", pa.int64()), ("x0", pa.int64()), ("rows", pa.int32()), ("cols", pa.int32()), ("channels", pa.int32())]
    + [("stored", pa.int32()), ("kind", pa.string()), ("compression", pa.int32()), ("predictor", pa.int32()), ("data", pa.binary()), ("error", pa.string())]
)


def unpack_bits(data: bytes) -> bytes:
    """PackBits: a count below 128 is followed by one byte more of literals, above by a byte to repeat 257 - count times."""
    out, at = bytearray(), 0
    while at < len(data):
        n = data[at]
        if n < 128:
            out += data[at + 1 : at + 2 + n]
            at += 2 + n
        else:
            if n > 128 and at + 1 < len(data):
                out += data[at + 1 : at + 2] * (257 - n)
            at += 1 if n == 128 else 2
    return bytes(out)


def unpack_lzw(data: bytes) -> bytes:
    """LZW as in TIFF: codes of 9 to 12 bits, high bit first, widened one code early; 256 clears, 257 ends."""
    table: list[bytes] = []
    out: list[bytes] = []
    width, held, bits, last = 9, 0, 0, b""
    for byte in data:
        held, bits = ((held << 8) | byte) & 0xFFFFFF, bits + 8
        if bits < width:
            continue
        bits -= width
        code = (held >> bits) & ((1 << width) - 1)
        if code == 257:
            break
        if code == 256:
            table, width, last = [bytes([i]) for i in range(256)] + [b"", b""], 9, b""
            continue
        if not table:
            raise ValueError("LZW data without a first clear code")
        if code < len(table):
            own = table[code]
        elif code == len(table) and last:
            own = last + last[:1]
        else:
            raise ValueError("LZW code out of range")
        out.append(own)
        if last:
            table.append(last + own[:1])
        last = own
        width = 9 if len(table) < 511 else 10 if len(table) < 1023 else 11 if len(table) < 2047 else 12
    return b"".join(out)


def tiff_blocks(path: str, data: bytes) -> list[tuple]:
    """Rows of BLOCKS for the strips or tiles of the first page; raises ValueError for what is not read."""
    t = tiff_tags(data)
    if WIDTH not in t or HEIGHT not in t:
        raise ValueError("no size")
    order, width, height, channels = "<" if data[:2] == b"II" else ">", t[WIDTH][0], t[HEIGHT][0], t.get(SAMPLES, [1])[0]
    bits, how = set(t.get(BITS, [1])), t.get(COMPRESSION, [PLAIN])[0]
    if len(bits) != 1 or (size := min(bits)) not in (8, 16, 32, 64):
        raise ValueError(f"samples of {sorted(bits)} bits")
    if channels > 1 and t.get(PLANAR, [1])[0] != 1:
        raise ValueError("channels in planes of their own")
    if how not in (PLAIN, LZW, DEFLATE, OLD_DEFLATE, PACKBITS):
        raise ValueError(f"compression {how}")
    kind = f"{order}{ {1: 'u', 2: 'i', 3: 'f'}.get(t.get(FORMAT, [1])[0], '?')}{size // 8}"
    if "?" in kind or kind[1:] == "f1":
        raise ValueError(f"sample format {t[FORMAT][0]}")
    tiled = TILE_OFFSETS in t
    if not tiled and OFFSETS not in t:
        raise ValueError("no strips or tiles")
    bw, bh = (t[TILE_WIDTH][0], t[TILE_HEIGHT][0]) if tiled else (width, min(t.get(ROWS, [height])[0], height))
    offsets, counts = (t[TILE_OFFSETS], t[TILE_COUNTS]) if tiled else (t[OFFSETS], t[COUNTS])
    across = -(-width // bw)
    rows = []
    for k, (at, n) in enumerate(zip(offsets, counts, strict=True)):
        y0, x0 = k // across * bh, k % across * bw
        if at + n > len(data):
            raise ValueError("cut short")
        rows.append((path, y0, x0, min(bh, height - y0), min(bw, width - x0), channels, bw, kind, how, t.get(PREDICTOR, [1])[0], data[at : at + n], None))
    return rows


def decode(data: bytes, rows: int, cols: int, channels: int, stored: int, kind: str, how: int, predictor: int) -> np.ndarray:
    """rows x cols x channels of a block whose rows are ``stored`` wide."""
    raw = {PLAIN: bytes, LZW: unpack_lzw, PACKBITS: unpack_bits}.get(how, zlib.decompress)(data)
    dtype = np.dtype(kind)
    if len(raw) < rows * stored * channels * dtype.itemsize:
        raise ValueError("a block is cut short")
    px = np.frombuffer(raw, dtype, rows * stored * channels).reshape(rows, stored, channels)
    if predictor == 2 and dtype.kind in "ui":
        px = np.cumsum(px, axis=1, dtype=dtype.newbyteorder("="))
    elif predictor != 1:
        raise ValueError(f"predictor {predictor}")
    return px[:, :cols]


def read_blocks(spark: SparkSession, path: str, glob: str = "*.tif*") -> DataFrame:
    """path, y0, x0, rows, cols, channels, top (largest value), values (row by row, channels together), error of the files under ``path``.

    Plain, PackBits, LZW and Deflate strips or tiles of whole or floating samples in either byte order. Of a file or
    block that is not read there is one row with the error and null values; files of no length are not seen by Spark.
    """
    ship(spark)

    def cut_up(batches, most: int = 16_000_000):
        held: list[tuple] = []
        size = 0

        def batch():
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], f.type) for i, f in enumerate(BLOCKS)], schema=BLOCKS)

        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                try:
                    found = tiff_blocks(name, content.as_buffer().to_pybytes())
                except (ValueError, KeyError, struct.error, IndexError) as e:
                    found = [(name, *[None] * 10, str(e))]
                for row in found:
                    held.append(row)
                    size += len(row[10] or b"")
                    if size >= most:
                        yield batch()
                        held, size = [], 0
        if held:
            yield batch()

    schema = (
        "path string, y0 long, x0 long, rows int, cols int, channels int, stored int, kind string, compression int, predictor int, data binary, error string"
    )
    out = pa.schema([*[BLOCKS.field(i) for i in range(6)], ("top", pa.float64()), ("values", pa.list_(pa.float64())), ("error", pa.string())])

    def run(batches):
        for b in batches:
            for row in zip(*[c.to_pylist() for c in b.columns], strict=True):
                name, y0, x0, rows, cols, channels, stored, kind, how, predictor, data, error = row
                top = values = None
                if error is None:
                    try:
                        px = decode(data, rows, cols, channels, stored, kind, how, predictor).astype(np.float64)
                        top, values = float(px.max(initial=0)), px.ravel()
                    except (ValueError, zlib.error) as e:
                        error = str(e)
                yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((name, y0, x0, rows, cols, channels, top, values, error), out, strict=True)], schema=out)

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")
    blocks = files.mapInArrow(cut_up, schema).repartition("path", "y0", "x0")
    return blocks.mapInArrow(run, "path string, y0 long, x0 long, rows int, cols int, channels int, top double, values array<double>, error string")


def read_rgb(spark: SparkSession, path: str, glob: str = "*.tif*") -> DataFrame:
    """path, y, x, r, g, b of every pixel: grey values three times, channels beyond three left out, all divided by 255 where any value of the image is above 1.

    A file with two channels has b null. Files with an error give no pixel; ``read_blocks`` names them.
    """
    blocks = read_blocks(spark, path, glob).filter("error is null")
    top = blocks.groupBy("path").agg(F.max("top").alias("_top"))
    pixel = F.posexplode(F.sequence(F.lit(0), F.col("rows") * F.col("cols") - 1)).alias("_i", "_p")
    each = blocks.select("path", "y0", "x0", "cols", "channels", "values", pixel)

    def channel(k: int):
        return F.get("values", F.col("_p") * F.col("channels") + F.when(F.col("channels") == 1, 0).otherwise(k))

    own = [F.when((F.col("channels") == 1) | (F.col("channels") > k), channel(k)).alias(c) for k, c in enumerate("rgb")]
    flat = each.select("path", (F.col("y0") + F.floor(F.col("_p") / F.col("cols"))).alias("y"), (F.col("x0") + F.col("_p") % F.col("cols")).alias("x"), *own)
    scale = F.when(F.col("_top") > 1, F.lit(255.0)).otherwise(F.lit(1.0))
    return flat.join(F.broadcast(top), "path").select("path", "y", "x", *[(F.col(c) / scale).alias(c) for c in "rgb"])  # one row a file


def label_tile(y: np.ndarray, x: np.ndarray, label: np.ndarray, rows: int, cols: int) -> bytes:
    """A little-endian TIFF of 32-bit labels in one Deflate tile (a side is a multiple of 16); 0 where no pixel is given."""
    px = np.zeros((-(-rows // 16) * 16, -(-cols // 16) * 16), dtype="<u4")
    px[y, x] = label
    body = zlib.compress(px.tobytes(), 6)
    tags = [(WIDTH, 4, cols), (HEIGHT, 4, rows), (BITS, 3, 32), (COMPRESSION, 3, DEFLATE), (PHOTOMETRIC, 3, 1), (SAMPLES, 3, 1),
            (TILE_WIDTH, 4, px.shape[1]), (TILE_HEIGHT, 4, px.shape[0]), (TILE_OFFSETS, 4, 8), (TILE_COUNTS, 4, len(body)), (FORMAT, 3, 1)]
    body += b"\0" * (len(body) % 2)
    entries = b"".join(struct.pack("<HHI", tag, kind, 1) + struct.pack("<I" if kind == 4 else "<HH", *((v,) if kind == 4 else (v, 0))) for tag, kind, v in sorted(tags))
    return b"II" + struct.pack("<HI", 42, 8 + len(body)) + body + struct.pack("<H", len(tags)) + entries + struct.pack("<I", 0)


def put_file(folder: str, name: str, data: bytes, attempt: int) -> None:
    """Writes beside the place and moves it there, so that a task that runs again leaves the same file."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder) if ":" in folder else (fs.LocalFileSystem(), folder)
    store.create_dir(path, recursive=True)
    with store.open_output_stream(f"{path}/_{name}.{attempt}") as out:
        out.write(data)
    store.move(f"{path}/_{name}.{attempt}", f"{path}/{name}")


def write_label_tiles(labels: DataFrame, folder: str, height: int, width: int, side: int = 1024) -> DataFrame:
    """Writes ``labels`` (y, x, label, one row a pixel that has one) as files ``labels-<y0>-<x0>.tif`` of ``side`` squared and returns their manifest: file, y0, x0, rows, cols, pixels.

    ``side`` is a multiple of 16. Tiles without a labelled pixel have no file; pixels outside the image are left out; of several labels of a
    pixel the largest stays. ``folder`` is one that all executors reach, and files count if the manifest names them.
    """
    if side % 16:
        raise ValueError("the side of a tile is a multiple of 16")
    spark = ship(labels.sparkSession)
    inside = labels.filter((F.col("y") >= 0) & (F.col("y") < height) & (F.col("x") >= 0) & (F.col("x") < width))
    one = inside.groupBy("y", "x").agg(F.max("label").alias("label"))
    tiled = one.select(*[(F.floor(F.col(c) / side) * side).cast("long").alias(f"{c}0") for c in "yx"], F.col("y").cast("long"), F.col("x").cast("long"), F.col("label").cast("long"))

    def write(key, f):
        y0, x0 = int(key[0]), int(key[1])
        rows, cols = min(side, height - y0), min(side, width - x0)
        name = f"labels-{y0:08d}-{x0:08d}.tif"
        data = label_tile(f["y"].to_numpy() - y0, f["x"].to_numpy() - x0, f["label"].to_numpy(), rows, cols)
        put_file(folder, name, data, TaskContext.get().taskAttemptId())
        import pandas as pd

        return pd.DataFrame({"file": [name], "y0": [y0], "x0": [x0], "rows": [rows], "cols": [cols], "pixels": [len(f)]})

    # a group is one tile: side squared pixels at most
    manifest = tiled.groupBy("y0", "x0").applyInPandas(write, "file string, y0 long, x0 long, rows int, cols int, pixels long").collect()
    return spark.createDataFrame([tuple(r) for r in manifest], "file string, y0 long, x0 long, rows int, cols int, pixels long")


def read_label_tiles(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """y, x, label (above 0) of what ``write_label_tiles`` wrote."""
    blocks = read_blocks(spark, folder, "labels-*.tif").withColumn("file", F.regexp_extract("path", r"([^/]+)$", 1)).withColumnRenamed("y0", "dy").withColumnRenamed("x0", "dx")
    named = blocks.select("file", "dy", "dx", "cols", "values").join(manifest.select("file", "y0", "x0"), "file")
    each = named.select("dy", "dx", "y0", "x0", "cols", F.posexplode("values").alias("p", "v")).filter("v > 0")
    return each.select(
        (F.col("y0") + F.col("dy") + F.floor(F.col("p") / F.col("cols"))).alias("y"),
        (F.col("x0") + F.col("dx") + F.col("p") % F.col("cols")).alias("x"),
        F.col("v").cast("long").alias("label"),
    )
