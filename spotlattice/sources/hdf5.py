"""Count matrices in HDF5 files: groups and datasets found from the file's own index, chunks decoded where Spark deals them.

What is read: version 0 and 1 of the file header with symbol-table groups, whole numbers, floats and
texts of fixed length, one- or more-dimensional, compact, contiguous or in chunks, with the
shuffle, Deflate and checksum filters. What is not says so: newer groups and layouts, texts of
variable length, other filters. One file is indexed by one task, so it has to fit there (Spark's binary files
end at 2 GB); decoding is spread over the chunks.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut, ship

#: The signature, numbers of header messages and of filters.
SIGNATURE = b"\x89HDF\r\n\x1a\n"
SPACE, TYPE, LAYOUT, FILTERS, CONTINUED, GROUP = 0x01, 0x03, 0x08, 0x0B, 0x10, 0x11
DEFLATE, SHUFFLE, CHECKSUM = 1, 2, 3
NOWHERE = (1 << 64) - 1


@dataclass
class Dataset:
    shape: tuple[int, ...]
    kind: str
    filters: list[int] = field(default_factory=list)
    #: (offsets of the first element, shape, filter mask, place in the file, bytes)
    chunks: list[tuple[tuple[int, ...], tuple[int, ...], int, int, int]] = field(default_factory=list)


class File:
    def __init__(self, data: bytes):
        if data[:8] != SIGNATURE:
            raise ValueError("not an HDF5 file")
        if data[8] > 1 or data[13:15] != b"\x08\x08":
            raise ValueError(f"file header of version {data[8]}")
        self.data = data
        at = 24 + (4 if data[8] == 1 else 0)
        self.base = self._q(at)
        self.root = self._q(at + 32 + 8)

    def _q(self, at: int) -> int:
        return struct.unpack_from("<Q", self.data, at)[0]

    def _tag(self, at: int, tag: bytes) -> None:
        if self.data[at : at + 4] != tag:
            raise ValueError(f"no {tag.decode()} where one should be")

    def messages(self, header: int) -> list[tuple[int, bytes]]:
        at = header + self.base
        if self.data[at] != 1:
            raise ValueError("an object header of a newer version")
        count, _, size = struct.unpack_from("<HII", self.data, at + 2)
        out, blocks = [], [(at + 16, size)]
        while blocks:
            at, size = blocks.pop(0)
            end = at + size
            while at + 8 <= end and len(out) < count:
                kind, n = struct.unpack_from("<HH", self.data, at)
                body = self.data[at + 8 : at + 8 + n]
                out.append((kind, body))
                if kind == CONTINUED:
                    place, length = struct.unpack_from("<QQ", body)
                    blocks.append((place + self.base, length))
                at += 8 + n
        return out

    def children(self, header: int) -> dict[str, int] | None:
        """Names and headers of a group's members; None for what is no group."""
        own = dict(self.messages(header))
        if GROUP not in own:
            return None
        tree, heap = struct.unpack_from("<QQ", own[GROUP])
        self._tag(heap + self.base, b"HEAP")
        names = self._q(heap + self.base + 24) + self.base
        out: dict[str, int] = {}
        for node in self._leaves(tree, 8, 0):
            at = node[1] + self.base
            self._tag(at, b"SNOD")
            for k in range(struct.unpack_from("<H", self.data, at + 6)[0]):
                name, place = struct.unpack_from("<QQ", self.data, at + 8 + 40 * k)
                out[self.data[names + name : self.data.index(b"\0", names + name)].decode()] = place
        return out

    def _leaves(self, node: int, key: int, kind: int) -> list[tuple[bytes, int]]:
        """(key, child) of the lowest level of a B-tree, in order."""
        if node == NOWHERE:
            return []
        at = node + self.base
        self._tag(at, b"TREE")
        own, level, n = struct.unpack_from("<BBH", self.data, at + 4)
        if own != kind:
            raise ValueError("a tree of another kind")
        at += 24
        pairs = [(self.data[at + k * (key + 8) : at + k * (key + 8) + key], self._q(at + k * (key + 8) + key)) for k in range(n)]
        return pairs if level == 0 else [x for _, child in pairs for x in self._leaves(child, key, kind)]

    def datasets(self, header: int | None = None, path: str = "") -> dict[str, Dataset | str]:
        """Datasets by path below a group; a text says why one is not read."""
        out: dict[str, Dataset | str] = {}
        for name, place in (self.children(self.root if header is None else header) or {}).items():
            here = f"{path}/{name}".lstrip("/")
            try:
                inner = self.children(place)
                if inner is None:
                    out[here] = self.dataset(place)
                else:
                    out |= self.datasets(place, here)
            except (ValueError, struct.error, IndexError) as e:
                out[here] = str(e)
        return out

    def dataset(self, header: int) -> Dataset:
        own = dict(self.messages(header))
        space, layout = own[SPACE], own[LAYOUT]
        shape = struct.unpack_from(f"<{space[1]}Q", space, 8 if space[0] == 1 else 4)
        out = Dataset(shape or (1,), element(own[TYPE]), filter_ids(own.get(FILTERS, b"")))
        size = np.dtype(out.kind).itemsize
        if layout[0] != 3:
            raise ValueError(f"layout of version {layout[0]}")
        if layout[1] == 0:
            inside = self.data.index(layout, header + self.base)
            out.chunks.append(((0,) * len(out.shape), out.shape, 0, inside + 4, struct.unpack_from("<H", layout, 2)[0]))
        elif layout[1] == 1:
            place, n = struct.unpack_from("<QQ", layout, 2)
            if place != NOWHERE:
                out.chunks.append(((0,) * len(out.shape), out.shape, 0, place + self.base, n))
        else:
            rank = layout[2]
            tree = struct.unpack_from("<Q", layout, 3)[0]
            chunk = struct.unpack_from(f"<{rank}I", layout, 11)[:-1]
            for key, place in self._leaves(tree, 8 + 8 * rank, 1):
                n, mask, *offsets = struct.unpack(f"<II{rank}Q", key)
                out.chunks.append((tuple(offsets[:-1]), chunk, mask, place + self.base, n))
        if any(at + n > len(self.data) for *_, at, n in out.chunks) or size == 0:
            raise ValueError("cut short")
        return out


def element(body: bytes) -> str:
    kind, flags, size = body[0] & 15, body[1], struct.unpack_from("<I", body, 4)[0]
    order = ">" if flags & 1 else "<"
    if kind == 0:
        return f"{order}{'i' if flags & 8 else 'u'}{size}"
    if kind == 1:
        return f"{order}f{size}"
    if kind == 3:
        return f"S{size}"
    raise ValueError(f"elements of class {kind}")


def filter_ids(body: bytes) -> list[int]:
    if not body:
        return []
    first, out, at = body[0] == 1, [], 8 if body[0] == 1 else 2
    for _ in range(body[1]):
        number = struct.unpack_from("<H", body, at)[0]
        named = first or number >= 256
        name = struct.unpack_from("<H", body, at + 2)[0] if named else 0
        values = struct.unpack_from("<H", body, at + (6 if named else 4))[0]
        at += (8 if named else 6) + (-(-name // 8) * 8 if first else name) + 4 * values + (4 if first and values % 2 else 0)
        if number not in (DEFLATE, SHUFFLE, CHECKSUM):
            raise ValueError(f"filter {number}")
        out.append(number)
    return out


def unfiltered(raw: bytes, filters: list[int], mask: int, size: int) -> bytes:
    for i in reversed(range(len(filters))):
        if mask >> i & 1:
            continue
        if filters[i] == CHECKSUM:
            raw = raw[:-4]
        elif filters[i] == DEFLATE:
            raw = zlib.decompress(raw)
        else:
            n = len(raw) // size
            raw = np.frombuffer(raw, np.uint8, n * size).reshape(size, n).T.tobytes() + raw[n * size :]
    return raw


def read_datasets(spark: SparkSession, path: str, names: list[str] | None = None, glob: str = "*.h5") -> DataFrame:
    """path, name, pos, value, said, error: every element of the one-dimensional datasets named (or all) of the files under ``path``.

    pos counts from 0; value is a double for numbers, said a text. A file or dataset that is not read is a row with the
    error (name null for a file); elements that no chunk holds are 0 in the file and have no row here.
    """
    ship(spark)
    parts = pa.schema([("path", pa.string()), ("name", pa.string()), ("first", pa.int64()), ("n", pa.int64()), ("kind", pa.string()), ("filters", pa.list_(pa.int32())),
                       ("mask", pa.int32()), ("data", pa.binary()), ("error", pa.string())])

    def rows_of(name: str, data: bytes):
        try:
            found = File(data).datasets()
        except (ValueError, struct.error, IndexError, KeyError) as e:
            yield (name, None, None, None, None, None, None, None, str(e))
            return
        for key in names or sorted(found):
            own = found.get(key, "not in the file")
            if isinstance(own, Dataset) and len(own.shape) != 1:
                own = f"{len(own.shape)} dimensions"
            if isinstance(own, str):
                yield (name, key, None, None, None, None, None, None, own)
                continue
            for at, shape, mask, place, size in own.chunks:
                yield (name, key, at[0], min(shape[0], own.shape[0] - at[0]), own.kind, own.filters, mask, data[place : place + size], None)

    def index(batches, most: int = 16_000_000):
        held: list[tuple] = []
        size = 0
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                for row in rows_of(name, content.as_buffer().to_pybytes()):
                    held.append(row)
                    size += len(row[7] or b"")
                    if size >= most:
                        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], f.type) for i, f in enumerate(parts)], schema=parts)
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], f.type) for i, f in enumerate(parts)], schema=parts)

    def decode(batches):
        for b in batches:
            for name, key, first, n, kind, filters, mask, data, error in zip(*[c.to_pylist() for c in b.columns], strict=True):
                pos = value = said = None
                if error is None:
                    try:
                        got = np.frombuffer(unfiltered(data, filters, mask, np.dtype(kind).itemsize), kind)[:n]
                        pos = first + np.arange(len(got), dtype=np.int64)
                        if got.dtype.kind == "S":
                            said = [x.decode("utf-8", "replace") for x in got.tolist()]
                        else:
                            value = got.astype(np.float64)
                    except (ValueError, zlib.error) as e:
                        error = str(e)
                rows = 1 if pos is None else len(pos)
                cols = [[name] * rows, [key] * rows, [None] if pos is None else pos, [None] * rows if value is None else value, said or [None] * rows, [error] * rows]
                types = (pa.string(), pa.string(), pa.int64(), pa.float64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["path", "name", "pos", "value", "said", "error"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")
    schema = "path string, name string, first long, n long, kind string, filters array<int>, mask int, data binary, error string"
    dealt = files.mapInArrow(index, schema).repartition("path", "name", "first")
    return dealt.mapInArrow(decode, "path string, name string, pos long, value double, said string, error string")


def read_h5_matrix(spark: SparkSession, path: str, group: str = "matrix") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(barcode, gene_ix, n), (gene_ix, gene_id, gene_name), (barcode) of one file with a matrix in compressed columns, as ``read_mtx`` gives them.

    A file that is not read, or lacks a dataset, raises ValueError with the reason.
    """
    names = [f"{group}/{k}" for k in ("data", "indices", "indptr", "barcodes", "features/id", "features/name")]
    every = cut(read_datasets(spark, path, names, "*"))
    wrong = every.filter("error is not null").select("name", "error").limit(5).collect()
    if wrong:
        raise ValueError("; ".join(f"{r['name'] or path}: {r['error']}" for r in wrong))
    part = {k.rsplit("/", 1)[-1]: every.filter(F.col("name") == k).select("pos", "value", "said") for k in names}
    ids, called = (part[k].select(F.col("pos").alias("gene_ix"), F.trim("said").alias(c)) for k, c in (("id", "gene_id"), ("name", "gene_name")))
    genes = ids.join(called, "gene_ix")
    barcodes = part["barcodes"].select(F.col("pos").alias("bc_ix"), F.trim("said").alias("barcode"))
    # where a column begins, and where the next one does
    begin = part["indptr"].select(F.col("pos").alias("bc_ix"), F.col("value").cast("long").alias("a"))
    nxt = begin.select((F.col("bc_ix") - 1).alias("bc_ix"), F.col("a").alias("b"))
    owner = begin.join(nxt, "bc_ix").filter("b > a").select("bc_ix", F.explode(F.sequence("a", F.col("b") - 1)).alias("pos"))
    values = part["data"].select("pos", F.col("value").alias("n")).join(part["indices"].select("pos", F.col("value").cast("long").alias("gene_ix")), "pos")
    coo = values.join(owner, "pos").join(barcodes, "bc_ix").select("barcode", "gene_ix", "n")
    return coo, genes, barcodes.select("barcode")
