"""HDF5 files made by hand: groups, chunks and filters, and a matrix as the folder form gives it."""

import gzip
import struct
import zlib

import numpy as np
import pytest

from spotlattice.sources import hdf5, tables


class Writer:
    """The smallest file of symbol-table groups and one-dimensional datasets."""

    def __init__(self):
        self.out = bytearray(hdf5.SIGNATURE + bytes([0, 0, 0, 0, 0, 8, 8, 0]) + struct.pack("<HHI", 4, 16, 0) + struct.pack("<QQQQ", 0, hdf5.NOWHERE, 0, hdf5.NOWHERE) + b"\0" * 40)

    def put(self, data: bytes) -> int:
        self.out += b"\0" * (-len(self.out) % 8)
        at = len(self.out)
        self.out += data
        return at

    def header(self, messages, split=False) -> int:
        packed = [struct.pack("<HHB3x", kind, len(body), 0) + body for kind, body in ((k, b + b"\0" * (-len(b) % 8)) for k, b in messages)]
        if split:  # all but the first message in a block of their own
            rest = b"".join(packed[1:])
            place = self.put(rest)
            packed = [packed[0], struct.pack("<HHB3x", hdf5.CONTINUED, 16, 0) + struct.pack("<QQ", place, len(rest))]
            count = len(messages) + 1
        else:
            count = len(messages)
        return self.put(struct.pack("<BBHII4x", 1, 0, count, 1, sum(map(len, packed))) + b"".join(packed))

    def group(self, members: dict[str, int]) -> int:
        names, at = bytearray(8), {}
        for n in sorted(members):
            at[n] = len(names)
            names += n.encode() + b"\0"
            names += b"\0" * (-len(names) % 8)
        place = self.put(bytes(names))
        heap = self.put(b"HEAP" + struct.pack("<B3xQQQ", 0, len(names), 1, place))
        leaves = []
        for k in range(0, len(members), 3):  # several nodes
            own = sorted(members)[k : k + 3]
            leaves.append(self.put(b"SNOD" + struct.pack("<BBH", 1, 0, len(own)) + b"".join(struct.pack("<QQI4x16x", at[n], members[n], 0) for n in own)))
        body = b"".join(struct.pack("<QQ", 0, x) for x in leaves) + struct.pack("<Q", 0)
        tree = self.put(b"TREE" + struct.pack("<BBHQQ", 0, 0, len(leaves), hdf5.NOWHERE, hdf5.NOWHERE) + body)
        return self.header([(hdf5.GROUP, struct.pack("<QQ", tree, heap))])

    def dataset(self, x: np.ndarray, chunk: int | None = None, filters=(), split=False, compact=False) -> int:
        size = x.dtype.itemsize
        if x.dtype.kind == "S":
            kind = struct.pack("<BBBBI", 0x13, 0, 0, 0, size)
        elif x.dtype.kind == "f":
            kind = struct.pack("<BBBBI", 0x11, 0x20, 63, 0, size) + b"\0" * 12
        else:
            kind = struct.pack("<BBBBI", 0x10, (8 if x.dtype.kind == "i" else 0) | (x.dtype.byteorder == ">"), 0, 0, size) + struct.pack("<HH", 0, 8 * size)
        messages = [(hdf5.SPACE, struct.pack("<BBBB4xQ", 1, 1, 0, 0, len(x))), (hdf5.TYPE, kind)]
        if compact:
            messages.append((hdf5.LAYOUT, struct.pack("<BBH", 3, 0, x.nbytes) + x.tobytes()))
        elif chunk is None:
            place = self.put(x.tobytes())
            messages.append((hdf5.LAYOUT, struct.pack("<BBQQ", 3, 1, place, x.nbytes)))
        else:
            keys = []
            for a in range(0, len(x), chunk):
                raw = x[a : a + chunk].tobytes().ljust(chunk * size, b"\0")
                for f in filters:
                    if f == hdf5.SHUFFLE:
                        raw = np.frombuffer(raw, np.uint8).reshape(-1, size).T.tobytes()
                    elif f == hdf5.DEFLATE:
                        raw = zlib.compress(raw)
                    else:
                        raw += b"sums"
                keys.append((struct.pack("<IIQQ", len(raw), 0, a, 0), self.put(raw)))
            low = []
            for k in range(0, len(keys), 4):  # two levels
                part = keys[k : k + 4]
                body = b"".join(key + struct.pack("<Q", at) for key, at in part) + part[-1][0]
                low.append((part[0][0], self.put(b"TREE" + struct.pack("<BBHQQ", 1, 0, len(part), hdf5.NOWHERE, hdf5.NOWHERE) + body)))
            body = b"".join(key + struct.pack("<Q", at) for key, at in low) + (low[-1][0] if low else b"")
            tree = self.put(b"TREE" + struct.pack("<BBHQQ", 1, 1, len(low), hdf5.NOWHERE, hdf5.NOWHERE) + body)
            messages.append((hdf5.LAYOUT, struct.pack("<BBBQII", 3, 2, 2, tree, chunk, size)))
            if filters:
                each = b"".join(struct.pack("<HHHH", f, 8, 1, 1) + b"filter\0\0" + struct.pack("<I4x", size) for f in filters)
                messages.append((hdf5.FILTERS, struct.pack("<BB6x", 1, len(filters)) + each))
        return self.header(messages, split)

    def close(self, root: int) -> bytes:
        struct.pack_into("<Q", self.out, 24 + 32 + 8, root)
        struct.pack_into("<Q", self.out, 24 + 16, len(self.out))
        return bytes(self.out)


def texts(*x):
    return np.array([s.encode() for s in x])


def matrix_file(m, barcodes, ids, names, **leave):
    """``m``: genes x barcodes, in compressed columns."""
    data, indices, indptr = [], [], [0]
    for j in range(m.shape[1]):
        own = np.flatnonzero(m[:, j])
        data += m[own, j].tolist()
        indices += own.tolist()
        indptr.append(len(data))
    w = Writer()
    f = w.group({"id": w.dataset(texts(*ids)), "name": w.dataset(texts(*names), 4, (hdf5.DEFLATE,))})
    parts = {
        "data": w.dataset(np.array(data, "<i4"), 5, (hdf5.SHUFFLE, hdf5.DEFLATE), split=True),
        "indices": w.dataset(np.array(indices, "<i8"), 3, (hdf5.SHUFFLE, hdf5.DEFLATE, hdf5.CHECKSUM)),
        "indptr": w.dataset(np.array(indptr, "<i8")),
        "shape": w.dataset(np.array(m.shape, "<i4"), compact=True),
        "barcodes": w.dataset(texts(*barcodes), 7),
        "features": f,
    }
    return w.close(w.group({"matrix": w.group({k: v for k, v in parts.items() if k not in leave})}))


def example():
    r = np.random.default_rng(2)
    m = r.poisson(0.4, (9, 12))
    m[:, 3] = 0
    return m, [f"BC-{i}-1" for i in range(12)], [f"ENS{i}" for i in range(9)], [f"Gene{i % 5}" for i in range(9)]


def test_datasets_of_every_layout(spark, tmp_path):
    w = Writer()
    r = np.random.default_rng(1)
    own = {
        "a": (r.integers(-99, 99, 37).astype("<i2"), dict(chunk=4, filters=(hdf5.SHUFFLE, hdf5.DEFLATE))),
        "b": (r.random(11).astype("<f4"), dict(split=True)),
        "c": (np.arange(5, dtype=">u4"), dict(compact=True)),
        "d": (texts("x", "long text", ""), dict(chunk=2)),
        "e": (np.zeros(0, "<i4"), dict(chunk=4)),
    }
    inner = w.group({k: w.dataset(x, **how) for k, (x, how) in own.items()})
    (tmp_path / "one.h5").write_bytes(w.close(w.group({"deep": w.group({"er": inner})})))
    (tmp_path / "bad.h5").write_bytes(b"no such thing")
    (tmp_path / "cut.h5").write_bytes((tmp_path / "one.h5").read_bytes()[:200])
    rows = hdf5.read_datasets(spark, str(tmp_path)).collect()
    wrong = {r.path[-6:]: r.error for r in rows if r.error}
    assert set(wrong) == {"bad.h5", "cut.h5"} and wrong["bad.h5"] == "not an HDF5 file"
    for k, (x, _) in own.items():
        got = sorted((r.pos, r.said if x.dtype.kind == "S" else r.value) for r in rows if r.name == f"deep/er/{k}")
        assert got == list(enumerate([s.decode() for s in x.tolist()] if x.dtype.kind == "S" else x.astype(float).tolist())), k


def test_matrix_equals_the_folder_form(spark, tmp_path):
    m, barcodes, ids, names = example()
    (tmp_path / "m.h5").write_bytes(matrix_file(m, barcodes, ids, names))
    folder = tmp_path / "mtx"
    folder.mkdir()
    at = np.argwhere(m)
    lines = ["%%MatrixMarket matrix coordinate integer general", f"{m.shape[0]} {m.shape[1]} {len(at)}", *(f"{i + 1} {j + 1} {m[i, j]}" for i, j in at)]
    for name, rows in (("matrix.mtx", lines), ("features.tsv", [f"{i}\t{n}" for i, n in zip(ids, names, strict=True)]), ("barcodes.tsv", barcodes)):
        with gzip.open(folder / f"{name}.gz", "wt") as f:
            f.write("\n".join(rows) + "\n")
    for a, b in zip(hdf5.read_h5_matrix(spark, str(tmp_path / "m.h5")), tables.read_mtx(spark, str(folder)), strict=True):
        assert sorted(map(tuple, a.select(*b.columns).collect())) == sorted(map(tuple, b.collect()))


def test_a_matrix_that_lacks_a_dataset_raises(spark, tmp_path):
    (tmp_path / "m.h5").write_bytes(matrix_file(*example(), indptr=None))
    with pytest.raises(ValueError, match="matrix/indptr: not in the file"):
        hdf5.read_h5_matrix(spark, str(tmp_path / "m.h5"))
