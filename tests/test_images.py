"""TIFF blocks and label files, against files made by hand."""

import struct
import zlib

import numpy as np
import pytest

from spotlattice.sources import images


def pack_bits(raw):
    out, i = bytearray(), 0
    while i < len(raw):
        n = 1
        while i + n < len(raw) and n < 128 and raw[i + n] == raw[i]:
            n += 1
        if n > 1:
            out += bytes([257 - n, raw[i]])
        else:
            while i + n < len(raw) and n < 128 and raw[i + n] != raw[i + n - 1]:
                n += 1
            out += bytes([n - 1]) + raw[i : i + n]
        i += n
    return bytes(out)


def pack_lzw(raw):
    bits, count = 0, 0
    table, width = {bytes([i]): i for i in range(256)}, 9
    codes = [(256, 9)]
    size, w = 258, b""
    for c in raw:
        c = bytes([c])
        if w + c in table:
            w += c
            continue
        codes.append((table[w], width))
        table[w + c] = size
        size += 1
        width = 9 if size < 512 else 10 if size < 1024 else 11 if size < 2048 else 12
        if size == 4094:
            codes.append((256, 12))
            table, width, size = {bytes([i]): i for i in range(256)}, 9, 258
        w = c
    if w:
        codes.append((table[w], width))
    size += 1
    codes.append((257, 9 if size < 512 else 10 if size < 1024 else 11 if size < 2048 else 12))
    for code, n in codes:
        bits, count = (bits << n) | code, count + n
    pad = -count % 8
    return (bits << pad).to_bytes((count + pad) // 8, "big")


PACK = {1: bytes, 5: pack_lzw, 8: zlib.compress, 32946: zlib.compress, 32773: pack_bits}


def tiff(px, order="<", how=1, tile=None, rows=3, predictor=1, big=False):
    """A file of an array of height x width x channels, in strips of ``rows`` or tiles of ``tile``."""
    h, w, c = px.shape
    kind = px.dtype.newbyteorder(order)
    bh, bw = tile or (rows, w)
    blocks = []
    for y in range(0, h, bh):
        for x in range(0, w, bw):
            b = px[y : y + bh, x : x + bw]
            if tile:
                b = np.pad(b, ((0, bh - b.shape[0]), (0, bw - b.shape[1]), (0, 0)))
            if predictor == 2:
                b = np.diff(b, axis=1, prepend=np.zeros_like(b[:, :1]))
            blocks.append(PACK[how](b.astype(kind).tobytes()))
    out = bytearray((b"II" if order == "<" else b"MM") + struct.pack(order + ("HHHQ" if big else "HI"), *((43, 8, 0, 0) if big else (42, 0))))
    offsets = []
    for b in blocks:
        offsets.append(len(out))
        out += b + b"\0" * (len(b) % 2)
    form = {"u": 1, "i": 2, "f": 3}[px.dtype.kind]
    tags = {256: (4, [w]), 257: (4, [h]), 258: (3, [px.dtype.itemsize * 8] * c), 259: (3, [how]), 277: (3, [c]), 317: (3, [predictor]), 339: (3, [form] * c)}
    sizes = [len(b) for b in blocks]
    tags |= {322: (3, [bw]), 323: (3, [bh]), 324: (4, offsets), 325: (4, sizes)} if tile else {273: (4, offsets), 278: (4, [rows]), 279: (4, sizes)}
    entries = b""
    for tag, (t, v) in sorted(tags.items()):
        body = struct.pack(f"{order}{len(v)}{'H' if t == 3 else 'I'}", *v)
        room = 8 if big else 4
        if len(body) > room:
            at = len(out)
            out += body + b"\0" * (len(body) % 2)
            body = struct.pack(order + ("Q" if big else "I"), at)
        entries += struct.pack(order + "HH", tag, t) + struct.pack(order + ("Q" if big else "I"), len(v)) + body.ljust(room, b"\0")
    struct.pack_into(order + ("Q" if big else "I"), out, 8 if big else 4, len(out))
    return bytes(out + struct.pack(order + ("Q" if big else "H"), len(tags)) + entries + b"\0" * (8 if big else 4))


def picture(kind, h=21, w=37, c=3):
    r = np.random.default_rng(1)
    px = r.integers(0, 200, (h, w, c)).astype(kind) if np.dtype(kind).kind in "ui" else r.random((h, w, c)).astype(kind)
    px[: h // 2, : w // 2] = px[0, 0]  # runs
    return px


def assembled(rows):
    h, w = max(r.y0 + r.rows for r in rows), max(r.x0 + r.cols for r in rows)
    out = np.full((h, w, rows[0].channels), np.nan)
    for r in rows:
        out[r.y0 : r.y0 + r.rows, r.x0 : r.x0 + r.cols] = np.array(r["values"]).reshape(r.rows, r.cols, r.channels)
    return out


def test_every_coding_is_read_back(spark, tmp_path):
    want = {}
    for i, (how, tile, order, kind, predictor, big) in enumerate(
        [(how, tile, order, kind, 1, False) for how in PACK for tile, order, kind in ((None, "<", "u1"), ((16, 16), ">", "u2"))]
        + [(8, (16, 32), "<", "f4", 1, True), (5, None, "<", "u1", 2, False), (8, (16, 16), ">", "u2", 2, False), (1, None, ">", "i4", 1, True)]
    ):
        name = f"{i}.tif"
        want[name] = picture(kind)
        (tmp_path / name).write_bytes(tiff(want[name], order, how, tile, predictor=predictor, big=big))
    got = images.read_blocks(spark, str(tmp_path)).collect()
    assert all(r.error is None for r in got)
    for name, px in want.items():
        own = [r for r in got if r.path.endswith("/" + name)]
        assert np.array_equal(assembled(own), px.astype(float)), name


def test_bad_files_are_rows(spark, tmp_path):
    good = tiff(picture("u1"), how=8)
    deflated = bytearray(good)
    deflated[8:30] = b"\xff" * 22  # the first strip
    for name, data in {"a.tif": good, "b.tif": b"no image", "c.tif": b"I", "d.tif": good[:60], "e.tif": bytes(deflated), "f.tif": tiff(picture("u1")).replace(struct.pack("<HHIHH", 259, 3, 1, 1, 0), struct.pack("<HHIHH", 259, 3, 1, 7, 0))}.items():
        (tmp_path / name).write_bytes(data)
    got = {}
    for r in images.read_blocks(spark, str(tmp_path)).collect():
        got.setdefault(r.path[-5], []).append(r.error)
    assert got["a"] == [None] * 7 and got["f"] == ["compression 7"] and got["e"].count(None) == 6
    assert all(len(got[k]) == 1 and got[k][0] for k in "bcd")


@pytest.mark.parametrize(("kind", "channels"), [("u1", 1), ("u1", 4), ("f4", 3), ("u2", 3)])
def test_rgb(spark, tmp_path, kind, channels):
    px = picture(kind, 6, 5, channels)
    (tmp_path / "x.tif").write_bytes(tiff(px))
    want = np.repeat(px, 3, axis=2) if channels == 1 else px[:, :, :3]
    want = want.astype(float) / (255.0 if px.max() > 1 else 1.0)
    got = images.read_rgb(spark, str(tmp_path)).collect()
    assert len(got) == 30
    for r in got:
        assert np.allclose([r.r, r.g, r.b], want[r.y, r.x])


def test_lzw_of_much(spark):
    raw = bytes(np.random.default_rng(2).integers(0, 40, 60_000).astype(np.uint8))
    assert images.unpack_lzw(pack_lzw(raw)) == raw and images.unpack_bits(pack_bits(raw)) == raw


def test_label_files_round_trip(spark, tmp_path):
    r = np.random.default_rng(3)
    points = {(int(y), int(x)): int(v) for y, x, v in zip(r.integers(0, 100, 900), r.integers(0, 70, 900), r.integers(1, 2**32 - 1, 900), strict=True)}
    rows = [(y, x, v) for (y, x), v in points.items()] + [(-1, 0, 5), (100, 0, 5), (0, 70, 5)]
    df = spark.createDataFrame([*rows, rows[0]], "y long, x long, label long")
    manifest = images.write_label_tiles(df, str(tmp_path / "out"), 100, 70, side=32)
    assert sum(m.pixels for m in manifest.collect()) == len(points)
    assert {(p.y, p.x): p.label for p in images.read_label_tiles(spark, str(tmp_path / "out"), manifest).collect()} == points
    assert not [p for p in (tmp_path / "out").iterdir() if p.name.startswith("_")]
    assert images.write_label_tiles(df.filter("false"), str(tmp_path / "none"), 10, 10).collect() == []
