"""MinHash near-dedup by improved consistent weighted sampling.

A document is a weighted set: shingles of five words, each weighted by how often it occurs times
its inverse document frequency, which is counted over all documents. Consistent weighted samples
of the sets (Ioffe, 2010) are banded; documents that share a band are candidates. Candidates are
gathered into coarse components without a pair being listed. Weighted Jaccard similarity then
verifies them: a component of one block has all its pairs compared; in a larger one every text is
compared with a pivot first, and only texts that the pivot does not hold are compared with all
others, in pairs of blocks. Texts the pivot holds are one class already, so no class is lost. Only
the links of a spanning forest leave a block.

Texts that differ only in white space or the case of A-Z are one text here, kept once by the
digest of its words.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship
from .bytewords import Words, mix, runs_of, slices
from .components import components
from .storage import cut

ODD = np.uint64(0x9E3779B97F4A7C15)
#: Shingles of a text that are worked out at a time.
STRETCH = 1 << 20


@dataclass(frozen=True)
class Settings:
    words: int = 5
    similarity: float = 0.8
    bands: int = 18
    rows: int = 5
    #: Shingles in fewer than this share of all documents weigh as the rarest do; it bounds the table of the others.
    common: float = 0.0001
    #: How much more the rarest shingle weighs than one that is in every document.
    idf: float = 0.5
    block: int = 512
    seed: int = 20


def digest(text: bytes | None) -> bytes:
    return hashlib.blake2b(b" ".join((text or b"").lower().split()), digest_size=16).digest()


def shingles(texts: list[bytes | None], size: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the shingles of all texts, and where each text's begin. Fewer words than ``size`` are one shingle."""
    w = Words(texts)
    n = np.diff(w.begin)
    counts = np.where(n >= size, n - size + 1, (n > 0).astype(np.int64))
    begin = np.concatenate(([0], np.cumsum(counts)))
    out = np.zeros(begin[-1], dtype=np.uint64)
    for a in range(0, len(out), STRETCH):
        place = np.arange(a, min(a + STRETCH, len(out)))
        doc = np.searchsorted(begin, place, "right") - 1
        first = place - begin[doc] + w.begin[doc]
        last = w.begin[doc + 1]
        own = np.zeros(len(place), dtype=np.uint64)
        for j in range(size):
            own = own * ODD + np.where(first + j < last, w.hash[np.minimum(first + j, w.n - 1)], np.uint64(j + 1))
        out[a : a + STRETCH] = mix(own)
    return out, begin


@dataclass
class Frequencies:
    """Shingles in at least ``least`` of ``total`` documents, sorted, with their counts; the last ``low`` bits of a hash are not kept."""

    h: np.ndarray
    df: np.ndarray
    total: int
    least: int
    strength: float
    low: int = 0

    def weights(self, h: np.ndarray, tf: np.ndarray) -> np.ndarray:
        rare = np.ones(len(h), dtype=np.float32)
        if len(self.h) and self.total > self.least:
            low = np.uint64(self.low)
            known = (h >> low) << low
            at = np.minimum(np.searchsorted(self.h, known), len(self.h) - 1)
            hit = self.h[at] == known
            scale = np.log(self.total / self.least)
            rare[hit] -= (np.log(self.df[at[hit]] / self.least) / scale).astype(np.float32)
        return tf.astype(np.float32) * (1 + np.float32(self.strength) * rare)


def weighted_set(h: np.ndarray, f: Frequencies) -> tuple[np.ndarray, np.ndarray]:
    keys, tf = np.unique(h, return_counts=True)
    return keys, f.weights(keys, tf)


def count_shingles(texts: DataFrame, total: int, s: Settings) -> Frequencies:
    """Exact document frequencies of all shingles; those below the bound are dropped after counting.

    Hashes travel as sorted blocks by their leading bits, five bytes each: with the block's number
    they name a shingle. The number of blocks grows with the input, so a block stays small.
    """
    bits = max(6, (texts.rdd.getNumPartitions() * 4 - 1).bit_length())
    least = max(2, int(np.ceil(total * s.common)))
    down, low = np.uint64(64 - bits), np.uint64(64 - bits - 40)

    def run(batches, most: int = 3_000_000):
        held: list[np.ndarray] = []
        n = 0

        def out():
            h, c = np.unique(np.concatenate(held), return_counts=True)
            part = (h >> down).astype(np.int64)
            cuts = np.flatnonzero(np.diff(part, prepend=-1))
            ends = np.append(cuts[1:], len(h))
            five = np.ascontiguousarray(((h >> low) & np.uint64((1 << 40) - 1)).astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :5]
            once = c == 1
            rows = {"part": part[cuts], "once": [five[a:b][once[a:b]].tobytes() for a, b in zip(cuts, ends, strict=True)],
                    "more": [five[a:b][~once[a:b]].tobytes() for a, b in zip(cuts, ends, strict=True)],
                    "times": [c[a:b][~once[a:b]].astype("<u4").tobytes() for a, b in zip(cuts, ends, strict=True)]}
            return pa.RecordBatch.from_pydict(rows, schema=pa.schema([("part", pa.int64()), *((k, pa.binary()) for k in ("once", "more", "times"))]))

        for b in batches:
            for _, t in runs_of(b.column(0)):
                h, begin = shingles(t, s.words)
                for i in range(len(t)):
                    own = np.unique(h[begin[i] : begin[i + 1]])
                    held.append(own)
                    n += len(own)
                if n >= most:
                    yield out()
                    held, n = [], 0
        if n:
            yield out()

    def five_to_hash(data: bytes) -> np.ndarray:
        raw = np.zeros((len(data) // 5, 8), dtype=np.uint8)
        raw[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
        return raw.view("<u8").ravel()

    def tally(f: pd.DataFrame) -> pd.DataFrame:
        h = np.concatenate([five_to_hash(x) for x in [*f["once"], *f["more"]]])
        times = np.concatenate([np.frombuffer(x, "<u4") for x in f["times"]]).astype(np.int64)
        c = np.concatenate([np.ones(len(h) - len(times), np.int64), times])
        order = np.argsort(h, kind="stable")
        h, c = h[order], c[order]
        cuts = np.flatnonzero(np.diff(h, prepend=h[:1] + np.uint64(1)))
        df = np.add.reduceat(c, cuts) if len(cuts) else c
        keep = df >= least
        whole = (np.uint64(int(f["part"].iloc[0])) << np.uint64(40)) | h[cuts][keep]
        return pd.DataFrame({"h": whole.view(np.int64), "df": df[keep]})

    got = texts.mapInArrow(run, "part long, once binary, more binary, times binary").groupBy("part").applyInPandas(tally, "h long, df long").toPandas()
    # what came is at most (shingles of a mean document) / common rows
    h = got["h"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(h)
    return Frequencies(h[order] << low, got["df"].to_numpy(dtype=np.int64)[order], total, least, s.idf, int(low)) if len(h) else Frequencies(h, np.zeros(0, np.int64), total, least, s.idf)


class Sampler:
    """Improved consistent weighted sampling; its variates are functions of shingle and sample number alone.

    The three variates of a sample come together from a table of 65,536 draws. For the weight that
    most shingles have, a rare one that occurs once, what a draw is worth is worked out beforehand.
    """

    def __init__(self, s: Settings):
        rng = np.random.default_rng(s.seed)
        self.k = s.bands * s.rows
        self.s = s
        self.odd = rng.integers(0, 1 << 63, self.k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.r = rng.gamma(2, 1, 1 << 16).astype(np.float32)
        self.log_c = np.log(rng.gamma(2, 1, 1 << 16)).astype(np.float32)
        self.beta = rng.random(1 << 16).astype(np.float32)
        self.usual = np.float32(1 + np.float32(s.idf))
        self.usual_value, self.usual_t = self._worth(np.log(self.usual), np.arange(1 << 16))

    def _worth(self, log_w: np.ndarray, draw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        r, beta = self.r[draw], self.beta[draw]
        t = np.floor(log_w / r + beta)
        return self.log_c[draw] - r * (t - beta + 1), t

    def bands(self, h: np.ndarray, w: np.ndarray, at_once: int = 4096) -> np.ndarray:
        best = np.full(self.k, np.inf, dtype=np.float32)
        name = np.zeros(self.k, dtype=np.uint64)
        cols = np.arange(self.k)
        usual = w == self.usual
        for own, log_w in ((h[usual], None), (h[~usual], np.log(w[~usual])[:, None])):
            for a in range(0, len(own), at_once):
                part = own[a : a + at_once]
                draw = ((part[:, None] * self.odd) >> np.uint64(48)).astype(np.uint16)
                value, t = (self.usual_value[draw], None) if log_w is None else self._worth(log_w[a : a + at_once], draw)
                win = value.argmin(axis=0)
                top = value[win, cols]
                level = self.usual_t[draw[win, cols]] if t is None else t[win, cols]
                better = top < best
                best = np.where(better, top, best)
                name = np.where(better, mix(part[win] ^ (level.astype(np.int64).view(np.uint64) * ODD)), name)
        out = np.arange(1, self.s.bands + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        for j in range(self.s.rows):
            out = mix(out * ODD + name.reshape(self.s.bands, self.s.rows)[:, j])
        return out


def similar_links(sets: list[tuple[np.ndarray, np.ndarray]], left: int, least: float) -> list[tuple[int, int]]:
    """A spanning forest of the pairs with weighted Jaccard similarity of ``least`` or more.

    With ``left`` below the number of sets, pairs are one of the first ``left`` sets and one of the
    others; otherwise all pairs.
    """
    n = len(sets)
    sizes = np.array([len(h) for h, _ in sets])
    h = np.concatenate([h for h, _ in sets])
    w = np.concatenate([w for _, w in sets])
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(h, kind="stable")
    ids = np.zeros(len(h), dtype=np.int64)
    ids[order] = np.cumsum(np.diff(h[order], prepend=h[order][:1]) != 0)
    starts = np.searchsorted(ids[order], np.arange(ids.max(initial=-1) + 2))
    ends = starts[1:]
    posted, weight = owner[order], w[order]
    total = np.bincount(owner, w, n)
    begin = np.concatenate(([0], np.cumsum(sizes)))
    root = np.arange(n)
    links: list[tuple[int, int]] = []

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a in range(left if left < n else n):
        own = ids[begin[a] : begin[a + 1]]
        if not len(own):
            continue
        lengths = ends[own] - starts[own]
        at = np.repeat(starts[own] - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths) + np.arange(lengths.sum())
        both = np.bincount(posted[at], np.minimum(weight[at], np.repeat(w[begin[a] : begin[a + 1]], lengths)), n)
        from_ = left if left < n else a + 1
        with np.errstate(invalid="ignore", divide="ignore"):
            j = both[from_:] / (total[a] + total[from_:] - both[from_:])
        for b in np.flatnonzero(j >= least - 1e-6) + from_:
            x, y = find(a), find(int(b))
            if x != y:
                root[max(x, y)] = min(x, y)
                links.append((a, int(b)))
    return links


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings(), carry: dict | None = None) -> DataFrame:
    """One row per input row: id, class_id, class_size, kept, and the columns of ``carry`` (name -> Column).

    A class is a component of the graph of links between texts of at least the given similarity;
    class_id is its smallest id and the one row with it is kept. Texts of fewer words than a
    shingle are one shingle; texts without a word (null, empty, blank) are one class of their own.
    Null ids belong to classes but name none that has another id. Of repeated rows one is kept. No
    rows give no rows. Other columns are not read.
    """
    spark, s = ship(docs.sparkSession), settings
    extra = list(carry or {})
    text = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    same = [F.xxhash64(text).alias("_h"), F.crc32(text).alias("_c")]  # with the id they name a text among all
    rows = docs.select(text.alias("text"), F.col(id_col).alias("_id"), *same, *[c.alias(f"_c_{k}") for k, c in (carry or {}).items()])
    texts = rows.select("text", "_id", "_h", "_c")
    total = rows.count()
    shared = spark.sparkContext.broadcast(count_shingles(rows.select("text"), total, s))

    def sign(batches):
        sampler, f = Sampler(s), shared.value
        seen: set[bytes] = set()
        for b in batches:
            names, bands = [], []
            for _, t in runs_of(b.column(0)):
                own = [digest(x) for x in t]
                h, begin = shingles(t, s.words)
                for i, d in enumerate(own):
                    fresh = d not in seen and begin[i] < begin[i + 1]
                    if fresh and len(seen) < 200_000:
                        seen.add(d)
                    bands.append(sampler.bands(*weighted_set(h[begin[i] : begin[i + 1]], f)).view(np.int64) if fresh else None)
                names += own
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(names, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=[*fields, "digest", "bands"])

    given = rows.drop("text")
    fields = given.columns
    schema = given.withColumn("digest", F.lit(b"")).withColumn("bands", F.array(F.lit(0).cast("long"))).schema
    for name in ("digest", "bands"):
        schema[name].nullable = True
    signed = cut(rows.select("text", *fields).mapInArrow(sign, schema))

    # candidates: every text hangs on the smallest digest of each of its bands
    banded = signed.filter(F.col("bands").isNotNull()).select("digest", F.explode("bands").alias("h"))
    leaders = banded.groupBy("h").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).filter("lo != hi").select("h", "lo")
    coarse = components(banded.join(leaders, "h").select(F.col("digest").alias("a"), F.col("lo").alias("b")))
    links = verified_links(texts, signed, coarse, shared, s)
    classes = components(cut(links))

    each = signed.groupBy("digest").agg(F.min("_id").alias("lo"), F.count(F.lit(1)).alias("n"))
    linked = classes.select(F.col("a").alias("digest"), F.col("b").alias("root")).union(classes.select(F.col("b").alias("digest"), F.col("b").alias("root")).distinct())
    every = cut(each.join(linked, "digest", "left"))
    first = F.min(F.struct(F.col("lo").isNull().alias("none"), "lo", "digest"))
    figures = every.filter("root is not null").groupBy("root").agg(first.alias("first"), F.sum("n").alias("class_size"))
    # the texts of a large class meet its figures in several tasks
    salts = 16
    salted = figures.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    own = F.struct(F.col("lo").isNull().alias("none"), "lo", "digest").alias("first")
    alone = every.filter("root is null").select("digest", own, F.col("n").alias("class_size"))
    together = every.filter("root is not null").select("digest", "root", F.pmod(F.xxhash64("digest"), F.lit(salts)).cast("int").alias("salt")).join(salted, ["root", "salt"])
    named = alone.unionByName(together.select("digest", "first", "class_size"))
    twice = F.row_number().over(Window.partitionBy("digest", "_id").orderBy(F.lit(0)))
    out = signed.drop("bands").withColumn("_rn", twice).join(named, "digest")
    kept = (F.col("digest") == F.col("first.digest")) & F.col("_id").eqNullSafe(F.col("first.lo")) & (F.col("_rn") == 1)
    return out.select(F.col("_id").alias(id_col), F.col("first.lo").alias("class_id"), "class_size", kept.alias("kept"), *[F.col(f"_c_{k}").alias(k) for k in extra])


LINKS = "a binary, b binary"


def _links(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in pairs], pa.binary()), pa.array([y for _, y in pairs], pa.binary())], names=["a", "b"])


def _runs(batches, keys: int):
    """Rows (as lists of columns beyond the first ``keys``) of each run of equal keys, of batches that are sorted by them."""
    now, held = None, []
    for b in batches:
        cols = [c.to_pylist() for c in b.columns]
        for row in zip(*cols, strict=True):
            if row[:keys] != now:
                if held:
                    yield now, held
                now, held = row[:keys], []
            held.append(row[keys:])
    if held:
        yield now, held


def verified_links(texts: DataFrame, signed: DataFrame, coarse: DataFrame, shared, s: Settings) -> DataFrame:
    """Links (a, b) between digests that keep together all that similar pairs within each coarse component keep together.

    ``texts``: text, _id, _h, _c of every row; one row a digest is fetched. A group in a task is one
    block, or two, of about ``s.block`` texts, whatever the size of a component.
    """
    member = coarse.select(F.col("a").alias("digest"), F.col("b").alias("comp")).union(coarse.select(F.col("b").alias("digest"), F.col("b").alias("comp")).distinct())
    sizes = member.groupBy("comp").agg(F.ceil(F.count(F.lit(1)) / s.block).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int").alias("block")
    # the sizes of components of several blocks are few; no text travels here
    placed = member.join(sizes, "comp").select("digest", "comp", "blocks", block)
    one = signed.groupBy("digest").agg(F.min(F.struct("_h", "_c", "_id")).alias("r"))
    wanted = placed.join(one, "digest").select("digest", "comp", "blocks", "block", F.col("r._h").alias("_wh"), F.col("r._c").alias("_wc"), F.col("r._id").alias("_wi"))
    at = (F.col("_h") == F.col("_wh")) & (F.col("_c") == F.col("_wc")) & F.col("_id").eqNullSafe(F.col("_wi"))
    found = cut(texts.join(wanted, at).groupBy("digest", "comp", "blocks", "block").agg(F.first("text").alias("text")))

    def sets_of(raw: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        out = []
        for a, b in slices([len(t) for t in raw]):
            h, begin = shingles(raw[a:b], s.words)
            out += [weighted_set(h[begin[i] : begin[i + 1]], shared.value) for i in range(b - a)]
        return out

    def within(batches):
        for _, rows in _runs(batches, 1):
            links = similar_links(sets_of([t for _, t in rows]), len(rows), s.similarity)
            yield _links([(rows[x][0], rows[y][0]) for x, y in links])

    def to_pivot(batches):
        pivot, own = None, None
        for b in batches:
            names, raw, given = (b.column(c).to_pylist() for c in (1, 2, 3))
            linked = []
            for a, z in slices([len(t) for t in raw]):
                for t, p, x in zip(raw[a:z], given[a:z], sets_of(raw[a:z]), strict=True):
                    if p != pivot:
                        pivot, own = p, sets_of([p])[0]
                    linked.append(t == p or bool(similar_links([x, own], 1, s.similarity)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.binary()), pa.array(linked, pa.bool_())], names=["comp", "digest", "linked"])

    def between(batches):
        for _, rows in _runs(batches, 3):
            n = sum(not right for right, _, _ in rows)  # those that ask come first
            if 0 < n < len(rows):
                links = similar_links(sets_of([t for _, _, t in rows]), n, s.similarity)
                yield _links([(rows[x][1], rows[y][1]) for x, y in links if rows[x][1] != rows[y][1]])

    def together(df: DataFrame, *keys: str, then: list[str]) -> DataFrame:
        return df.repartition(*keys).sortWithinPartitions(*keys, *then)

    small = together(found.filter("blocks = 1").select("comp", "digest", "text"), "comp", then=["digest"]).mapInArrow(within, LINKS)
    large = found.filter("blocks > 1")
    pivots = large.filter("digest = comp").select("comp", F.col("text").alias("pivot"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    asked = large.join(pivots, ["comp", "block"]).select("comp", "digest", "text", "pivot")
    held = cut(asked.mapInArrow(to_pivot, "comp binary, digest binary, linked boolean"))
    stars = held.filter("linked and digest != comp").select(F.col("digest").alias("a"), F.col("comp").alias("b"))
    left = held.filter("not linked").select("comp", "digest")
    parts = left.groupBy("comp").agg(F.ceil(F.count(F.lit(1)) / s.block).cast("int").alias("parts"))
    asks = large.join(left, ["comp", "digest"]).join(parts, "comp").select(
        "comp", F.pmod(F.xxhash64("digest", F.lit(1)), F.col("parts")).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("j"), F.lit(False).alias("right"), "digest", "text"
    )
    answers = large.join(parts, "comp").select("comp", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("i"), F.col("block").alias("j"), F.lit(True).alias("right"), "digest", "text")
    crossed = together(asks.unionByName(answers), "comp", "i", "j", then=["right", "digest"]).mapInArrow(between, LINKS)
    return small.unionByName(stars).unionByName(crossed)


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``docs`` with one document of each class; rows that repeat id and text stay or go together."""
    key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    groups = cut(near_groups(docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")), "i", "t", settings, {"h": F.xxhash64(F.coalesce(F.col("t"), F.lit("")))}))
    gone = groups.groupBy("i", "h").agg(F.max("kept").alias("stays")).filter("not stays")
    gone = gone.select(F.col("i").alias("_gone_i"), F.col("h").alias("_gone_h"))
    return docs.join(gone, F.col(id_col).eqNullSafe(F.col("_gone_i")) & (key == F.col("_gone_h")), "left_anti")
