"""Exact Jaccard join of word shingles with signature trees.

A document is the set of its distinct shingles. Three steps leave no link out and leave little to compare:

1. Exact counting. Whatever links with another text has at least the threshold's share of its
   shingles in some other text. Every shingle is counted over all documents, in sorted blocks by
   its leading bits (four bytes a shingle; a task sends a shingle once, however many of its texts
   hold it), and only texts that pass go on. Most texts of a corpus end here.
2. Prefixes. Of two linked texts, the rarest shingles of either, as many as may be missing from the
   overlap and one more, have one in common. Texts that share such a shingle and are of like size
   hang on the smallest of them, and coarse components of these stars hold all links.
3. Signature trees. Within a component, nodes hold the OR of the bitmaps of their texts' shingles
   and the range of their sizes; two trees are walked together, and a pair of nodes is left out once
   its largest possible overlap is below what the smallest sizes in it need. What is left is compared
   shingle by shingle. A component of one block is one tree against itself; in a larger one all texts
   meet a pivot first, and only those that it does not hold ask blocks of like size for links. Only
   the links of a spanning forest leave a task: copies are one text, and cliques are never listed.

Blocks are bounded by texts and by shingles.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship
from .bytewords import mix, runs_of
from .components import components
from .near_dedup import shingles
from .storage import cut

#: Bits of the map of wanted texts that goes to all tasks: 2 MB. A map that fills up lets more texts pass, and the join after it is exact.
MAP_BITS = 24


@dataclass(frozen=True)
class Settings:
    words: int = 5
    #: Two texts link when 100 * intersection >= percent * union.
    percent: int = 80
    #: Most texts and most shingles of a block (one text may have more).
    block: int = 512
    block_shingles: int = 1 << 20
    leaf: int = 8
    fanout: int = 8


def distinct_sets(texts: list[bytes | None], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    h, begin = shingles(texts, size)
    return [np.unique(h[begin[i] : begin[i + 1]]) for i in range(len(texts))]


def set_digest(own: np.ndarray) -> bytes:
    return hashlib.blake2b(own.tobytes(), digest_size=16).digest()


def _sized(s: Settings):
    """Rows with the size of the set and its digest (null: empty) in place of the text."""

    def run(batches):
        for b in batches:
            sizes: list[int] = []
            names: list[bytes | None] = []
            for _, t in runs_of(b.column(0)):
                for own in distinct_sets(t, s.words):
                    sizes.append(len(own))
                    names.append(set_digest(own) if len(own) else None)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(sizes, pa.int64()), pa.array(names, pa.binary())], names=["_id", "_h", "_c", "n", "digest"])

    return run


def _short(h: np.ndarray, low: np.uint64) -> bytes:
    return (h >> low).astype("<u4").tobytes()


def lone_shingles(texts: DataFrame, s: Settings) -> DataFrame:
    """d (first 8 bytes of a set's digest), lone: how many of its shingles no other text has; sets without one give no row.

    ``lone`` is never too high: hashes that agree in the bits that travel, and copies that a task no
    longer remembers, make a shingle shared. So the filter built on it loses nothing.
    """
    bits = max(5, (texts.rdd.getNumPartitions() - 1).bit_length())
    down, low = np.uint64(64 - bits), np.uint64(64 - bits - 32)

    def deal(batches, most: int = 2_000_000, remember: int = 200_000):
        seen: set[bytes] = set()
        held: list[np.ndarray] = []
        names: list[int] = []
        n = 0

        def out():
            h = np.concatenate(held)
            doc = np.repeat(np.arange(len(held), dtype=np.int64), [len(x) for x in held])
            order = np.argsort(h, kind="stable")
            h, doc = h[order], doc[order]
            first = np.flatnonzero(np.diff(h, prepend=h[:1] + np.uint64(1)))
            once = np.diff(np.append(first, len(h))) == 1
            many, h, doc = h[first[~once]], h[first[once]], doc[first[once]]
            part, many_part = (h >> down).astype(np.int64), (many >> down).astype(np.int64)
            by_doc = np.lexsort((doc, part))
            h, doc, part = h[by_doc], doc[by_doc], part[by_doc]
            d64 = np.array(names, dtype=np.int64)
            rows: dict[str, list] = {k: [] for k in ("part", "once", "docs", "sizes", "many")}
            for p in np.union1d(part, many_part):
                a, b = np.searchsorted(part, [p, p + 1])
                c, e = np.searchsorted(many_part, [p, p + 1])
                docs, sizes = np.unique(doc[a:b], return_counts=True)
                for k, v in zip(rows, (p, _short(h[a:b], low), d64[docs].astype("<i8").tobytes(), sizes.astype("<u4").tobytes(), _short(many[c:e], low)), strict=True):
                    rows[k].append(v)
            return pa.RecordBatch.from_pydict(rows, schema=pa.schema([("part", pa.int64()), *((k, pa.binary()) for k in list(rows)[1:])]))

        for b in batches:
            for _, t in runs_of(b.column(0)):
                for own in distinct_sets(t, s.words):
                    name = set_digest(own)
                    if not len(own) or name in seen:
                        continue
                    if len(seen) < remember:
                        seen.add(name)
                    held.append(own)
                    names.append(int.from_bytes(name[:8], "big", signed=True))
                    n += len(own)
                    if n >= most:
                        yield out()
                        held, names, n = [], [], 0
        if n:
            yield out()

    def tally(f: pd.DataFrame) -> pd.DataFrame:
        once = np.concatenate([np.frombuffer(x, "<u4") for x in f["once"]])
        docs = np.concatenate([np.repeat(np.frombuffer(d, "<i8"), np.frombuffer(k, "<u4")) for d, k in zip(f["docs"], f["sizes"], strict=True)])
        many = np.concatenate([np.frombuffer(x, "<u4") for x in f["many"]])
        h = np.concatenate([once, many])
        order = np.argsort(h, kind="stable")
        first = np.flatnonzero(np.diff(h[order], prepend=h[order][:1] + np.uint32(1)))
        owner = np.concatenate([docs, np.zeros(len(many), np.int64)])[order]
        shared = np.logical_or.reduceat(order >= len(once), first) | (np.minimum.reduceat(owner, first) != np.maximum.reduceat(owner, first))
        d, lone = np.unique(owner[first][~shared], return_counts=True)
        part = d >> np.int64(64 - bits)
        cuts = np.flatnonzero(np.diff(part, prepend=part[:1] + 1))
        spans = list(zip(cuts, [*cuts[1:], len(d)], strict=False))
        return pd.DataFrame({"dpart": part[cuts], "docs": [d[a:b].astype("<i8").tobytes() for a, b in spans], "lone": [lone[a:b].astype("<u4").tobytes() for a, b in spans]})

    def add_up(f: pd.DataFrame) -> pd.DataFrame:
        d = np.concatenate([np.frombuffer(x, "<i8") for x in f["docs"]])
        lone = np.concatenate([np.frombuffer(x, "<u4") for x in f["lone"]]).astype(np.int64)
        keys, at = np.unique(d, return_inverse=True)
        return pd.DataFrame({"d": keys, "lone": np.bincount(at, lone, len(keys)).astype(np.int64)})

    dealt = texts.mapInArrow(deal, "part long, once binary, docs binary, sizes binary, many binary")
    told = dealt.groupBy("part").applyInPandas(tally, "dpart long, docs binary, lone binary")
    return told.groupBy("dpart").applyInPandas(add_up, "d long, lone long")


def wanted_map(hashes: DataFrame) -> np.ndarray:
    """Packed bits, one set for the leading bits of each 64-bit hash. Its size is fixed, and tasks add up their own before anything is sent."""
    place = F.shiftrightunsigned("_h", 64 - MAP_BITS)
    bytes_ = hashes.select(F.shiftright(place, 3).cast("int").alias("at"), F.expr(f"shiftright(128, cast(shiftrightunsigned(_h, {64 - MAP_BITS}) % 8 as int))").alias("bit"))
    told = bytes_.groupBy("at").agg(F.bit_or("bit").alias("bits")).toPandas()
    out = np.zeros(1 << (MAP_BITS - 3), dtype=np.uint8)
    out[told["at"]] = told["bits"]
    return out


class SignatureTree:
    """Levels of nodes, sets first: OR of bitmaps, smallest and largest size, and most shingles that share a bit with another of their set."""

    def __init__(self, sets: list[np.ndarray], leaf: int, fanout: int, width: int):
        self.order = np.array(sorted(range(len(sets)), key=lambda i: (len(sets[i]), sets[i][0])), dtype=np.int64)
        self.sets = [sets[i] for i in self.order]
        sizes = np.array([len(x) for x in self.sets], dtype=np.int64)
        bits = np.zeros((len(sets), width // 64), dtype=np.uint64)
        for i, x in enumerate(self.sets):
            row = np.zeros(width, dtype=bool)
            row[(mix(x) >> np.uint64(64 - width.bit_length() + 1)).astype(np.int64)] = True
            bits[i] = np.packbits(row).view(np.uint64)
        clash = sizes - np.bitwise_count(bits).sum(1, dtype=np.int64)
        self.levels = [(bits, sizes, sizes, clash)]
        self.steps: list[int] = []
        while len(self.levels[-1][1]) > 1:
            bits, lo, hi, clash = self.levels[-1]
            step = leaf if len(self.levels) == 1 else fanout
            at = np.arange(0, len(lo), step)
            self.steps.append(step)
            self.levels.append((np.bitwise_or.reduceat(bits, at), np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at), np.maximum.reduceat(clash, at)))

    def children(self, level: int, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First child of each node of a level, and the one after its last."""
        step = self.steps[level - 1]
        return node * step, np.minimum((node + 1) * step, len(self.levels[level - 1][1]))


def possible(a: SignatureTree, la: int, i: np.ndarray, b: SignatureTree, lb: int, j: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of nodes may hold a link: sizes of like range, and the largest possible overlap not below what is needed."""
    bits_a, lo_a, hi_a, clash_a = (x[i] for x in a.levels[la])
    bits_b, lo_b, hi_b, clash_b = (x[j] for x in b.levels[lb])
    most = np.bitwise_count(bits_a & bits_b).sum(1, dtype=np.int64) + np.minimum(clash_a, clash_b)
    most = np.minimum(most, np.minimum(hi_a, hi_b))
    # the overlap of a link is at least p / (100 + p) of both sizes together
    return (100 * hi_a >= percent * lo_b) & (100 * hi_b >= percent * lo_a) & ((100 + percent) * most >= percent * (lo_a + lo_b))


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = np.concatenate([x, y])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return bool(len(x) and len(y)) and 100 * common >= percent * (len(x) + len(y) - common)


def width_for(sets: list[np.ndarray]) -> int:
    """Bits of a bitmap: four for each shingle of a large set, at most 32,768."""
    large = np.quantile([len(x) for x in sets], 0.9)
    return 1 << min(15, max(9, math.ceil(math.log2(4 * large + 1))))


def joined(left: list[np.ndarray], right: list[np.ndarray] | None, s: Settings, most: int = 8192) -> list[tuple[int, int]]:
    """A spanning forest of the links between ``left`` and ``right``, or within ``left``; pairs are places in the lists.

    No set is empty. Pairs of nodes are walked depth first in runs of bounded size.
    """
    width = width_for(left + (right or []))
    a = SignatureTree(left, s.leaf, s.fanout, width)
    b = a if right is None else SignatureTree(right, s.leaf, s.fanout, width)
    shift = 0 if right is None else len(left)
    root = list(range(shift + len(b.sets)))
    links: list[tuple[int, int]] = []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    todo = [(len(a.levels) - 1, len(b.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while todo:
        la, lb, i, j = todo.pop()
        if la == lb == 0:
            roots = np.array([find(x) for x in range(len(root))])
            open_ = roots[i] != roots[j + shift]
            i, j = i[open_], j[open_]
        ok = possible(a, la, i, b, lb, j, s.percent)
        i, j = i[ok], j[ok]
        if la == lb == 0:
            for x, y in zip(i.tolist(), j.tolist(), strict=True):
                if (p := find(x)) != (q := find(y + shift)) and linked(a.sets[x], b.sets[y], s.percent):
                    root[max(p, q)] = min(p, q)
                    links.append((int(a.order[x]), int(b.order[y])))
            continue
        # the deeper tree is opened, or both
        open_a, open_b = la >= lb and la > 0, lb >= la and lb > 0
        (from_a, to_a), (from_b, to_b) = a.children(la, i) if open_a else (i, i + 1), b.children(lb, j) if open_b else (j, j + 1)
        wide_b = to_b - from_b
        each = (to_a - from_a) * wide_b
        at = np.repeat(np.arange(len(i)), each)
        place = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        x, y = from_a[at] + place // wide_b[at], from_b[at] + place % wide_b[at]
        la, lb = la - open_a, lb - open_b
        if right is None:
            keep = (x < y) if la == 0 else (x <= y)
            x, y = x[keep], y[keep]
        todo += [(la, lb, x[k : k + most], y[k : k + most]) for k in range(0, len(x), most)]
    return links


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([x for x, _ in pairs], pa.int64()), pa.array([y for _, y in pairs], pa.int64())], schema=LINKS)


def _groups(batches, keys: int):
    """(other columns of the rows) of each run of equal leading columns; the last column is a list, and comes as numpy."""
    now, held = None, []
    for b in batches:
        cols = [c.to_pylist() for c in b.columns[:-1]]
        last = b.columns[-1]
        for r, row in enumerate(zip(*cols, strict=True)):
            if row[:keys] != now:
                if held:
                    yield held
                now, held = row[:keys], []
            held.append((*row[keys:], np.asarray(last[r].values).astype(np.int64).view(np.uint64)))
    if held:
        yield held


def links_within(sets: DataFrame, member: DataFrame, s: Settings) -> DataFrame:
    """Links (a, b) that keep together what links within each component keep together.

    ``sets``: k, n, tokens (sorted as unsigned numbers); ``member``: k, comp.
    """
    size = F.floor(F.log(F.col("n")) / math.log(1.26)).cast("int").alias("size")
    placed = cut(sets.select("k", "n").join(member, "k").select("k", "n", size, "comp"))
    parts = F.ceil(F.greatest(F.count(F.lit(1)) / s.block, F.sum("n") / s.block_shingles)).cast("int")
    blocks = cut(placed.groupBy("comp").agg(parts.alias("blocks"), F.min("k").alias("pivot")))
    own_tokens = sets.select("k", "tokens")
    small = own_tokens.join(placed.join(blocks.filter("blocks = 1").select("comp"), "comp"), "k").select("comp", "k", "tokens")
    large = cut(own_tokens.join(placed.join(blocks.filter("blocks > 1"), "comp"), "k"))

    def within(batches):
        for held in _groups(batches, 1):
            yield _links([(held[x][0], held[y][0]) for x, y in joined([t for _, t in held], None, s)])

    def to_pivot(batches):
        for b in batches:
            told = []
            for t, p in zip(b.column(2), b.column(3), strict=True):
                told.append(linked(*(np.asarray(x.values).astype(np.int64).view(np.uint64) for x in (t, p)), s.percent))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(told, pa.bool_())], names=["comp", "k", "held"])

    def between(batches):
        for held in _groups(batches, 5):
            n = sum(not right for right, _, _ in held)  # those that ask come first
            if 0 < n < len(held):
                found = joined([t for _, _, t in held[:n]], [t for _, _, t in held[n:]], s)
                yield _links([(held[x][1], held[n + y][1]) for x, y in found if held[x][1] != held[n + y][1]])

    one = small.repartition("comp").sortWithinPartitions("comp").mapInArrow(within, "a long, b long")
    # one pivot a large component; a copy of it for each block's worth of members
    salt = F.pmod(F.xxhash64("k"), F.col("blocks")).cast("int")
    pivots = large.filter("k = pivot").select("comp", F.col("tokens").alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("salt"))
    asked = large.withColumn("salt", salt).join(cut(pivots), ["comp", "salt"]).select("comp", "k", "tokens", "own")
    told = cut(asked.mapInArrow(to_pivot, "comp long, k long, held boolean"))
    stars = told.filter("held").join(blocks, "comp").select(F.col("k").alias("a"), F.col("pivot").alias("b")).filter("a != b")
    asks = large.join(told.filter("not held").select("k"), "k").select("comp", "k", "n", "size", "tokens")
    # blocks by component and size; those that ask meet those of the sizes beside their own
    ask_parts = cut(asks.groupBy("comp", "size").agg(parts.alias("parts")))
    all_parts = cut(large.groupBy("comp", "size").agg(parts.alias("parts")))
    beside = F.explode(F.array(*[F.col("size") + F.lit(d) for d in (-1, 0, 1)]))
    own = F.pmod(F.xxhash64("k"), F.col("parts")).cast("int")
    pairs = ask_parts.select("comp", F.col("size").alias("x"), F.col("parts").alias("x_parts"), beside.alias("size")).join(all_parts.withColumnRenamed("parts", "y_parts"), ["comp", "size"])
    pairs = cut(pairs.select("comp", "x", "x_parts", F.col("size").alias("y"), "y_parts"))
    left = asks.join(ask_parts, ["comp", "size"]).withColumn("i", own).select("comp", F.col("size").alias("x"), "i", "k", "tokens").join(pairs, ["comp", "x"])
    left = left.select("comp", "x", "y", "i", F.explode(F.sequence(F.lit(0), F.col("y_parts") - 1)).alias("j"), F.lit(False).alias("right"), "k", "tokens")
    right = large.join(all_parts, ["comp", "size"]).withColumn("j", own).select("comp", F.col("size").alias("y"), "j", "k", "tokens").join(pairs, ["comp", "y"])
    right = right.select("comp", "x", "y", F.explode(F.sequence(F.lit(0), F.col("x_parts") - 1)).alias("i"), "j", F.lit(True).alias("right"), "k", "tokens")
    keys = ["comp", "x", "y", "i", "j"]
    crossed = left.unionByName(right).repartition(*keys).sortWithinPartitions(*keys, "right", "k").mapInArrow(between, "a long, b long")
    return one.unionByName(stars).unionByName(crossed)


def rare_prefixes(sets: DataFrame, s: Settings) -> DataFrame:
    """k, n, h: of each set its rarest shared shingles, as many as may be missing from a link's overlap and one more, less those that no other has."""
    each = sets.select("k", "n", F.explode("tokens").alias("h"))
    counted = cut(each.groupBy("h").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"))
    shared = each.join(counted, "h")
    own = Window.partitionBy("k")
    needed = F.count(F.lit(1)).over(own) - F.ceil(F.col("n") * s.percent / 100) + 1
    ranked = shared.withColumn("r", F.row_number().over(own.orderBy("df", "h"))).withColumn("needed", needed)
    return ranked.filter("r <= needed").select("k", "n", "h")


def coarse_components(prefixes: DataFrame) -> DataFrame:
    """k, comp: sets that hang together by shared prefix shingles among sets of like size."""
    # sizes of a link differ by less than a class, so the smaller's class or the next is the larger's
    size = F.floor(F.log(F.col("n")) / math.log(1.26)).cast("int")
    keyed = prefixes.select("k", "h", F.explode(F.array(size, size + 1)).alias("size"))
    leaders = cut(keyed.groupBy("h", "size").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).filter("lo != hi").select("h", "size", "lo"))
    found = components(keyed.join(leaders, ["h", "size"]).select(F.col("k").alias("a"), F.col("lo").alias("b")).filter("a != b").distinct())
    return found.select(F.col("a").alias("k"), F.col("b").alias("comp")).union(found.select("b", "b").distinct())


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (the smallest id that links lead to, its own included).

    A-Z are lower-cased; words are what stands between white space of ASCII. Texts of fewer words than
    a shingle have one; texts without a word (null, empty, blank) have none and are linked with
    nothing, not even with their like. Texts of equal sets are linked, repeated rows too. Null ids
    belong to components but name none that has another id. No rows give no rows. Other columns are
    not read.
    """
    ship(docs.sparkSession)
    s = settings
    if 100 > s.percent * 1.26 + 1e-9:
        raise ValueError("classes of sizes are made for 80 percent or more")
    text = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    texts = docs.select(text.alias("text"), F.col(id_col).alias("_id"), F.xxhash64(text).alias("_h"), F.crc32(text).alias("_c"))
    kind = texts.schema["_id"].dataType.simpleString()
    sized = cut(texts.mapInArrow(_sized(s), f"_id {kind}, _h long, _c long, n long, digest binary"))
    first8 = F.conv(F.hex(F.substring("digest", 1, 8)), 16, -10).cast("long")
    each = sized.filter("n > 0").groupBy("digest").agg(F.min(F.struct("_h", "_c", "_id")).alias("r"), F.min("_id").alias("lo"), F.max("n").alias("n"), F.count(F.lit(1)).alias("rows"))
    each = each.withColumn("d", first8)
    lone = lone_shingles(texts.select("text"), s)
    open_ = cut(each.join(lone, "d", "left").filter(100 * (F.col("n") - F.coalesce("lone", F.lit(0))) >= s.percent * F.col("n")).select("digest", "r"))
    wanted = open_.select("digest", F.col("r._h").alias("_wh"), F.col("r._c").alias("_wc"), F.col("r._id").alias("_wi"))
    at = (F.col("_h") == F.col("_wh")) & (F.col("_c") == F.col("_wc")) & F.col("_id").eqNullSafe(F.col("_wi"))

    def tokens(batches):
        for b in batches:
            for a, t in runs_of(b.column(0)):
                sets = distinct_sets(t, s.words)
                flat = pa.array(np.concatenate(sets).view(np.int64) if sets else [], pa.int64())
                starts = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in sets]))).astype(np.int32))
                listed = pa.ListArray.from_arrays(starts, flat)
                yield pa.RecordBatch.from_arrays([b.column(1).slice(a, len(t)), pa.array([len(x) for x in sets], pa.int64()), listed], names=["digest", "n", "tokens"])

    maps = ship(docs.sparkSession).sparkContext.broadcast(wanted_map(open_.select("r._h")))

    def sift(batches):
        for b in batches:
            h = (np.asarray(b.column(2)).astype(np.int64).view(np.uint64) >> np.uint64(64 - MAP_BITS)).astype(np.int64)
            yield b.filter(pa.array((maps.value[h >> 3] >> (7 - h % 8).astype(np.uint8)) & 1 == 1))

    likely = texts.mapInArrow(sift, texts.schema)
    found = likely.join(wanted, at).select("text", "digest").mapInArrow(tokens, "digest binary, n long, tokens array<long>")
    once = F.row_number().over(Window.partitionBy("digest").orderBy(F.lit(0)))  # rows that repeat id and text
    sets = cut(found.withColumn("_rn", once).filter("_rn = 1").select(F.monotonically_increasing_id().alias("k"), "digest", "n", "tokens"))
    comps = coarse_components(rare_prefixes(sets.select("k", "n", "tokens"), s))
    links = cut(links_within(sets.select("k", "n", "tokens"), comps, s))
    classes = components(links)
    member = classes.select(F.col("a").alias("k"), F.col("b").alias("root")).union(classes.select("b", "b").distinct())
    ids = cut(sets.select("k", "digest").join(member, "k").join(each.select("digest", "lo"), "digest"))
    roots = cut(ids.groupBy("root").agg(F.min("lo").alias("low")))
    linked_ids = ids.select("digest", "root").join(roots, "root").select("digest", "low")
    named = cut(each.select("digest", "lo").join(linked_ids, "digest", "left").select("digest", F.coalesce("low", "lo").alias("component_id")))
    full = sized.filter("digest is not null").select("_id", "n", "digest").join(named, "digest").select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")
    bare = sized.filter("digest is null").select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), F.col("_id").alias("component_id"))
    return full.unionByName(bare)
