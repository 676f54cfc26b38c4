"""The trie of the prefixes that conversations share.

Turn arrays are sorted globally by range, ties by id, so that one very common conversation spreads
over partitions too. In that order every prefix is one run of rows: a sweep with a stack closes a
node where the longest common prefix (LCP) of two neighbours falls below its depth. Members, leaves
and saved words are added to the node above when a node closes. A node that the first or last row
of a partition leaves open is given out as a part, and the parts of a node are added up across
partitions; there are as many parts a partition as its first and last row have turns. What a task
needs of its neighbours is two numbers, the LCPs at its two ends.

A turn is known by 128 bits of the SHA-256 of its role and text; texts do not travel. One
conversation's digests (16 bytes a turn) and what a range partition holds have to fit a task.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship
from .mixing import word_count
from .storage import cut

WIDTH = 16
#: Characters of a piece of a list of ids.
PIECE = 16_000
FOUND = (
    "kind string, pid int, own binary, parent binary, depth long, conv_id long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, seq int, ids string"
)
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turn_lists(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", near: Column | None = None) -> DataFrame:
    """One row per conversation: conv_id, near, turns (array of struct: d, the turn's digest in hex, and w, its words).

    Turns are ordered by turn (null first), then role and text; null roles and texts are empty. Rows
    without an id belong to no conversation and are left out. Conversations of one value of ``near``
    (by default each its own) come to the same task. Columns of the input are read only if named.
    """
    own = F.col(id_col).cast("long")
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    given = rows.filter(own.isNotNull()).select(own.alias("conv_id"), (own if near is None else near).alias("near"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    place = F.row_number().over(Window.partitionBy("near", "conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text"))
    turn = F.struct(
        place.alias("p"), F.left(F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text"), 256), F.lit(2 * WIDTH)).alias("d"), word_count(F.col("text")).alias("w")
    )
    told = given.repartition("near").select("conv_id", "near", turn.alias("t")).groupBy("near", "conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return told.select("conv_id", "near", F.transform("turns", lambda t: F.struct(t["d"].alias("d"), t["w"].alias("w"))).alias("turns"))


def branched(rows: DataFrame, every: int, most: int, **columns: str) -> DataFrame:
    """Turn lists with the head of a conversation taken from another: the first h turns of conversation c - c % every
    (fewer if it has fewer), then c's own after its first h; h is the unsigned crc32 of the decimal c, modulo ``most`` + 1."""
    own = F.col(columns.get("id_col", "conv_id")).cast("long")
    lists = turn_lists(rows, near=own - own % every, **columns)
    h = (F.crc32(F.col("conv_id").cast("string")) % (most + 1)).cast("int")
    head = F.max(F.when(F.col("conv_id") == F.col("near"), F.slice("turns", 1, most))).over(Window.partitionBy("near"))
    held = lists.withColumn("h", h).withColumn("head", F.coalesce(head, F.slice("turns", 1, 0)))
    return held.select("conv_id", F.concat(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))


def common_turns(a: bytes, b: bytes) -> int:
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most // WIDTH
    d = 0
    while a[d : d + WIDTH] == b[d : d + WIDTH]:
        d += WIDTH
    return d // WIDTH


def prefix_digests(key: bytes, depth: int) -> list[bytes]:
    """Names of the prefixes of 0 to ``depth`` turns."""
    h = hashlib.blake2b(digest_size=16)
    out = [h.digest()]
    for d in range(depth):
        h.update(key[d * WIDTH : (d + 1) * WIDTH])
        out.append(h.copy().digest())
    return out


class Node:
    __slots__ = ("started", "words", "n", "low", "children", "leaves", "saved", "ids", "waiting")

    def __init__(self, started: bool, words: int):
        self.started, self.words = started, words
        self.n = self.children = self.leaves = self.saved = 0
        self.low: int | None = None
        self.ids: list[int] = []
        self.waiting: list[list] = []  # closed children that have to learn this node's smallest member

    def close(self) -> None:
        self.n += len(self.ids)
        if self.ids and (self.low is None or self.ids[0] < self.low):
            self.low = self.ids[0]
        # of all rows through a node but the first, which is in the partition where the node starts
        self.saved += self.words * (self.n - self.started)

    def add(self, below: Node) -> None:
        self.n, self.leaves, self.saved = self.n + below.n, self.leaves + below.leaves, self.saved + below.saved
        if self.low is None or below.low < self.low:
            self.low = below.low


class Sweep:
    """The nodes of one partition. ``left`` and ``right`` are the LCPs with the row before the first and after the last, -1 without one."""

    def __init__(self, pid: int, left: int, right: int):
        self.pid, self.left, self.right = pid, left, right
        self.stack: list[Node] = []
        self.last: bytes | None = None
        self.out: list[list] = []
        self.left_names: list[bytes] = []  # of prefixes that are open at an end
        self.right_names: list[bytes] = []

    def row(self, key: bytes, words: list[int], conv: int) -> None:
        depth = len(key) // WIDTH
        if self.last is None:
            common, kept = self.left, -1
            self.left_names = prefix_digests(key, self.left) if self.left >= 0 else []
        else:
            common = kept = common_turns(self.last, key)
            self.step(common)
        for d in range(kept + 1, depth + 1):
            started = d > common
            if started and d:
                self.stack[d - 1].children += 1
            self.stack.append(Node(started, words[d - 1] if d else 0))
        self.stack[depth].ids.append(conv)
        self.last = key

    def step(self, common: int) -> None:
        """The next row has ``common`` turns in common with the last."""
        if common < len(self.stack) - 1:
            self.stack[-1].leaves += 1
        while len(self.stack) - 1 > common:
            self.pop()

    def pop(self, open_right: bool = False) -> None:
        d = len(self.stack) - 1
        node = self.stack.pop()
        node.close()
        above = self.stack[-1] if d else None
        if above:
            above.add(node)
        row = ["n", self.pid, None, None, d, node.low, None, node.n, node.children, node.leaves, node.saved, None, None, None]
        if open_right or not node.started:
            names = self.right_names if open_right else self.left_names
            row[0], row[2], row[3] = "s", names[d], names[d - 1] if d else None
            self.out.append(row)
            self.pieces(names[d], node.ids)
            for k in node.waiting:
                k[0], k[3] = "k", names[d]
        else:
            row[11] = hashlib.sha256(",".join(map(str, node.ids)).encode()).hexdigest()
            for k in node.waiting:
                k[6] = node.low
            if above and not above.started:
                row[0], row[3] = "k", self.left_names[d - 1]
            (above.waiting if above and above.started else self.out).append(row)
        self.out += node.waiting

    def pieces(self, own: bytes, ids: list[int]) -> None:
        for seq, a in enumerate(range(0, len(ids), PIECE // 20)):
            self.out.append(["e", self.pid, own, None, None, None, None, None, None, None, None, None, seq, ",".join(map(str, ids[a : a + PIECE // 20]))])

    def end(self) -> None:
        if self.last is None:
            return
        if self.right < len(self.stack) - 1:
            self.stack[-1].leaves += 1
        self.right_names = prefix_digests(self.last, self.right) if self.right >= 0 else []
        while self.stack:
            self.pop(open_right=len(self.stack) - 1 <= self.right)

    def take(self) -> list[list]:
        out, self.out = self.out, []
        return out


def _batch(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


ARROW = pa.schema(
    [("kind", pa.string()), ("pid", pa.int32()), ("own", pa.binary()), ("parent", pa.binary())]
    + [(k, pa.int64()) for k in ("depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [("ends_sha256", pa.string()), ("seq", pa.int32()), ("ids", pa.string())]
)


def _ends(batches):
    """First and last row of a partition."""
    pid = first = last = None
    for b in batches:
        if b.num_rows:
            if first is None:
                pid, first = b.column(0)[0].as_py(), b.column(1)[0].as_py()
            last = b.column(1)[b.num_rows - 1].as_py()
    if first is not None:
        yield pa.RecordBatch.from_pydict({"pid": pa.array([pid], pa.int32()), "first": pa.array([first], pa.binary()), "last": pa.array([last], pa.binary())})


def _lcps(batches):
    for b in batches:
        pid, before, first, last, after = (c.to_pylist() for c in b.columns)
        left = [-1 if p is None else common_turns(p, f) for p, f in zip(before, first, strict=True)]
        right = [-1 if a is None else common_turns(x, a) for x, a in zip(last, after, strict=True)]
        yield pa.RecordBatch.from_pydict({"pid": pa.array(pid, pa.int32()), "left": pa.array(left, pa.int32()), "right": pa.array(right, pa.int32())})


def _hashed(batches):
    """One row a node: SHA-256 of its pieces, which come in order."""
    own, h = None, None
    done: list[tuple[bytes, str]] = []
    for b in batches:
        for name, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if name != own:
                if own is not None:
                    done.append((own, h.hexdigest()))
                own, h = name, hashlib.sha256(ids.encode())
            else:
                h.update(b"," + ids.encode())
        yield pa.RecordBatch.from_pydict({"own": pa.array([x for x, _ in done], pa.binary()), "told": pa.array([x for _, x in done], pa.string())})
        done = []
    if own is not None:
        yield pa.RecordBatch.from_pydict({"own": pa.array([own], pa.binary()), "told": pa.array([h.hexdigest()], pa.string())})


def prefix_trie(lists: DataFrame) -> DataFrame:
    """``lists``: conv_id (unique, not null), turns. One row per node of the trie of all prefixes, the textless root included.

    conv_id: smallest member; depth; parent_conv_id: the parent's conv_id (null for the root);
    n_convs: members; n_children; n_leaves: childless nodes of its subtree; saved_tokens: over its
    subtree, each node's members but one times the words of its last turn; ends_sha256 over the ids
    of members that end here, ascending and joined by commas. Subtrees include their top. No
    conversations give no rows; a conversation without turns is a member of the root.
    """
    spark = ship(lists.sparkSession)
    key = F.unhex(F.array_join(F.transform("turns", lambda t: t["d"]), ""))
    flat = lists.select(key.alias("key"), F.transform("turns", lambda t: t["w"]).alias("words"), "conv_id")
    dealt = flat.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    rows = cut(dealt.select(F.spark_partition_id().alias("pid"), "key", "words", "conv_id"))

    # two numbers a partition go through the driver
    by_pid = Window.orderBy("pid")
    ends = rows.select("pid", "key").mapInArrow(_ends, "pid int, first binary, last binary")
    sides = ends.select("pid", F.lag("last").over(by_pid).alias("before"), "first", "last", F.lead("first").over(by_pid).alias("after"))
    bounds = {r["pid"]: (r["left"], r["right"]) for r in sides.mapInArrow(_lcps, "pid int, left int, right int").collect()}
    shared = spark.sparkContext.broadcast(bounds)

    def sweep(batches, some: int = 20_000):
        own = None
        for b in batches:
            for pid, k, words, conv in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if own is None:
                    own = Sweep(pid, *shared.value[pid])
                own.row(k, words, conv)
                if len(own.out) >= some:
                    yield _batch(own.take(), ARROW)
        if own is not None:
            own.end()
            left = own.take()
            for a in range(0, len(left), some):
                yield _batch(left[a : a + some], ARROW)

    found = cut(rows.mapInArrow(sweep, FOUND))
    sums = [F.sum(k).alias(k) for k in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    parts = found.filter("kind = 's'")
    told = found.filter("kind = 'e'").select("own", "ids", "pid", "seq").repartition("own").sortWithinPartitions("own", "pid", "seq")
    whole = parts.groupBy("own", "parent", "depth").agg(F.min("conv_id").alias("conv_id"), *sums)
    whole = cut(whole.join(told.select("own", "ids").mapInArrow(_hashed, "own binary, told string"), "own", "left"))
    whole = whole.withColumn("ends_sha256", F.coalesce("told", F.lit(hashlib.sha256(b"").hexdigest())))
    above = whole.select(F.col("own").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    spine = whole.join(above, "parent", "left").select(*NODE)
    # children of such nodes ask within their own partition, so that no node is asked by more rows than a partition has
    here = parts.select("pid", F.col("own").alias("parent")).join(above, "parent")
    below = found.filter("kind = 'k'").drop("parent_conv_id").join(here, ["pid", "parent"]).select(*NODE)
    return found.filter("kind = 'n'").select(*NODE).unionByName(spine).unionByName(below)
