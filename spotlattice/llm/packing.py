"""Packing token sequences by a linear grouping scheme.

Lengths are at most ``capacity``, so the whole corpus is described by at most ``capacity`` counts.
The plan is made on those counts alone and has bounded size at any number of documents: large
lengths are rounded up within groups of equal cardinality, configurations of the few rounded sizes
are chosen, actual lengths take the rounded places, and small lengths go best-fit into what is
left. It is kept as runs ("the next m documents of length l go to sequences s, s + 1, ... at
offset o"), which tasks look up by a document's length and its rank among equals.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship
from .storage import cut
from .tokens import encoder, vocabulary_path


def _best_fill(room: int, sizes: list[int], counts: list[int]) -> list[int]:
    """Groups (with repeats) whose sizes sum as near below ``room`` as the counts allow."""
    parent = np.full(room + 1, -1, dtype=np.int64)
    reach = np.zeros(room + 1, dtype=bool)
    reach[0] = True
    for g, (size, count) in enumerate(zip(sizes, counts, strict=True)):
        for _ in range(min(count, room // size)):
            new = np.zeros_like(reach)
            new[size:] = reach[:-size]
            new &= ~reach
            if not new.any():
                break
            parent[new] = g
            reach |= new
        if reach[room]:
            break
    at, out = int(np.flatnonzero(reach)[-1]), []
    while at:
        out.append(int(parent[at]))
        at -= sizes[out[-1]]
    return out


def plan_packing(counts: dict[int, int], capacity: int = 2048, groups: int = 512, small: float = 0.25) -> tuple[pd.DataFrame, int]:
    """Runs (length, rank, n, per_bin, sequence, offset) and the number of sequences.

    A run says: of the documents of this length, those of rank ``rank`` to ``rank + n - 1`` go
    ``per_bin`` at a time, side by side from ``offset`` on, to ``sequence`` and the ones after it.
    ``groups``: rounded sizes at most; ``small``: lengths up to this share of the capacity are small.
    """
    if any(x < 1 or x > capacity for x in counts):
        raise ValueError("lengths lie between 1 and the capacity")
    runs: list[tuple[int, int, int, int, int, int]] = []
    used: dict[int, int] = defaultdict(int)  # ranks given out, by length
    free: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room left -> (first sequence, how many)
    rooms: list[int] = []
    made = 0

    def leave(room: int, first: int, n: int) -> None:
        if n and room:
            if not free[room]:
                insort(rooms, room)
            free[room].append((first, n))

    # large lengths, in groups of as many documents each; lengths are cut between groups
    large = sorted(((x, n) for x, n in counts.items() if n and x > small * capacity), reverse=True)
    per = -(-sum(n for _, n in large) // groups) if large else 0
    grouped: list[list[list[int]]] = []
    held = per
    for x, n in large:
        while n:
            if held == per:
                grouped.append([])
                held = 0
            take = min(n, per - held)
            grouped[-1].append([x, take])
            n, held = n - take, held + take
    sizes = [g[0][0] for g in grouped]  # rounded up to the largest of the group
    left = [sum(n for _, n in g) for g in grouped]
    for g in range(len(grouped)):
        while left[g]:
            avail = list(left)
            avail[g] -= 1
            pattern = [g, *_best_fill(capacity - sizes[g], sizes[g:], avail[g:])]
            pattern = [g, *(g + k for k in pattern[1:])]
            each = {k: pattern.count(k) for k in pattern}
            times = min(left[k] // n for k, n in each.items())
            # actual documents take the places; the composition is the same between two borders
            slots, borders = [], {0, times}
            for k in sorted(pattern):
                slot, at = [], 0
                while at < times:
                    x, n = grouped[k][0]
                    take = min(n, times - at)
                    slot.append((at, x, take))
                    at += take
                    borders.add(at)
                    grouped[k][0][1] -= take
                    if not grouped[k][0][1]:
                        grouped[k].pop(0)
                slots.append(slot)
                left[k] -= times
            total = np.zeros(times if len(borders) < 2 else len(borders) - 1, dtype=np.int64)
            edges = sorted(borders)
            for slot in slots:
                for at, x, n in slot:
                    i, j = bisect_left(edges, at), bisect_left(edges, at + n)
                    for k in range(i, j):
                        runs.append((x, used[x], edges[k + 1] - edges[k], 1, made + edges[k], int(total[k])))
                        used[x] += edges[k + 1] - edges[k]
                        total[k] += x
            for k in range(len(edges) - 1):
                leave(capacity - int(total[k]), made + edges[k], edges[k + 1] - edges[k])
            made += times
    # small lengths: the smallest room that holds them, again and again
    for x, n in sorted(((x, n) for x, n in counts.items() if n and x <= small * capacity), reverse=True):
        while n:
            i = bisect_left(rooms, x)
            if i == len(rooms):
                fresh = -(-n // (capacity // x))
                leave(capacity, made, fresh)
                made += fresh
                continue
            room = rooms[i]
            first, bins = free[room].pop()
            if not free[room]:
                rooms.pop(i)
            t = room // x
            full = min(bins, n // t)
            if full:
                runs.append((x, used[x], full * t, t, first, capacity - room))
                used[x], n = used[x] + full * t, n - full * t
                leave(room - t * x, first, full)
            if full < bins:
                rest = bins - full
                if n:  # fewer than t, into one sequence
                    runs.append((x, used[x], n, n, first + full, capacity - room))
                    used[x] += n
                    leave(room - n * x, first + full, 1)
                    n, rest = 0, rest - 1
                leave(room, first + bins - rest, rest)
    out = pd.DataFrame(runs, columns=["length", "rank", "n", "per_bin", "sequence", "offset"], dtype="int64")
    return out.sort_values(["length", "rank"], ignore_index=True), made


def token_pieces(docs: DataFrame, id_col: str, text_col: str, vocabulary: str, leading_blank: bool, end_id: int, capacity: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of each document's ids with ``end_id`` after them, cut only beyond capacity."""

    def run(batches):
        enc = encoder(vocabulary, leading_blank)
        for batch in batches:
            rows: list[tuple] = []
            ids, texts = batch.column(0), batch.column(1)
            for at in range(0, batch.num_rows, 256):
                part = [x or "" for x in texts.slice(at, 256).to_pylist()]
                for doc, got in zip(ids.slice(at, 256).to_pylist(), enc.encode(part), strict=True):
                    whole = np.append(got, end_id).astype("<u4")
                    for k, start in enumerate(range(0, len(whole), capacity)):
                        own = whole[start : start + capacity]
                        rows.append((doc, k, start, len(own), zlib.crc32(own.tobytes())))
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[2:])],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def place_pieces(pieces: DataFrame, capacity: int = 2048, groups: int = 512) -> DataFrame:
    """``pieces`` (doc_id, piece, length and more) with sequence_id and offset."""
    spark = pieces.sparkSession
    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "piece"))
    rows = pieces.withColumn("_key", key).select("*", F.substring("_key", 1, 2).alias("_b1"), F.substring("_key", 1, 4).alias("_b2"))
    fine = rows.groupBy("length", "_b1", "_b2").agg(F.count(F.lit(1)).alias("_n"))
    coarse = fine.groupBy("length", "_b1").agg(F.sum("_n").alias("_n"))
    counts = {int(r["length"]): int(r["n"]) for r in coarse.groupBy("length").agg(F.sum("_n").alias("n")).collect()}  # at most capacity rows
    plan, _ = plan_packing(counts, capacity, groups)

    def ahead(of: list[str], order: str):
        w = Window.partitionBy(*of).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_n").over(w), F.lit(0))

    first = coarse.select("length", "_b1", ahead(["length"], "_b1").alias("_a1"))
    second = fine.select("length", "_b1", "_b2", ahead(["length", "_b1"], "_b2").alias("_a2")).join(first, ["length", "_b1"])
    within = F.row_number().over(Window.partitionBy("length", "_b2").orderBy("_key", "doc_id", "piece", "ids_crc32"))
    ranked = rows.withColumn("_r", within - 1).drop("_b1").join(second.drop("_b1"), ["length", "_b2"]).withColumn("_rank", F.col("_a1") + F.col("_a2") + F.col("_r"))
    shared = spark.sparkContext.broadcast({c: plan[c].to_numpy() for c in plan.columns})

    def run(frames):
        p = shared.value
        code = p["length"] * (1 << 48) + p["rank"]
        for f in frames:
            x, r = f["length"].to_numpy(), f["_rank"].to_numpy()
            i = np.searchsorted(code, x * (1 << 48) + r, side="right") - 1
            k = r - p["rank"][i]
            f["sequence_id"] = p["sequence"][i] + k // p["per_bin"][i]
            f["offset"] = p["offset"][i] + k % p["per_bin"][i] * x
            yield f[[*names, "sequence_id", "offset"]]

    names = [f.name for f in pieces.schema]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.select(*names, "_rank").mapInPandas(run, f"{schema}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 2048,
    vocabulary: str | None = None,
    leading_blank: bool = False,
    end_id: int = 0,
    groups: int = 512,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are one end id. Documents longer than the capacity, and only those, are cut
    into pieces of the capacity and a rest. Repeated rows are packed each; null ids stay null. No
    rows give no rows. Other columns are not read. Integer columns of this result are never null
    but for doc_id.
    """
    ship(docs.sparkSession)
    pieces = token_pieces(docs, id_col, text_col, vocabulary or vocabulary_path("word_bpe_49k.json"), leading_blank, end_id, capacity)
    return place_pieces(cut(pieces), capacity, groups)
