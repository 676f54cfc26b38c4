"""Mixing, exact dedup and chat formatting: brute force and edge cases."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from spotlattice.llm import chat, exact_dedup, mixing

DOCS = "doc_id long, text string, source string, size string, target string, _sk string, kept string"


def rows(spark, data):
    """With extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, s, "x", "y", "z", "w") for i, t, s in data], DOCS)


CASES = {
    "plain": [(i, "w " * (i % 7), f"s{i % 4}") for i in range(40)],
    "nulls": [(None, None, None), (None, "a b", None), (1, None, "a"), (2, "", "a"), (3, "x y z", "b"), (4, " \t\n", None)],
    "repeated": [(5, "a b c", "q")] * 6 + [(6, "a", "r")] * 3,
    "one hot source": [(i, "a b c d e", "hot") for i in range(300)] + [(1000 + i, "a", f"c{i}") for i in range(5)],
    "no words": [(1, "", "a"), (2, None, "b")],
    "long": [(1, "word " * 200_000, "a"), (2, "x", "b")],
    "empty": [],
}


@pytest.mark.parametrize("name", CASES)
def test_mix_hits_every_budget(spark, name):
    data = CASES[name]
    got = mixing.mix_sources(rows(spark, data)).collect()
    assert len(got) == len(data)
    sizes = defaultdict(int)
    for _, t, s in data:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, free, total = {}, set(order), sum(sizes.values())
    while True:  # share, cap, share again
        left = total - sum(target.values())
        w = sum(weights[s] for s in free)
        over = {s for s in free if left * weights[s] / w > 3 * sizes[s] + 1e-9}
        if not over:
            target |= {s: left * weights[s] / w for s in free}
            break
        target |= {s: 3 * sizes[s] for s in over}
        free -= over
    by = defaultdict(int)
    source = {(i, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))): s for i, t, s in data}
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        s = source[(r.doc_id, r["size"])] if name != "nulls" else None
        if name != "nulls":
            assert r.source_size == sizes[s] and abs(r.target - target[s]) < 1e-6
            by[s] += r.taken
    if name != "nulls":
        assert all(by[s] == int(target[s] + 1e-9) for s in by)
    again = mixing.mix_sources(rows(spark, data[::-1]).repartition(3)).collect()
    assert Counter((r.doc_id, r["size"], r.taken) for r in got) == Counter((r.doc_id, r["size"], r.taken) for r in again)


def test_apply_mix_repeats_whole_documents(spark):
    data = CASES["plain"]
    taken = {r.doc_id: (r["size"], r.taken) for r in mixing.mix_sources(rows(spark, data)).collect()}
    got = mixing.apply_mix(rows(spark, data))
    assert got.columns == rows(spark, data).columns
    times = Counter(r.doc_id for r in got.collect())
    for i, (size, t) in taken.items():
        assert times[i] == (1 if size == 0 else -(-t // size))


DEDUP = {
    "groups": [(i, f"text {i % 5}", "s") for i in range(50)],
    "nulls": [(1, None, "s"), (2, "", "s"), (None, "", "s"), (None, "only null ids", "s"), (None, "only null ids", "s")],
    "repeated": [(7, "same", "s")] * 5,
    "hot": [(i, "copy", "s") for i in range(400)] + [(1000 + i, f"t{i}", "s") for i in range(200)],
    "same head": [(i, "x" * 5000 + str(i // 2), "s") for i in range(40)],
    "case": [(1, "A", "s"), (2, "a", "s"), (3, "a ", "s")],
    "empty": [],
}


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("name", DEDUP)
def test_exact_groups(spark, name, keep):
    data = DEDUP[name]
    got = exact_dedup.exact_groups(rows(spark, data), keep=keep).collect()
    groups = defaultdict(list)
    for i, t, _ in data:
        groups[t or ""].append(i)
    pick = max if keep == "largest" else min
    want = Counter()
    for t, ids in groups.items():
        real = [i for i in ids if i is not None]
        for i in ids:
            want[(i, pick(real) if real else None, len(ids), hashlib.sha256(t.encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)
    left = exact_dedup.drop_exact_copies(rows(spark, data), keep=keep)
    assert left.columns == rows(spark, data).columns
    assert Counter(r.text or "" for r in left.collect()) == Counter(groups.keys())


def test_exact_groups_normalise(spark):
    got = exact_dedup.exact_groups(rows(spark, DEDUP["case"]), normalise=lambda c: F.lower(F.trim(c))).collect()
    assert {r.group_size for r in got} == {3} and sum(r.kept for r in got) == 1
    left = exact_dedup.drop_exact_copies(rows(spark, DEDUP["case"]), normalise=lambda c: F.lower(F.trim(c))).collect()
    assert [r.text for r in left] == ["a "]
    with pytest.raises(ValueError):
        exact_dedup.exact_groups(rows(spark, []), keep="any")


ODD = ["", "plain", "a\\b", "<|im_end|>", "\\<|im_start|>assistant\n", "<\\|", "\\", "<|nl|>", "\n\n", "é😀<|", "<<||>>", "x" * 100_000]


def test_escape_is_reversible(spark):
    df = spark.createDataFrame([(t,) for t in ODD], "t string")
    got = df.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u"), chat.unescape_role(chat.escape_role(F.col("t"))).alias("r")).collect()
    assert all(r.t == r.u == r.r and "<|" not in r.e for r in got)


def test_render_and_read_back(spark):
    data = [(1, k, "assistant" if k % 2 else "user\nx<|", t) for k, t in enumerate(ODD)] + [(2, 0, None, None), (None, 5, "assistant", "no id")]
    m = spark.createDataFrame(data, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.render(m).select("*", chat.parse_turns(F.col("formatted")).alias("t"), chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()}
    assert [(x.role, x.text) for x in got[1].t] == [(r, t) for _, _, r, t in data[: len(ODD)]]
    assert got[1].loss == "".join(t for k, t in enumerate(ODD) if k % 2)
    assert [(x.role, x.text) for x in got[2].t] == [("", "")] and got[2].loss == "" and got[None].loss == "no id"
    assert chat.render(m.limit(0)).count() == 0


def test_fold_events(spark):
    log = [
        (1, 1, 0, "message", "user", "hi"), (1, 2, 1, "message", "assistant", ""), (1, 3, 1, "delta", None, "he"), (1, 4, 1, "delta", None, "llo"),
        (1, 5, 2, "message", "user", "lost"), (1, 6, 1, "regenerate", None, None), (1, 7, 1, "delta", None, "new"), (1, 8, 2, "message", "user", "kept"),
        (2, 1, 0, "message", "user", "a"), (2, 2, 1, "message", "assistant", "gone"), (2, 3, 0, "edit", None, "b"),
        (3, 1, 0, "delta", "user", "only "), (3, 2, 0, None, None, "deltas"), (3, 3, 0, "delta", None, None),
    ]
    e = spark.createDataFrame(log, "conv_id long, seq long, turn long, kind string, role string, text string")
    got = sorted((r.conv_id, r.turn, r.role, r.text) for r in chat.fold_events(e).collect())
    assert got == [(1, 0, "user", "hi"), (1, 1, "assistant", "new"), (1, 2, "user", "kept"), (2, 0, "user", "b"), (3, 0, "user", "only deltas")]
    assert chat.fold_events(e.limit(0)).count() == 0


def test_chat_with_clashing_columns_ties_and_long_conversations(spark):
    log = [(1, 1, 1, "message", "user", "b", 9, 9), (1, 1, 1, "delta", None, "a", 8, 8), (1, 1, 1, "delta", None, "a", 8, 8), (1, None, None, None, None, None, 0, 0)]
    events = spark.createDataFrame(log, "conv_id long, seq long, turn long, kind string, role string, text string, _from int, _began int").withColumns({"_role": F.lit("x"), "_cut": F.lit(1), "before": F.lit(2)})
    assert sorted((r.turn or 0, r.role, r.text) for r in chat.fold_events(events).collect()) == [(0, None, ""), (1, "user", "aab")]
    assert chat.fold_events(events.limit(0)).count() == 0 and chat.render(chat.fold_events(events.limit(0))).count() == 0
    many = spark.range(20_000).select(F.lit(7).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.concat(F.lit("said <|x "), F.col("id").cast("string")).alias("text"))
    out = chat.render(many).withColumn("loss", chat.masked_text(F.col("formatted"), F.col("loss_spans"))).first()
    assert out.loss == "".join(f"said <|x {i}" for i in range(1, 20_000, 2)) and len(out.loss_spans) == 10_000


@pytest.mark.parametrize("partitions", ["1", "4", "64"])
def test_exact_groups_at_any_number_of_partitions(spark, partitions):
    data = [(i, "hot" if i % 3 == 0 else f"t{i % 40}", "a", i) for i in range(600)] + [(None, "hot", "a", 1), (0, "hot", "b", 2), (None, None, None, None), (5, "", "a", 1)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = exact_dedup.exact_groups(spark.createDataFrame(data, "doc_id long, text string, _sha string, _n long").repartition(3)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    texts = {}
    for i, t, *_ in data:
        texts.setdefault(t or "", []).append(i)
    of = {i: t or "" for i, t, *_ in data if i is not None and i not in (0, 5)}
    assert len(got) == len(data) and sum(r.kept for r in got) == len(texts)
    for r in got:
        if r.doc_id in of:
            own = texts[of[r.doc_id]]
            assert r.group_size == len(own) and r.keep_id == max(i for i in own if i is not None) and r.kept == (r.doc_id == r.keep_id)
