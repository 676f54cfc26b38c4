"""Toxicity and language model: held-out accuracy, brute force, edge cases."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotlattice.llm import lm, toxicity
from spotlattice.llm.bytewords import LETTERS, Words

BAD = ["vilest", "grubwort", "slagface"]


def corpus(n, seed=0):
    r = random.Random(seed)
    syl = ["ba", "ne", "lo", "ti", "ra", "mo", "su", "ki"]
    out = []
    for i in range(n):
        words = ["".join(r.choices(syl, k=r.randint(1, 3))) for _ in range(r.randint(5, 60))]
        toxic = int(r.random() < 0.3)
        if toxic:
            for _ in range(r.randint(1, 3)):
                words.insert(r.randint(0, len(words)), r.choice(BAD) + r.choice(["", "ed", "ish"]))
        out.append((i, " ".join(words), r.choice(["aa", "bb", None]), toxic))
    return out


def test_words_agree_with_a_pattern():
    texts = ["", "A b\tC", "x" * 50 + " y", "é É\x00z", "\n a"]
    w = Words([t.encode() for t in texts] + [None])
    by = {}
    for i, t in enumerate(texts):
        own = [x.translate({c: c + 32 for c in range(65, 91)}) for x in re.findall(r"[^\x20\x09-\x0D]+", t)]
        assert len(own) == w.begin[i + 1] - w.begin[i]
        for word, h in zip(own, w.hash[w.begin[i] : w.begin[i + 1]], strict=True):
            assert by.setdefault(word, h) == h
    assert len(set(by.values())) == len(by)
    upper, lower = Words(["É".encode()], LETTERS, fold_latin=True), Words(["é".encode()], LETTERS, fold_latin=True)
    assert upper.hash[0] == lower.hash[0]


def test_toxicity_held_out(spark):
    data = corpus(1500)
    docs = spark.createDataFrame([(i, t, x, 9.0, "c") for i, t, x, _ in data], "doc_id long, text string, lang string, score double, k string")
    labels = spark.createDataFrame([(i, y) for i, _, _, y in data if i % 5], "doc_id long, toxic int")
    model = toxicity.learn(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, model).withColumn("no", toxicity.rejected(model)).collect()}
    held = [x for x in data if x[0] % 5 == 0]
    assert sum((got[i].score >= 0.5) == bool(y) for i, _, _, y in held) / len(held) > 0.97
    assert sum(got[i].no == bool(y) for i, _, _, y in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 and r.k == "c" for r in got.values())
    again = toxicity.learn(docs.repartition(3), labels.repartition(2))
    assert np.allclose(again.out, model.out)


def test_toxicity_thresholds_cover_all_labelled_rows(spark):
    """Bounded samples leave most rows out and mix the labels otherwise than they occur; thresholds are the best of the whole."""
    data = [(i, t if i % 7 else t + " vilest", x, y) for i, t, x, y in corpus(1500, 4)]  # clean rows look toxic now and then
    docs = spark.createDataFrame([(i, t, x) for i, t, x, _ in data], "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame([(i, y) for i, _, _, y in data], "doc_id long, toxic int")
    seen = []
    whole = toxicity.calibrate
    with pytest.MonkeyPatch.context() as m:
        m.setattr(toxicity, "calibrate", lambda model, counts, **k: seen.append(counts) or whole(model, counts, **k))
        model = toxicity.learn(docs, labels, positives=100, negatives=50)
    c = seen[0]
    assert c["n"].sum() == len(data) and c[c["place"].isna()]["n"].sum() <= 150
    for lang in ("aa", "bb", None):
        own = c[c["lang"].isna() if lang is None else c["lang"] == lang]
        assert [own[own["toxic"] == v]["n"].sum() for v in (0, 1)] == [sum(x == lang and y == v for _, _, x, y in data) for v in (0, 1)]
    assert set(model.thresholds) == {"aa", "bb"}
    s = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    wrong = lambda t: sum((s[i] >= t) != bool(y) for i, _, x, y in data if x == "aa")
    assert wrong(model.thresholds["aa"]) <= min(map(wrong, toxicity.TRIED)) + 8


def test_toxicity_weighs_labels_as_they_occur():
    data = corpus(900, 5)
    y = np.array([r[3] for r in data])
    texts = [t.encode() if i % 3 else b"neither here nor there" for i, (_, t, _, _) in enumerate(data)]
    mean = lambda share: float(toxicity.fit(texts, y, share=share).scores([b"neither here nor there"])[0])
    assert mean(0.05) < 0.12 < 0.2 < mean(None) and abs(mean(float(y.mean())) - mean(None)) < 0.02


def test_toxicity_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, None), (2, "", "x"), (2, "", "x"), (None, "a " * 100_000, "y")], "doc_id long, text string, lang string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.learn(docs, none)
    got = toxicity.score(docs, model).collect()
    assert len(got) == 4 and all(0 <= r.score < 0.5 for r in got)
    assert toxicity.score(docs.limit(0), model).count() == 0
    odd = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 7)], "doc_id long, toxic int")
    assert toxicity.score(docs, toxicity.learn(docs, odd)).count() == 4


def brute(data, train):
    tokens = [[x.translate({c: c + 32 for c in range(65, 91)}) for x in re.findall(r"[^\x20\x09-\x0D]+", t or "")] + ["\0end"] for _, t in data]
    c = Counter(w for x, (i, _) in zip(tokens, data, strict=True) if train(i) for w in x)
    n, v = sum(c.values()), len(c)
    return [(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in x), len(x), sum(c[w] > 0 for w in x), n) for x in tokens]


@pytest.mark.parametrize("case", ["plain", "edge", "untrained"])
def test_lm_base_scores(spark, case):
    data = {
        "plain": [(i, t) for i, t, _, _ in corpus(200)],
        "edge": [(1, None), (2, ""), (2, ""), (None, "A a \x0b b"), (5, "w " * 50_000), (6, "é É ÀB"), (8, " \n")],
        "untrained": [(1, "a b"), (2, None)],
    }[case]
    docs = spark.createDataFrame([(i, t, "x", 0.0) for i, t in data], "doc_id long, text string, h string, score double").repartition(3)
    train = (lambda i: False) if case == "untrained" else (lambda i: i is not None and i % 7 != 2)
    flag = F.lit(False) if case == "untrained" else F.col("doc_id") % 7 != 2
    got = sorted(lm.score_texts(docs, flag).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0, r.n_tokens))
    want = [(d, *b) for d, b in sorted(zip(data, brute(data, train), strict=True), key=lambda x: (x[0][0] is None, x[0][0] or 0, x[1][1]))]
    assert len(got) == len(want)
    for r, (d, base, n, known, total) in zip(got, want, strict=True):
        assert r.doc_id == d[0] and r.n_tokens == n and r.n_known == known and r.train_tokens == total
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base)) and r.score <= 1e-6
    assert lm.score_texts(docs.limit(0), F.lit(True)).count() == 0


def test_lm_learns_context(spark):
    r = random.Random(3)
    words = {"a": [f"a{i}" for i in range(30)], "b": [f"b{i}" for i in range(30)]}
    data = [(i, " ".join(r.choices(words[r.choice("ab")], k=80))) for i in range(600)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(2)
    got = [x for x in lm.score_texts(docs, F.col("doc_id") % 7 != 2, rounds=4).collect() if x.doc_id % 7 == 2]
    assert sum(x.score for x in got) > sum(x.base_score for x in got) + 0.1 * sum(x.n_tokens for x in got)


def test_lm_is_normalised():
    w = lm.Weights.start(np.full(lm.SYMBOLS, 1 / lm.SYMBOLS), 5)
    t = lm.Tables.of(w)
    for one, two in ((0, 0), (3, 900), (1023, 17)):
        s = np.arange(lm.SYMBOLS)
        assert abs((10 ** t.log10(s, np.full_like(s, one), np.full_like(s, two))).sum() - 1) < 1e-3
