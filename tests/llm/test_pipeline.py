"""The corpus pipeline against a brute-force version on a small corpus."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from spotlattice.llm import mixing

from .test_models import BAD, corpus


def test_pipeline(spark, tmp_path):
    r = random.Random(9)
    data = [(i, t, x, f"s{i % 3}", y) for i, t, x, y in corpus(900, 4)]
    long = [" ".join(r.choices("abcdefghijklmnop", k=120)) for _ in range(6)]
    made = 10_000
    planted = {"exact": [], "near": []}
    for t in long:
        data.append((made, t, "aa", "s0", 0))
        data.append((made + 1, t, "bb", "s1", 0))
        words = t.split()
        words[60] = "zz"
        data.append((made + 2, " ".join(words), None, None, 0))
        planted["exact"].append((made, made + 1))
        planted["near"].append((made, made + 2))
        made += 10
    data.append((None, None, None, None, 0))
    docs = spark.createDataFrame([(i, t, x, s, len(t or "")) for i, t, x, s, _ in data], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, y) for i, _, _, _, y in data if i is not None and i < 900], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == corpus_pipeline.COLUMNS
        now.write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = Counter(x.doc_id for x in now.collect())
    toxic = {i for i, t, _, _, _ in data if any(b in (t or "") for b in BAD)}
    assert len(toxic & set(kept["toxicity"])) <= 0.03 * len(toxic)
    clean = {i for i, *_ in data} - toxic
    assert len(clean - set(kept["toxicity"])) <= 0.01 * len(clean)
    for a, b in planted["exact"]:
        assert a in kept["exact_dedup"] and b not in kept["exact_dedup"]
    for a, b in planted["near"]:
        assert a in kept["near_dedup"] and b not in kept["near_dedup"]
    near = spark.read.parquet(f"{tmp_path}/near_dedup")
    taken = {x.doc_id: (x["size"], x.taken) for x in mixing.mix_sources(near).collect()}
    assert kept["mix"] == Counter({i: (1 if n == 0 else -(-t // n)) for i, (n, t) in taken.items() if n == 0 or t})
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    pieces = defaultdict(int)
    for x in out:
        pieces[x.doc_id] += x.piece == 0
    assert pieces == kept["mix"]
    at = defaultdict(int)
    for x in sorted(out, key=lambda x: (x.sequence_id, x.offset)):
        assert x.offset == at[x.sequence_id]
        at[x.sequence_id] += x.length
    assert max(at.values()) <= 2048


def test_entry_without_the_subpackage(monkeypatch):
    import builtins

    import __spark_entry__ as entry

    real = builtins.__import__

    def gone(name, *args, **kw):
        if name == "corpus_pipeline":
            raise ModuleNotFoundError("gone", name="corpus_pipeline")
        return real(name, *args, **kw)

    assert "pipeline" in entry.queries()
    monkeypatch.setattr(builtins, "__import__", gone)
    left = entry.queries()
    assert "pipeline" not in left and not any(k.startswith("op") for k in left) and len(left) > 30


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None)] * 3, [(1, "", "aa", "s", 0), (1, "", "aa", "s", 0), (2, "a b c", None, None, 5)]], ids=["empty", "nulls", "repeats"])
def test_pipeline_on_odd_tables(spark, tmp_path, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("text_sha256", F.lit("clash")).withColumn("class_id", F.lit(1))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == {i for i, *_ in rows[:1] + rows[2:]} and len(got) == len({t or "" for _, t, *_ in rows})
