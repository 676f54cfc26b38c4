"""Recall of approximate neighbours against all pairs, and odd vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from spotlattice.operators import descent


def recall(got, x, k, metric):
    if metric == "cosine":
        x = x / np.sqrt((x * x).sum(1))[:, None]
    d = ((x[:, None] - x[None]) ** 2).sum(2)
    np.fill_diagonal(d, np.inf)
    want = np.argsort(d, axis=1)[:, :k]
    own = {}
    for r in got:
        own.setdefault(r.a, set()).add(r.b)
        assert r.distance == pytest.approx(d[r.a, r.b] / 2 if metric == "cosine" else np.sqrt(d[r.a, r.b]), abs=1e-9)
    return np.mean([len(own[i] & set(want[i].tolist())) / k for i in range(len(x))])


@pytest.mark.parametrize("metric", ["euclidean", "cosine"])
def test_recall(spark, metric):
    r = np.random.default_rng(1)
    centres = r.normal(0, 3, (12, 16))
    x = centres[r.integers(0, 12, 900)] + r.normal(0, 1, (900, 16))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    got = descent.descend(df, 10, metric).collect()
    assert len(got) == 9000 and all(1 <= g["rank"] <= 10 and g.a != g.b for g in got)
    assert recall(got, x, 10, metric) >= 0.9


def test_few_and_odd_vectors(spark):
    rows = [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [float("nan"), 0.0]), (5, [3.0, 0.0]), (6, []), (7, [None, 1.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    got = sorted((g.a, g.b, g["rank"], g.distance) for g in descent.descend(df, 5).collect())
    assert got == [(1, 2, 1, 1.0), (1, 5, 2, 3.0), (2, 1, 1, 1.0), (2, 5, 2, 2.0), (5, 1, 2, 3.0), (5, 2, 1, 2.0)]
    assert descent.descend(df.filter("id = 1"), 5).collect() == []
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(200)], "id long, v array<double>")
    assert {g.distance for g in descent.descend(same, 4, rounds=2).collect()} == {0.0}


def test_only_groups_with_news_fetch_vectors_and_floats_stay_short(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 6)).astype(np.float32)
    vectors = spark.createDataFrame([(i, [float(y) for y in v]) for i, v in enumerate(x)], "id long, v array<float>")
    seen, plain = [], descent._grouped

    def grouped(rows):
        still = rows.groupBy("g").agg(F.count_if("fresh").alias("n")).filter("n = 0").count()
        seen.append((rows.schema["v"].dataType.simpleString(), still))
        return plain(rows)

    monkeypatch.setattr(descent, "_grouped", grouped)
    short = descent.descend(vectors, 6, width=6, settle=0.0, rounds=5).collect()
    assert len(seen) > 2 and set(seen) == {("array<float>", 0)}
    monkeypatch.undo()
    long_ = descent.descend(vectors.select("id", F.col("v").cast("array<double>").alias("v")), 6, width=6, settle=0.0, rounds=5).collect()
    assert sorted(short) == sorted(long_)
