"""Toxicity by a convolutional text classifier, trained in numpy.

A word is the sum of hashed embeddings: two independent hashes of the word and one each of its
first four and five bytes (insults of one stem share them). Filters over one, two and three
neighbouring words are max-pooled over the whole text and feed a logistic output. Only the text
goes in. Thresholds for the decision are set by language on all labelled rows that training left out.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship
from .bytewords import LETTERS, Words, slices
from .tokens import forget

WIDTHS = (1, 2, 3)
#: Thresholds tried for the decision.
TRIED = np.linspace(0.2, 0.8, 61)
#: Bytes of texts that are scored at a time; what they need besides is some thirty times as much.
AT_ONCE = 400_000
SALTS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def features(texts: list[bytes | None], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers (words x 4 tables) and the first word of each text; an empty text has one blank word."""
    parts, sizes = [], []
    mask = np.uint64(buckets - 2)
    for a, b in slices([len(t or b"") for t in texts]):
        w = Words([t if t and t.strip() else None for t in texts[a:b]], LETTERS, prefixes=(4, 5), fold_latin=True)
        cols = [((w.hash * np.uint64(s)) >> np.uint64(20)) % mask for s in SALTS] + [(w.prefix[k] >> np.uint64(11)) % mask for k in (4, 5)]
        got = np.stack(cols, axis=1).astype(np.uint16) + np.uint16(1)
        counts = np.diff(w.begin)
        empty = np.flatnonzero(counts == 0)
        if len(empty):
            got = np.insert(got, w.begin[empty], 0, axis=0)
        parts.append(got)
        sizes.append(np.maximum(counts, 1))
    return np.concatenate(parts), np.concatenate(([0], np.cumsum(np.concatenate(sizes))))


@dataclass
class Model:
    tables: np.ndarray  # 4 x buckets x dims
    filters: list[np.ndarray]  # per width: width x dims x filters
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: float
    thresholds: dict = field(default_factory=dict)
    threshold: float = 0.5

    def embed(self, got: np.ndarray) -> np.ndarray:
        return self.tables[0][got[:, 0]] + self.tables[1][got[:, 1]] + self.tables[2][got[:, 2]] + self.tables[3][got[:, 3]]

    def convolve(self, e: np.ndarray, begin: np.ndarray, width: int) -> np.ndarray:
        """Value of each filter from each word on; words past the end of a text count as zero."""
        w, b = self.filters[width - 1], self.bias[width - 1]
        out = e @ w[0] + b
        ends = begin[1:] - 1
        for j in range(1, width):
            moved = np.zeros_like(out)
            if len(e) > j:
                moved[:-j] = e[j:] @ w[j]
            for k in range(j):
                moved[np.maximum(ends - k, begin[:-1])] = 0
            out += moved
        return out

    def logits(self, got: np.ndarray, begin: np.ndarray) -> np.ndarray:
        e = self.embed(got)
        pooled = [np.maximum(np.maximum.reduceat(self.convolve(e, begin, k), begin[:-1], axis=0), 0) for k in WIDTHS]
        return np.concatenate(pooled, axis=1) @ self.out + self.out_bias

    def long_logit(self, got: np.ndarray, step: int = 1 << 17) -> float:
        """As ``logits`` of one text, a stretch of words at a time; each stretch reads the words that its last filters reach."""
        top = np.zeros(len(self.out), dtype=np.float32)
        for a in range(0, len(got), step):
            e = self.embed(got[a : a + step + WIDTHS[-1] - 1])
            ends = np.array([0, len(e)])
            top = np.maximum(top, np.concatenate([self.convolve(e, ends, k)[:step].max(axis=0) for k in WIDTHS]))
        return float(top @ self.out + self.out_bias)

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        got, begin = features(texts, self.tables.shape[1])
        z = np.array([self.long_logit(got)]) if len(texts) == 1 else self.logits(got, begin)
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))


def scores_of(model: Model, texts: pa.Array) -> np.ndarray:
    """Scores of a column of binary; texts leave the column a run of bounded size at a time."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    return np.concatenate([model.scores(texts.slice(a, b - a).to_pylist()) for a, b in slices(sizes, AT_ONCE)] or [np.zeros(0)])


def _start(got: np.ndarray, begin: np.ndarray, y: np.ndarray, buckets: int, dims: int, filters: int, seed: int) -> Model:
    """Small random weights; the first dimension starts as each bucket's shrunken log odds over the training rows."""
    rng = np.random.default_rng(seed)
    tables = rng.normal(0, 0.02, (4, buckets, dims)).astype(np.float32)
    doc = np.repeat(np.arange(len(y)), np.diff(begin))
    pos, neg = max(1, int(y.sum())), max(1, int((1 - y).sum()))
    for k in range(4):
        seen = np.unique(got[:, k].astype(np.int64) * len(y) + doc)
        bucket, d = seen // len(y), seen % len(y)
        p, n = (np.bincount(bucket[y[d] == v], minlength=buckets).astype(np.float64) for v in (1, 0))
        odds = np.log((p + 0.5) / (pos + 1)) - np.log((n + 0.5) / (neg + 1))
        tables[k, :, 0] += (np.clip(odds, -3, 6) * (p + n) / (p + n + 4) / 4).astype(np.float32)
    w = [rng.normal(0, 0.3, (k, dims, filters)).astype(np.float32) for k in WIDTHS]
    for k in WIDTHS:
        w[k - 1][0, 0, :] += 1
    return Model(tables, w, [np.zeros(filters, np.float32) for _ in WIDTHS], np.full(filters * len(WIDTHS), 0.3, np.float32), -2.0)


def fit(texts: list[bytes | None], labels: np.ndarray, buckets: int = 1 << 16, dims: int = 8, filters: int = 8, epochs: int = 12, batch: int = 32, rate: float = 0.01, seed: int = 7, share: float | None = None) -> Model:
    """Adam on the log loss (``buckets``: up to 65,536); the gradient of max pooling reaches only the words that won.

    ``share``: that of toxic rows among all that these stand for; rows of the two labels weigh accordingly.
    """
    y = np.asarray(labels, dtype=np.float32)
    got, begin = features(texts or [b""], buckets)
    if not len(y):
        begin = begin[:1]
    model = _start(got, begin, y.astype(np.int64), buckets, dims, filters, seed)
    rng = np.random.default_rng(seed)
    dense = [*model.filters, *model.bias, model.out]
    m1, m2 = [np.zeros_like(p) for p in dense], [np.zeros_like(p) for p in dense]
    b1 = b2 = 0.0
    g2 = np.zeros(model.tables.shape[:2], dtype=np.float32)
    step = 0
    sizes = np.diff(begin)
    mine = float(y.mean()) if len(y) else 0.0
    worth = np.where(y == 1, share / mine, (1 - share) / (1 - mine)).astype(np.float32) if share is not None and 0 < mine < 1 else np.ones_like(y)
    for _ in range(epochs if len(y) else 0):
        order = rng.permutation(len(y))
        for at in range(0, len(y), batch):
            own = order[at : at + batch]
            rows = np.concatenate([np.arange(begin[i], begin[i + 1]) for i in own])
            g, bg = got[rows], np.concatenate(([0], np.cumsum(sizes[own])))
            e = model.embed(g)
            wins, pooled = [], []
            for k in WIDTHS:
                z = model.convolve(e, bg, k)
                top = np.stack([z[a:b].argmax(axis=0) + a for a, b in zip(bg[:-1], bg[1:], strict=True)])
                wins.append(top)
                pooled.append(np.maximum(np.take_along_axis(z, top, axis=0), 0))
            x = np.concatenate(pooled, axis=1)
            p = 1 / (1 + np.exp(-np.clip(x @ model.out + model.out_bias, -30, 30)))
            d = ((p - y[own]) * worth[own] / len(own)).astype(np.float32)
            grads_w, grads_b = [], []
            ge = np.zeros_like(e)
            for k, top, z in zip(WIDTHS, wins, pooled, strict=True):
                f = model.filters[k - 1]
                s = d[:, None] * model.out[(k - 1) * filters : k * filters] * (z > 0)
                gw = np.zeros_like(f)
                last = bg[1:][:, None] - 1
                for j in range(k):
                    ok = s * (top + j <= last)
                    place = np.minimum(top + j, last)
                    gw[j] = np.einsum("nf,nfd->df", ok, e[place])
                    np.add.at(ge, place.ravel(), (ok[:, :, None] * f[j].T[None]).reshape(-1, e.shape[1]))
                grads_w.append(gw)
                grads_b.append(s.sum(axis=0))
            step += 1
            fix1, fix2 = 1 - 0.9**step, 1 - 0.999**step
            for i, grad in enumerate([*grads_w, *grads_b, x.T @ d]):
                m1[i] += 0.1 * (grad - m1[i])
                m2[i] += 0.001 * (grad * grad - m2[i])
                dense[i] -= rate * (m1[i] / fix1) / (np.sqrt(m2[i] / fix2) + 1e-8)
            b1, b2 = b1 + 0.1 * (d.sum() - b1), b2 + 0.001 * (d.sum() ** 2 - b2)
            model.out_bias -= rate * (b1 / fix1) / (np.sqrt(b2 / fix2) + 1e-8)
            hit = np.flatnonzero(np.abs(ge).sum(axis=1))
            for k in range(4):  # the tables: one adaptive rate a bucket
                into, move = g[hit, k], ge[hit]
                np.add.at(g2[k], into, (move * move).mean(axis=1))
                np.add.at(model.tables[k], into, -rate * move / (np.sqrt(g2[k][into])[:, None] + 1e-4))
    return model


def calibrate(model: Model, counts: pd.DataFrame, least: int = 20) -> Model:
    """Thresholds by language with the fewest errors, the nearest to 0.5 of equals.

    ``counts``: lang, toxic, place, n: how many labelled rows have a score that reaches ``place`` of
    the ``TRIED`` thresholds; a null place stands for rows that training used. The others of a
    language and label stand for these too. A language with fewer than ``least`` others of either
    label has the threshold of all rows, which is 0.5 if they are too few as well.
    """

    def best(groups: list[pd.DataFrame]) -> float | None:
        errors, others = np.zeros(len(TRIED)), [0, 0]
        for g in groups:
            for v in (0, 1):
                own = g[g["toxic"] == v]
                left = own[own["place"].notna()]
                n = int(left["n"].sum())
                if n:
                    reached = np.cumsum(np.bincount(left["place"].astype(int), left["n"], len(TRIED) + 1)[::-1])[::-1][1:]
                    errors += (n - reached if v else reached) * (own["n"].sum() / n)
                others[v] += n
        if min(others) < least:
            return None
        return float(min(zip(np.round(errors, 6), np.abs(TRIED - 0.5), TRIED, strict=True))[2])

    common = best([counts.assign(lang="")])
    model.threshold = 0.5 if common is None else common
    found = {x: best([g]) for x, g in counts[counts["lang"].notna()].groupby("lang")}
    model.thresholds = {x: t for x, t in found.items() if t is not None}
    return model


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", positives: int = 2000, negatives: int = 3000, most_bytes: int = 64_000_000, seed: int = 7) -> Model:
    """``labels``: id and toxic (0 or 1; null counts as no label, and 1 wins if an id has both).

    A bounded sample trains it, in one task: up to ``positives`` and ``negatives`` ids of the two labels, in
    the order of a hash of the id, and then the texts of these ids alone, one a row id (of rows that
    repeat an id, the smallest by hash of the text), in the order of the hash until they come to
    ``most_bytes``; a text of more than a 64th of that is left to the thresholds. Four in five of them train the model, weighed as the labels of all ids are mixed.
    All other labelled rows are scored, and counts of their scores set the thresholds. Without rows
    of both labels scores are low.
    """
    key = F.xxhash64(F.col(id_col), F.lit(seed))
    marks = labels.filter(F.col("toxic").isin(0, 1) & F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max("toxic").cast("int").alias("toxic")).withColumn("k", key)
    own = [marks.filter(F.col("toxic") == v).orderBy("k", id_col).limit(n) for v, n in ((1, positives), (0, negatives))]
    sample = F.broadcast(own[0].union(own[1]).withColumnRenamed(id_col, "_id"))  # positives + negatives rows at most
    text = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("text")
    found = docs.select(F.col(id_col).alias("_id"), text).join(sample, "_id")
    once = found.filter(F.length("text") <= most_bytes // 64).groupBy("_id", "k", "toxic").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("s")).select("_id", "k", "toxic", "s.text")
    size = F.sum(F.length("text").cast("long")).over(Window.orderBy("k", "_id"))  # positives + negatives rows at most
    share = marks.agg(F.avg("toxic")).first()[0]
    kind = docs.schema[id_col].dataType.simpleString()

    def train(frames):
        got = pd.concat([f for f in frames if len(f)] or [pd.DataFrame(columns=["_id", "k", "toxic", "text"])]).sort_values(["k", "_id"], kind="stable")
        y = got["toxic"].to_numpy(dtype=np.int64)
        aside = (got["k"].to_numpy(dtype=np.int64) // 64 % 5) == 0
        model = fit([bytes(t) for t, a in zip(got["text"], aside, strict=True) if not a], y[~aside], seed=seed, share=share)
        yield pd.DataFrame({"model": [pickle.dumps(model)], "trained": [got["_id"][~aside].tolist()]})

    # in a task, so that the driver holds the model alone; the sample is one partition as it is
    ship(docs.sparkSession)
    sampled = once.withColumn("_upto", size).filter(F.col("_upto") <= most_bytes).drop("_upto").coalesce(1)
    told = sampled.mapInPandas(train, f"model binary, trained array<{kind}>").first()
    model = pickle.loads(told.model) if told else fit([], np.zeros(0), seed=seed, share=share)
    if share is None:
        return model

    # texts stay where they are: scores are joined with the labels
    scored = score(docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")), model, column="_s").select("_id", "lang", "_s")
    place = F.size(F.filter(F.array(*[F.lit(float(t)) for t in TRIED]), lambda t: t <= F.col("_s")))
    used = docs.sparkSession.createDataFrame([(i, True) for i in told.trained] if told else [], f"_id {kind}, used boolean")
    marked = scored.join(marks.select(F.col(id_col).alias("_id"), "toxic"), "_id").join(F.broadcast(used), "_id", "left")
    counts = marked.groupBy("lang", "toxic", F.when(F.col("used").isNull(), place).alias("place")).agg(F.count(F.lit(1)).alias("n"))
    return calibrate(model, counts.toPandas())  # two labels and 62 places a language


def score(docs: DataFrame, model: Model, text_col: str = "text", column: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text in ``column`` (which replaces one of that name).

    Null and empty texts have one blank word and get its score. Row order and other columns stay.
    """
    spark = ship(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c != column]
    given = docs.select(F.encode(F.col(text_col), "UTF-8").alias("_bytes"), *[f"`{c}`" for c in kept])

    def run(batches):
        forget()
        m = shared.value
        for b in batches:
            s = scores_of(m, b.column(0))
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(s, pa.float64())], names=[*kept, column])

    schema = docs.select(*[f"`{c}`" for c in kept]).withColumn(column, F.lit(0.0)).schema
    return given.mapInArrow(run, schema)


def rejected(model: Model, lang_col: str = "lang", column: str = "score"):
    """Whether a scored row is toxic by its language's threshold; unknown and null languages take the common one."""
    at = F.lit(model.threshold)
    for x, t in model.thresholds.items():
        at = F.when(F.col(lang_col) == x, F.lit(t)).otherwise(at)
    return F.col(column) >= at
