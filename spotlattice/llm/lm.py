"""LM scoring: exact unigram statistics and a log-bilinear neural model trained with noise-contrastive estimation.

Counts of all words of all training texts stay distributed. A dictionary of the most frequent ones
(a fixed number) goes to every task; only words outside it are joined with the full counts. The
neural model predicts one of 1,024 symbols (end of text, the most frequent words, and 64 classes
for all others) from the two symbols before; a word of a class then has its add-one share of the
class. Training passes over all training texts where they lie: each partition trains on its own
words from common weights, and the weights are averaged in a tree. Normalisers of all pairs of
symbols come from batched matrix products, so token probabilities sum to one.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship
from .bytewords import Words, runs_of
from .storage import cut

SYMBOLS, CLASSES = 1024, 64
HEAD = SYMBOLS - CLASSES  # symbol 0 is the end of a text
DIMS, NOISE, BATCH = 24, 32, 1024
#: Words of one text that are looked up and scored at a time.
STRETCH = 1 << 20


def _classes(w: Words) -> np.ndarray:
    return ((w.lead[0].astype(np.int16) * 31 + w.lead[1]) % CLASSES).astype(np.int16)


def _as_long(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def word_counts(texts: DataFrame, most: int = 2_000_000) -> DataFrame:
    """h, cls, c of every word of ``texts`` (binary column text); tasks add up before the shuffle, ``most`` words at a time."""

    def run(batches):
        held: list[tuple] = []
        n = 0

        def merged():
            h, cls, c = (np.concatenate(x) for x in zip(*held, strict=True))
            keys, first, inverse = np.unique(h, return_index=True, return_inverse=True)
            return keys, cls[first], np.bincount(inverse, weights=c, minlength=len(keys)).astype(np.int64)

        def out(part):
            return pa.RecordBatch.from_arrays([pa.array(part[0]), pa.array(part[1].astype(np.int32)), pa.array(part[2])], names=["h", "cls", "c"])

        for b in batches:
            for _, t in runs_of(b.column(0)):
                w = Words(t)
                if not w.n:
                    continue
                keys, first, c = np.unique(_as_long(w.hash), return_index=True, return_counts=True)
                held.append((keys, _classes(w)[first], c))
                n += len(keys)
                if n >= most:
                    held = [merged()]
                    n = len(held[0][0])
                    if n >= most // 2:
                        yield out(held[0])
                        held, n = [], 0
        if held:
            yield out(merged())

    return texts.mapInArrow(run, "h long, cls int, c long").groupBy("h").agg(F.min("cls").alias("cls"), F.sum("c").alias("c"))


@dataclass
class Dictionary:
    """The most frequent words in the order of their hashes, and the totals of the corpus."""

    h: np.ndarray
    c: np.ndarray
    symbol: np.ndarray
    head: np.ndarray  # hashes of the words that are symbols, in order
    head_symbol: np.ndarray
    unigram: np.ndarray  # share of each symbol, smoothed
    class_log: np.ndarray  # log10 of words + distinct words + 1 of each class
    end_count: int
    tokens: int
    distinct: int


def build_dictionary(counts: DataFrame, n_texts: int, size: int = 1 << 19) -> Dictionary:
    """``counts`` is read a few times; at most ``size`` words come to the driver."""
    per = 8
    level = F.floor(F.log2(F.col("c").cast("double")) * per).cast("int")
    bins = counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("level")).collect()  # at most 64 * per rows
    least, total = None, 0
    for r in bins:
        total += r["n"]
        if total > size:
            break
        least = r["level"]
    top = counts.filter(level >= least) if least is not None else counts.limit(0)
    got = top.toPandas().sort_values(["c", "h"], ascending=[False, True])
    per_class = counts.groupBy("cls").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).toPandas()  # one row a class
    h, c, cls = (got[x].to_numpy(dtype=np.int64) for x in ("h", "c", "cls"))
    n_head = min(HEAD - 1, len(h))
    symbol = np.where(np.arange(len(h)) < n_head, np.arange(len(h)) + 1, HEAD + cls)
    class_n, class_v = np.zeros(CLASSES), np.zeros(CLASSES)
    class_n[per_class["cls"].to_numpy(dtype=np.int64)] = per_class["n"]
    class_v[per_class["cls"].to_numpy(dtype=np.int64)] = per_class["v"]
    tokens, distinct = int(class_n.sum()) + n_texts, int(class_v.sum()) + (n_texts > 0)
    np.subtract.at(class_n, cls[:n_head], c[:n_head])
    np.subtract.at(class_v, cls[:n_head], 1)
    share = np.zeros(SYMBOLS)
    share[0] = n_texts
    share[1 : n_head + 1] = c[:n_head]
    share[HEAD:] = class_n
    share = (share + 0.5) / (share + 0.5).sum()
    order = np.argsort(h)
    own = np.argsort(h[:n_head])
    return Dictionary(h[order], c[order], symbol[order], h[:n_head][own], symbol[:n_head][own], share, np.log10(class_n + class_v + 1), n_texts, tokens, distinct)


def _symbols(w: Words, d: Dictionary) -> np.ndarray:
    """Symbol of each word, in 16 bits."""
    out = HEAD + _classes(w)
    if len(d.head):
        for a in range(0, w.n, STRETCH):
            h = _as_long(w.hash[a : a + STRETCH])
            at = np.minimum(np.searchsorted(d.head, h), len(d.head) - 1)
            out[a : a + STRETCH] = np.where(d.head[at] == h, d.head_symbol[at], out[a : a + STRETCH])
    return out


def _stream(w: Words, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of whole texts with their ends, and the one and two symbols before each (the end where there is none)."""
    texts = len(w.begin) - 1
    s = np.zeros(w.n + texts, dtype=np.int16)
    s[np.delete(np.arange(w.n + texts, dtype=np.int32), w.begin[1:] + np.arange(texts))] = symbols
    one = np.concatenate((np.zeros(1, np.int16), s[:-1])) if len(s) else s
    two = np.concatenate((np.zeros(2, np.int16), s[:-2]))[: len(s)]
    two[w.begin[:-1] + np.arange(texts)] = 0
    return s, one, two


@dataclass
class Weights:
    context: np.ndarray  # symbols x dims
    target: np.ndarray  # symbols x dims
    bias: np.ndarray
    near: np.ndarray  # dims x dims, for the symbol before
    far: np.ndarray  # for the one before that

    def parts(self) -> list[np.ndarray]:
        return [self.context, self.target, self.bias, self.near, self.far]

    def pack(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()]).astype(np.float32)

    @classmethod
    def unpack(cls, flat: np.ndarray) -> Weights:
        shapes = [(SYMBOLS, DIMS), (SYMBOLS, DIMS), (SYMBOLS,), (DIMS, DIMS), (DIMS, DIMS)]
        cuts = np.cumsum([int(np.prod(s)) for s in shapes])[:-1]
        return cls(*(p.reshape(s).astype(np.float32) for p, s in zip(np.split(np.asarray(flat), cuts), shapes, strict=True)))

    @classmethod
    def start(cls, unigram: np.ndarray, seed: int) -> Weights:
        """Small random vectors; the bias starts as the unigram model."""
        rng = np.random.default_rng(seed)
        small = lambda *s: rng.normal(0, 0.1, s).astype(np.float32)
        return cls(small(SYMBOLS, DIMS), small(SYMBOLS, DIMS), np.log(unigram).astype(np.float32), np.eye(DIMS, dtype=np.float32), np.eye(DIMS, dtype=np.float32) * 0.5)


def _scatter(rows: int, at: np.ndarray, values: np.ndarray) -> np.ndarray:
    order = np.argsort(at.astype(np.int16), kind="stable")  # 16 bits are sorted by radix
    own = at[order]
    first = np.flatnonzero(np.diff(own, prepend=-1))
    out = np.zeros((rows, *values.shape[1:]), dtype=np.float32)
    out[own[first]] = np.add.reduceat(values[order], first, axis=0)
    return out


class Trainer:
    """Noise-contrastive estimation with one noise sample a batch and adaptive rates."""

    def __init__(self, weights: Weights, unigram: np.ndarray, seed: int, rate: float = 0.2):
        self.w, self.rate, self.rng, self.seen = weights, rate, np.random.default_rng(seed), 0
        self.edges = np.cumsum(unigram)
        self.shift = (np.log(NOISE) + np.log(unigram)).astype(np.float32)
        self.square = [np.full_like(p, 1e-3) for p in weights.parts()]

    def train(self, s: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        for a in range(0, len(s), STRETCH):
            order = a + self.rng.permutation(min(STRETCH, len(s) - a))
            for at in range(0, len(order), BATCH):
                own = order[at : at + BATCH]
                self._step(s[own].astype(np.int64), one[own].astype(np.int64), two[own].astype(np.int64))
        self.seen += len(s)

    def _step(self, s, one, two) -> None:
        w = self.w
        noise = np.minimum(np.searchsorted(self.edges, self.rng.random(NOISE)), SYMBOLS - 1)
        r1, r2, q, qn = w.context[one], w.context[two], w.target[s], w.target[noise]
        guess = r1 @ w.near + r2 @ w.far
        up = 1 / (1 + np.exp(np.clip((guess * q).sum(axis=1) + w.bias[s] - self.shift[s], -30, 30)))
        down = -1 / (1 + np.exp(-np.clip(guess @ qn.T + w.bias[noise] - self.shift[noise], -30, 30)))
        back = up[:, None] * q + down @ qn
        grads = [
            _scatter(SYMBOLS, np.concatenate([one, two]), np.concatenate([back @ w.near.T, back @ w.far.T])),
            _scatter(SYMBOLS, np.concatenate([s, noise]), np.concatenate([up[:, None] * guess, down.T @ guess])),
            (np.bincount(s, up, SYMBOLS) + np.bincount(noise, down.sum(axis=0), SYMBOLS)).astype(np.float32),
            r1.T @ back,
            r2.T @ back,
        ]
        for p, g, h in zip(w.parts(), grads, self.square, strict=True):
            g /= len(s)
            h += g * g
            p += self.rate * g / np.sqrt(h)


def train(texts: DataFrame, d: Dictionary, rounds: int = 2, fan_in: int = 32, seed: int = 11) -> Weights:
    """``rounds`` passes over all ``texts``; partitions start each from the weights averaged before."""
    spark = texts.sparkSession
    weights = Weights.start(d.unigram, seed)
    shared_d = spark.sparkContext.broadcast(d)

    def average(f: pd.DataFrame) -> pd.DataFrame:
        n = f["n"].to_numpy(dtype=np.float64)
        flat = sum(np.frombuffer(w, np.float32).astype(np.float64) * k for w, k in zip(f["w"], n, strict=True)) / max(n.sum(), 1)
        return pd.DataFrame({"p": [int(f["p"].min()) // fan_in], "n": [int(n.sum())], "w": [flat.astype(np.float32).tobytes()]})

    for r in range(rounds):
        shared_w = spark.sparkContext.broadcast(weights.pack())

        def run(batches, r=r, shared_w=shared_w):
            p = TaskContext.get().partitionId()
            own = Trainer(Weights.unpack(shared_w.value), shared_d.value.unigram, seed * 1_000_003 + r * 7919 + p)
            for b in batches:
                for _, t in runs_of(b.column(0)):
                    w = Words(t)
                    own.train(*_stream(w, _symbols(w, shared_d.value)))
            if own.seen:
                yield pa.RecordBatch.from_pydict({"p": [p], "n": [own.seen], "w": [own.w.pack().tobytes()]}, schema=pa.schema([("p", pa.int64()), ("n", pa.int64()), ("w", pa.binary())]))

        parts = texts.mapInArrow(run, "p long, n long, w binary")
        left = texts.rdd.getNumPartitions()
        while True:  # a tree: every task adds up to fan_in sets of weights
            parts = parts.groupBy(F.floor(F.col("p") / fan_in).alias("g")).applyInPandas(average, "p long, n long, w binary")
            left = -(-left // fan_in)
            if left <= 1:
                break
        got = parts.toPandas()  # one row
        if len(got):
            weights = Weights.unpack(np.frombuffer(got["w"][0], np.float32))
    return weights


@dataclass
class Tables:
    """What scoring a token takes: bilinear terms by pair of symbols, and the normaliser by pair of symbols before."""

    near: np.ndarray
    far: np.ndarray
    norm: np.ndarray

    @classmethod
    def of(cls, w: Weights) -> Tables:
        near, far = w.context @ w.near @ w.target.T, w.context @ w.far @ w.target.T
        near += w.bias
        first = np.exp(near - near.max(axis=1, keepdims=True))
        second = np.exp(far - far.max(axis=1, keepdims=True))
        norm = np.log(first @ second.T) + near.max(axis=1, keepdims=True) + far.max(axis=1)[None, :]  # all pairs of contexts at once
        return cls(near.astype(np.float32), far.astype(np.float32), norm.astype(np.float32))

    def log10(self, s: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return (self.near[one, s].astype(np.float64) + self.far[two, s] - self.norm[one, two]) / np.log(10)


def score_texts(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", rounds: int = 2) -> DataFrame:
    """One row per input row: id, n_tokens, n_known, train_tokens, base_score, score (log10).

    Learns from the rows where ``training`` is true (null: it is not). Words are what lies between
    ASCII white space, A-Z in lower case, and every text has one end token more. Null and empty
    texts are one end token. base_score is the add-one unigram model; score is the neural model's.
    Without training rows all counts are 0. Repeated rows are scored each. No rows give no rows.
    """
    spark = ship(docs.sparkSession)
    rows = docs.select(F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("text"), F.col(id_col).alias("_id"), F.coalesce(training, F.lit(False)).alias("_train"))
    texts = rows.filter("_train").select("text")
    counts = cut(word_counts(texts))
    d = build_dictionary(counts, texts.count())
    model = spark.sparkContext.broadcast((d, Tables.of(train(texts, d, rounds))))

    def run(batches):
        d, tables = model.value
        logs = np.log10(d.c + 1.0)
        for b in batches:
            parts = []
            for _, t in runs_of(b.column(0)):
                w = Words(t)
                n = len(t)
                base, score, known, rest_of, rest = np.full(n, np.log10(d.end_count + 1.0)), np.zeros(n), np.full(n, int(d.end_count > 0)), np.zeros(n, np.int64), []
                symbols = HEAD + _classes(w)
                for a in range(0, w.n if len(d.h) else 0, STRETCH):
                    h, doc = _as_long(w.hash[a : a + STRETCH]), w.doc[a : a + STRETCH]
                    at = np.minimum(np.searchsorted(d.h, h), len(d.h) - 1)
                    listed = d.h[at] == h
                    sym = np.where(listed, d.symbol[at], symbols[a : a + STRETCH])
                    symbols[a : a + STRETCH] = sym
                    own = np.where(listed, logs[at], 0.0)
                    base += np.bincount(doc, own, n)
                    score += np.bincount(doc, np.where(sym >= HEAD, own - d.class_log[np.maximum(sym - HEAD, 0)], 0.0), n)
                    known += np.bincount(doc, listed, n).astype(np.int64)
                    rest_of += np.bincount(doc[~listed], minlength=n)
                    rest.append(h[~listed])
                if w.n and not len(d.h):
                    score -= np.bincount(w.doc, d.class_log[symbols - HEAD], n)
                    rest_of += np.bincount(w.doc, minlength=n)
                    rest.append(_as_long(w.hash))
                s, one, two = _stream(w, symbols)
                ends_at = w.begin[1:] + np.arange(1, n + 1)
                for a in range(0, len(s), STRETCH):
                    to = min(a + STRETCH, len(s))
                    score += np.bincount(np.searchsorted(ends_at, np.arange(a, to), "right"), tables.log10(s[a:to], one[a:to], two[a:to]), n)
                ends = np.concatenate(([0], np.cumsum(rest_of)))
                parts.append((np.diff(w.begin) + 1, known, base, score, pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.concatenate(rest) if rest else np.zeros(0, np.int64)))))
            if parts:
                flat = [pa.concat_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in col]) for col in zip(*parts, strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(1), *flat], names=["_k", "n_tokens", "n_known", "base", "score", "rest"])

    keyed = rows.select("text", F.monotonically_increasing_id().alias("_k"), "_id")
    ids = keyed.schema["_id"].dataType.simpleString()

    def with_id(batches):
        for b in batches:
            got = list(run([b]))
            if got:
                yield pa.RecordBatch.from_arrays([*got[0].columns, b.column(2)], names=["_k", "n_tokens", "n_known", "base", "score", "rest", "_id"])

    scored = cut(keyed.mapInArrow(with_id, f"_k long, n_tokens long, n_known long, base double, score double, rest array<long>, _id {ids}"))
    rest = scored.select("_k", F.explode("rest").alias("h")).groupBy("_k", "h").agg(F.count(F.lit(1)).alias("n")).join(counts.select("h", "c"), "h")
    more = rest.groupBy("_k").agg(F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("more"), F.sum("n").alias("found"))
    more_of = F.coalesce("more", F.lit(0.0))
    slots = float(np.log10(d.tokens + d.distinct + 1.0))
    return scored.drop("rest").join(more, "_k", "left").select(
        F.col("_id").alias(id_col), "n_tokens", (F.col("n_known") + F.coalesce("found", F.lit(0))).alias("n_known"), F.lit(d.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more_of - F.col("n_tokens") * F.lit(slots)).alias("base_score"), (F.col("score") + more_of).alias("score"),
    )
