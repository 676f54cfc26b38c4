"""Token ids, packing and token files: against the library, exact round trips, invariants of plans."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spotlattice.llm import packing, token_files
from spotlattice.llm.eliasfano import EliasFano, TokenFile, encode_file
from spotlattice.llm.tokens import Encoder, vocabulary_path

FILES = [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)]
TEXTS = ["", " ", "\n", "a", "a b", "a  b", " a", "a ", "a\nb", "a \n b", "\n\na", "it's I'LL x's", "don't,stop. 1234 a1b2", "<|endoftext|> <|startoftext|>", "É è ß İ ŉ ſ",
         "日本語 text", "e\u0301 é", "a\u00a0b", "tab\tx", "crlf\r\nx", "\x1c\x85", "😀 a😀b", "a\u200bb", "word," * 300, "\\ \" '", "ǅ ǆ Σς"]


@pytest.fixture(scope="module", params=FILES, ids=["byte", "word"])
def enc(request):
    return Encoder(vocabulary_path(request.param[0]), request.param[1])


def expected(enc, t):
    return enc.library.encode(t, add_special_tokens=False).ids


def test_ids_are_the_librarys(enc):
    assert [x.tolist() for x in enc.encode(TEXTS)] == [expected(enc, t) for t in TEXTS]
    assert [x.tolist() for x in enc.encode(TEXTS)] == [expected(enc, t) for t in TEXTS]  # from the caches


@pytest.mark.parametrize("file,blank", FILES, ids=["byte", "word"])
def test_added_tokens_are_the_untouched_librarys(file, blank):
    from tokenizers import Tokenizer

    plain, own = Tokenizer.from_file(vocabulary_path(file)), Encoder(vocabulary_path(file), blank)
    texts = [*TEXTS, "a <|endoftext|> b", "a<|startoftext|>b", "<|endoftext|>", "x\n<|endoftext|>y", "a <|ENDOFTEXT|> b", "a <| b", "a <|endoftext|", "a b"]
    for _ in range(2):
        assert [x.tolist() for x in own.encode(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(own.encode(["a <|endoftext|> b"])[0]) == (4 if blank else 3)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("abAB 'st.,!-0123\nÉéßñ\t\u00a0日́<|>")), max_size=40))
def test_ids_of_any_text(t):
    for e in _both():
        assert e.encode([t])[0].tolist() == expected(e, t)


_made: list = []


def _both():
    if not _made:
        _made.extend(Encoder(vocabulary_path(f), b) for f, b in FILES)
    return _made


def check_plan(counts, capacity, plan, made):
    seen, spans = Counter(), []
    for r in plan.itertuples(index=False):
        assert r.rank == seen[r.length]
        seen[r.length] += r.n
        for k in range(r.n):
            spans.append((r.sequence + k // r.per_bin, r.offset + k % r.per_bin * r.length, r.length))
    assert seen == Counter({k: v for k, v in counts.items() if v})
    at = defaultdict(int)
    for s, o, n in sorted(spans):
        assert o == at[s]
        at[s] += n
    assert len(at) == made and max(at.values(), default=0) <= capacity


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 40), max_size=25), st.integers(1, 60), st.sampled_from([0.0, 0.1, 0.25, 0.5]))
def test_plans_pack_everything_without_gaps(counts, groups, small):
    plan, made = packing.plan_packing(counts, 50, groups, small)
    check_plan(counts, 50, plan, made)
    total = -(-sum(k * v for k, v in counts.items()) // 50)
    assert made >= total


def test_plan_is_near_the_bound():
    r = random.Random(1)
    counts = Counter(min(2048, max(1, int(r.lognormvariate(6, 1.2)))) for _ in range(20000))
    plan, made = packing.plan_packing(counts)
    check_plan(counts, 2048, plan, made)
    assert made <= 1.005 * -(-sum(k * v for k, v in counts.items()) // 2048)
    with pytest.raises(ValueError):
        packing.plan_packing({0: 1})


def test_pack_documents(spark):
    data = [(i, "word another " * (i * 37 % 900)) for i in range(60)] + [(None, None), (3, ""), (3, ""), (100, "long text here " * 3000)]
    docs = spark.createDataFrame([(i, t, "a", "b", 1) for i, t in data], "doc_id long, text string, piece string, length string, sequence_id int")
    got = packing.pack_documents(docs).collect()
    e = _both()[1]
    want = Counter()
    for i, t in data:
        ids = [*expected(e, t or ""), 0]
        for k in range(0, len(ids), 2048):
            own = ids[k : k + 2048]
            want[(i, k // 2048, k, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    at = defaultdict(int)
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at[r.sequence_id]
        at[r.sequence_id] += r.length
    assert max(at.values()) <= 2048 and len(at) <= 1.1 * sum(at.values()) / 2048 + 1
    assert packing.pack_documents(docs.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=300))
def test_elias_fano(steps):
    v = np.cumsum(np.array(steps, dtype=np.int64))
    e = EliasFano.of(v)
    assert e.part(0, len(v)).tolist() == v.tolist() and [e.select(i) for i in range(len(v))] == v.tolist()
    again, end = EliasFano.at(b"xyz" + (raw := e.to_bytes()), 3)
    assert end == len(raw) + 3 and again.select(len(v) - 1) == v[-1] if len(v) else again.n == 0
    assert all(again.part(a, b).tolist() == v[a:b].tolist() for a in range(0, len(v), 37) for b in (a, a + 1, a + 64, a + 200))
    if len(v) > 100:
        assert (len(e.low) + len(e.high)) * 8 <= len(v) * (3 + max(0, np.log2(max(1, v[-1] / len(v))))) + 64
    with pytest.raises(IndexError):
        e.select(len(v))


def test_token_file():
    f = TokenFile(encode_file([None, -5, 7], [2, 1, 3], np.arange(6, dtype="<u2").tobytes(), 2))
    assert [f.doc(i).tolist() for i in range(3)] == [[0, 1], [2], [3, 4, 5]] and f.span(2) == (3, 6)
    assert [f.doc_id(i) for i in range(3)] == f.doc_ids(0, 3) == [None, -5, 7] and f.doc_ids(1, 9) == [-5, 7]
    n = 20_000
    r = np.random.default_rng(0)
    sizes, keys = r.integers(1, 900, n), np.sort(r.integers(0, 10**12, n))
    data = encode_file(keys.tolist(), sizes.tolist(), b"", 2)
    assert len(data) < 9 * n and len(EliasFano.of(keys).directory) * 4 < n
    with pytest.raises(ValueError):
        TokenFile(b"x" * 100)


def test_token_files_round_trip(spark, tmp_path):
    data = [(i * 7 % 101, f"text number {i} " * (i % 30)) for i in range(101)] + [(None, "none"), (50, None), (50, None), (200, "x y " * 20000)]
    docs = spark.createDataFrame([(i, t, "a", 1) for i, t in data], "doc_id long, text string, start string, k int").repartition(5)
    folder = str(tmp_path / "out")
    manifest = token_files.write_token_files(docs, folder, file_ids=500)
    got = token_files.read_token_files(manifest, folder).orderBy("start").collect()
    e = _both()[0]
    want = Counter((i, len(x := [*expected(e, t or ""), 0]), zlib.crc32(np.array(x, "<u4").tobytes())) for i, t in data)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in got]
    assert ids[0] is None and ids[1:] == sorted(ids[1:]) and manifest.count() > 5
    assert token_files.token_file_round_trip(docs.limit(0)).count() == 0
    left = docs.select(F.col("text").alias("t"), F.col("doc_id").alias("i"))
    assert token_files.token_file_round_trip(left, "i", "t").count() == len(data)


@pytest.mark.parametrize("file,blank", FILES, ids=["byte", "word"])
def test_every_letter_in_context_is_the_untouched_librarys(file, blank):
    from tokenizers import Tokenizer

    plain, own = Tokenizer.from_file(vocabulary_path(file)), Encoder(vocabulary_path(file), blank)
    points = [c for c in itertools.chain(range(1, 0x600), range(0x1E00, 0x2200), range(0x2C60, 0x2C80), range(0xA720, 0xA7F0)) if not 0xD800 <= c < 0xE000]
    texts = [f"ab{chr(c)}cd ={chr(c)} x{chr(c)}'s {chr(c)}, {chr(c).upper()}{chr(c).lower()}" for c in points]
    want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert [hex(c) for c, a, b in zip(points, own.encode(texts), want, strict=True) if a.tolist() != b] == []


def test_caches_are_bounded_in_bytes(monkeypatch):
    from spotlattice.llm import tokens

    monkeypatch.setattr(tokens, "CACHE_PIECES", 50_000)
    monkeypatch.setattr(tokens, "CACHE_WORDS", 20_000)
    e = Encoder(vocabulary_path(FILES[0][0]), True)
    long = [" ".join(f"{i}x" * 500 for i in range(k, k + 20)) for k in range(0, 200, 20)]
    assert [x.tolist() for x in e.encode(long)] == [expected(e, t) for t in long]
    assert sum(len(k) + len(v) for k, v in e.pieces.items()) < 50_000 and sum(len(k) + len(v) for k, v in e.words.items()) < 20_000
