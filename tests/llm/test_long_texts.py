"""Texts and words of any length: the same results in stretches, and bounded memory."""

import random
import subprocess
import sys

import numpy as np
import pytest

from spotlattice.llm import bytewords, lm, near_dedup, toxicity

from .test_models import corpus

TEXTS = ["".join(random.Random(k).choices("abcÀÉé  \n\tXYZ,.日", k=k * 3 % 700)).encode() for k in range(300)] + [None, b"", b"x" * 5000, b"x" * 4999 + b" y", b"y x" * 900]


@pytest.mark.parametrize("options", [{}, {"table": bytewords.LETTERS, "prefixes": (4, 5), "fold_latin": True}], ids=["words", "letters"])
@pytest.mark.parametrize("step", [3, 64, 1001])
def test_words_do_not_depend_on_stretches(monkeypatch, options, step):
    whole = bytewords.Words(TEXTS, **options)
    monkeypatch.setattr(bytewords, "STRETCH", step)
    own = bytewords.Words(TEXTS, **options)
    assert (own.hash == whole.hash).all() and (own.begin == whole.begin).all() and (own.doc == whole.doc).all()
    assert all((a == b).all() for a, b in zip(own.lead, whole.lead, strict=True)) and all((own.prefix[k] == whole.prefix[k]).all() for k in whole.prefix)


def test_words_beyond_the_table_of_powers_differ():
    a = bytewords.Words([b"a" * 200_000 + b"b", b"a" * 200_000 + b"c", b"b" + b"a" * 200_000, b"a" * 65_536 + b"b" + b"a" * 134_464])
    assert len(set(a.hash.tolist())) == 4


def test_shingles_and_scores_do_not_depend_on_stretches(monkeypatch):
    whole = near_dedup.shingles(TEXTS, 5)
    monkeypatch.setattr(near_dedup, "STRETCH", 17)
    own = near_dedup.shingles(TEXTS, 5)
    assert all((a == b).all() for a, b in zip(own, whole, strict=True))
    data = corpus(200, 1)
    model = toxicity.fit([t.encode() for _, t, _, _ in data], np.array([y for *_, y in data]), epochs=2)
    text = " ".join(t for _, t, _, _ in data[:40]).encode()
    got, begin = toxicity.features([text], model.tables.shape[1])
    for step in (1, 2, 5, 1000):
        assert abs(model.long_logit(got, step) - model.logits(got, begin)[0]) < 1e-5


@pytest.mark.parametrize("kind", ["words", "one word"])
def test_a_text_of_a_hundred_megabytes_fits(kind):
    """In a process of its own that may not take more than 3 GB of memory."""
    code = f"""
import random, resource, sys
resource.setrlimit(resource.RLIMIT_DATA, (3_000_000_000, 3_000_000_000))
sys.path.insert(0, {str(sys.path[0])!r})
import numpy as np
from spotlattice.llm import bytewords, lm, near_dedup, toxicity
r = random.Random(0)
if {kind!r} == "words":
    text = b" ".join(b"w%d" % r.randrange(50_000) for _ in range(20_000)) * 850
else:
    text = b"x" * 100_000_000
assert len(text) > 99_000_000
w = bytewords.Words([text])
d = lm.Dictionary(*(np.zeros(0, np.int64),) * 5, np.full(lm.SYMBOLS, 1 / lm.SYMBOLS), np.zeros(lm.CLASSES), 0, 0, 0)
s = lm._stream(w, lm._symbols(w, d))
del w, s
h, begin = near_dedup.shingles([text], 5)
del h
m = toxicity._start(np.zeros((1, 4), np.uint16), np.array([0, 1]), np.zeros(1, np.int64), 1 << 16, 8, 8, 7)
assert 0 <= m.scores([text])[0] <= 1
"""
    got = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True)
    assert got.returncode == 0, got.stderr[-2000:]
