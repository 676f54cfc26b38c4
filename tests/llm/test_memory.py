import tracemalloc

import numpy as np
import pyarrow as pa

from spotlattice.llm import tokens, toxicity


def test_scoring_holds_a_short_run_of_texts_at_a_time():
    rng = np.random.default_rng(3)
    words = [bytes(rng.integers(97, 123, 6).astype(np.uint8)) for _ in range(5000)]
    texts = [b" ".join(words[i] for i in rng.integers(0, len(words), 300)) for _ in range(1500)] + [b"", None]
    model = toxicity.fit(texts[:40], np.arange(40) % 2, epochs=1)
    column = pa.array(texts, pa.binary())
    tracemalloc.start()
    got = toxicity.scores_of(model, column)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.allclose(got, model.scores(texts), atol=1e-6)
    assert peak < 40e6  # 3 MB of texts; in runs of 1.5 MB this was 58 MB, in runs of 0.4 MB 15 MB


def test_a_worker_lets_go_of_encoders():
    tokens.encoder(tokens.vocabulary_path("word_bpe_49k.json"), False).encode(["some words"])
    tokens.forget()
    assert tokens.encoder.cache_info().currsize == 0
    tokens.forget()


def test_the_driver_does_not_train(spark, monkeypatch):
    def here(*_):
        raise AssertionError("trained in the driver")

    docs = spark.createDataFrame([(i, f"w{i % 9} {'bad' if i % 2 else 'good'} words", "en") for i in range(60)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "_start", here)
    model = toxicity.learn(docs, labels)
    bad, good = model.scores([b"bad words", b"good words"])
    assert bad > good
