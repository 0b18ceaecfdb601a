from __future__ import annotations

import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tidings.llm import language

SF_DIR = "/root/testdata/sf0.01"


def toy(n=400, seed=0):
    rng = np.random.default_rng(seed)
    sets = [b"abcdefg ", b"uvwxyz "]
    y = rng.integers(0, 2, n)
    x = np.stack([rng.choice(np.frombuffer(sets[k], np.uint8), language.LENGTH) for k in y])
    return x, y


def test_training_separates_two_alphabets():
    x, y = toy()
    net = language.train(x, y, ["a", "z"], epochs=4)
    test, truth = toy(seed=1)
    assert (language.Predictor(net).probabilities(test).argmax(axis=1) == truth).mean() > 0.99


def test_prediction_equals_the_network():
    x, y = toy(40)
    net = language.train(x, y, ["a", "z"], epochs=1)
    pooled = np.concatenate([r for r, _ in net.responses(x)], axis=1)
    want = language._softmax(np.maximum(pooled, 0) @ net.weights + net.offsets)
    assert np.allclose(language.Predictor(net).probabilities(x), want, atol=1e-5)


def test_gradient_step_lowers_the_loss():
    x, y = toy(64)
    loss = lambda net: -np.log(language.Predictor(net).probabilities(x)[np.arange(len(y)), y]).mean()
    assert loss(language.train(x, y, ["a", "z"], epochs=6)) < loss(language.train(x, y, ["a", "z"], epochs=0))


def test_every_window_of_a_long_text_counts():
    x, y = toy()
    predict = language.Predictor(language.train(x, y, ["a", "z"], epochs=4))
    texts = ["abc " * 2000 + "xyz " * 6000, "xyz " * 2000 + "abc " * 6000, "", "a"]
    best, score = predict(pa.array(texts))
    assert best.tolist()[:2] == [1, 0] and all(0.5 < s < 0.95 for s in score[:2])
    alone = [predict(pa.array([t]))[0][0] for t in texts]
    assert alone == best.tolist()


def test_edges(docs):
    net = language.fit(docs)
    got = language.with_language(docs, net, ("lang_pred", "score"))
    assert got.columns == [*docs.columns, "lang_pred", "score"] and got.count() == docs.count()
    for r in got.collect():
        lettered = re.search(r"[^\W\d_]", r["text"] or "") is not None
        assert r["lang_pred"] == ("en" if lettered else "und") and 0 <= r["score"] <= 1


def test_nothing_to_learn(docs, none):
    assert language.fit(none) is None
    assert {r["lang_pred"] for r in language.with_language(docs, None).collect()} == {"und"}
    assert language.report(none).collect() == []


def test_copies_count_once_in_the_sample(spark):
    rows = [(k, "copy copy", "en") for k in range(50)] + [(100 + k, f"other text {k}", "de") for k in range(5)]
    windows, labels, names = language.sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 8, 1)
    assert names == ["de", "en"] and labels.tolist().count(1) == 1 and labels.tolist().count(0) == 5
    assert len(language.sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 3, 1)[0]) == 3


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_held_out_accuracy(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = {r["doc_id"]: r for r in language.report(rows).collect()}
    truth = {r["doc_id"]: r["lang"] for r in rows.collect()}
    assert set(got) == set(truth)
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1) for d, r in got.items())
    tested = [r["lang_pred"] == truth[d] for d, r in got.items() if r["held_out"]]
    assert len(tested) > 200 and sum(tested) / len(tested) > 0.98
