from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tidings.llm import pieces
from tidings.llm.word_ids import WordIds

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    fst = pieces.Transducer(PATH)
    return pieces.Encoder(fst), pieces.Decoder(fst), sentencepiece.SentencePieceProcessor(model_file=PATH)


def coded(encoder, texts):
    ids, ends = encoder(pa.array(texts))
    return [ids[a:b].tolist() for a, b in zip(ends, ends[1:])]


def check(model, texts):
    encoder, decoder, library = model
    got = coded(encoder, texts)
    assert got == library.encode(texts, num_threads=1)
    ids, ends = encoder(pa.array(texts))
    assert decoder(ids.astype(np.int64), ends) == [t.replace("▁", " ") for t in texts]


def test_texts_of_many_kinds(model):
    check(model, ["", " ", "  ", "\n", " \n ", "▁", "▁▁ x", "a" + " " * 17 + "b", " " * 15, " " * 33 + "\t", "<s></s><unk><0x41>", "naïve café 日本語 ☃ 😀", "x" * 500, "ab " * 200, "\x00\x01"])


def test_random_texts(model):
    rng = random.Random(0)
    for alphabet in (" \n\tabetho.,'▁é梦😀\x00<0x41>s\r ", "aethinors ", "ththe ", "0123456789 .,-"):
        check(model, ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(1500)])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=5))
def test_any_texts(model, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    check(model, texts)


def test_paths_equal_the_merges(model):
    fst = model[0].fst
    rng = random.Random(1)
    for _ in range(400):
        word = "▁" + "".join(rng.choice("aethinorsdlu") for _ in range(rng.randint(0, 25)))
        merged = fst.merged(list(word))
        assert fst.path(word) == fst.word(word) == [fst.ids[p] for p in merged] and merged == fst._merged_long(list(word))


def test_memory_of_words_is_bounded(model, monkeypatch):
    monkeypatch.setattr("tidings.llm.word_ids.KEPT_WORDS", 50)
    encoder = pieces.Encoder(model[0].fst)
    texts = [" ".join(f"word{k * 31 + j}" for j in range(40)) for k in range(20)]
    assert [coded(encoder, [t])[0] for t in texts] == model[2].encode(texts, num_threads=1)
    assert len(encoder.lookup.index) <= 50


def test_tables(docs, none, model):
    full = pieces.decode(pieces.encode(docs, PATH), PATH)
    assert full.columns == [*docs.columns, "ids", "decoded"]
    for r in full.collect():
        want = model[2].encode(r["text"] or "")
        assert (r["ids"], r["decoded"]) == (want, (r["text"] or "").replace("▁", " "))
    for r in pieces.report(docs, PATH).collect():
        assert r["same_text"]
    sums = {(r["doc_id"], r["ids_crc32"], r["n_ids"]) for r in pieces.report(docs, PATH).collect()}
    assert sums == {(r["doc_id"], zlib.crc32(np.array(i, "<u4").tobytes()), len(i)) for r in docs.collect() for i in [model[2].encode(r["text"] or "")]}
    assert pieces.report(none, PATH).collect() == []
    with pytest.raises(ValueError):
        pieces.encode(docs, PATH, name="x")


def test_known_words_are_not_learned_again():
    learned = []
    lookup = WordIds(lambda words: learned.extend(words) or [[len(w), ord(w[0])] for w in words], 40)

    def look(words):
        ids, bounds = lookup(pa.array(words), np.array([0, len(words)]))
        assert ids.tolist() == [i for w in words for i in (len(w), ord(w[0]))] and bounds.tolist() == [0, 2 * len(words)]

    common = [f"common{k}" for k in range(10)]
    for k in range(20):  # rare words come and go; those of every turn stay
        look([*common, *(f"{k}rare{j}" for j in range(4))] * 2)
        assert len(lookup.index) <= 20 and len(lookup.old[0]) <= 20
    assert [learned.count(w) for w in common] == [1] * 10 and len(learned) == 90
    look([f"many{k}" for k in range(100)])  # more than is kept, in one call
    look([])
