from __future__ import annotations

import hashlib

import numpy as np
import pytest
from edges import split

from tidings.llm import recompress


def brute(rows, window):
    """(id, words, kept words) by comparing all windows of all texts."""
    first = {}
    for d, t in rows:
        w = split(t)
        for i in range(len(w) - window + 1) if d is not None else ():
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, t in rows:
        w = split(t)
        gone = {k for i in range(len(w) - window + 1) if d is not None and first[tuple(w[i : i + window])] < d for k in range(i, i + window)}
        out.append((d, len(w), [x for k, x in enumerate(w) if k not in gone]))
    return out


def periodic(seed):
    """Texts of few words, runs and periods, and pieces of each other."""
    rng = np.random.default_rng(seed)
    texts = []
    for _ in range(40):
        parts = []
        for _ in range(rng.integers(1, 6)):
            kind = rng.integers(0, 4)
            if kind == 0:
                parts += ["a"] * int(rng.integers(1, 90))
            elif kind == 1:
                parts += np.resize([str(x) for x in rng.integers(0, 3, rng.integers(1, 7))], rng.integers(10, 120)).tolist()
            elif kind == 2 and texts:
                w = split(texts[rng.integers(0, len(texts))])
                at = int(rng.integers(0, len(w)))
                parts += w[at : at + int(rng.integers(30, 90))]
            else:
                parts += [f"r{x}" for x in rng.integers(0, 40, rng.integers(1, 80))]
        texts.append(" ".join(parts))
    return [(int(k), t) for k, t in zip(rng.permutation(len(texts)), texts)]


@pytest.mark.parametrize(("window", "seed"), [(50, 1), (50, 2), (recompress.least_window(), 3), (33, 4)])
def test_repeats_against_brute_force(spark, window, seed):
    rows = periodic(seed)
    got = recompress.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), window, respace=True).collect()
    want = brute(rows, window)
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in got) == sorted((d, n, n - len(k), " ".join(k)) for d, n, k in want)
    assert any(len(k) not in (0, n) for _, n, k in want)


def test_edge_documents_against_brute_force(docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = recompress.report(docs).collect()
    want = [(d, n, n - len(k), hashlib.sha256(" ".join(k).encode()).hexdigest()) for d, n, k in brute(rows, 50)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_columns_nulls_and_white_space_stay(docs):
    got = recompress.without_repeats(docs)
    assert got.columns == [*docs.columns, "n_words", "n_removed"]
    before = {(r["doc_id"], r["text"]) for r in docs.collect()}
    for r in got.collect():
        assert r["n_removed"] or (r["doc_id"], r["text"]) in before
        assert r["key"] == r["row"] == "c"


def test_all_places_of_a_window_share_its_anchor():
    rng = np.random.default_rng(1)
    names = rng.integers(1, 1 << 62, 50).astype(np.uint64)
    for trial in range(300):
        k = int(rng.integers(1, 4)) if trial % 2 else 50
        window = np.resize(rng.integers(0, k, int(rng.integers(1, 8) if trial % 3 else 50)), 50)
        found = set()
        for _ in range(3):
            before = rng.integers(0, k, int(rng.integers(0, 40)))
            text = names[np.concatenate((before, window, rng.integers(0, k, int(rng.integers(0, 40)))))]
            first, anchor = recompress.window_anchors(text, np.array([0, len(text)]), 50)
            assert first.tolist() == list(range(len(text) - 49))
            found.add(int(anchor[len(before)]) - len(before))
        assert len(found) == 1


def test_texts_of_a_batch_are_parsed_apart():
    names = np.array([5, 5, 5, 5, 9], np.uint64)
    whole = recompress.symbol_starts(names[:2], np.array([0, 2]))
    assert (recompress.symbol_starts(names, np.array([0, 2, 2, 5]))[:2] == whole).all()


def test_short_windows_and_clashing_names_are_refused(docs):
    with pytest.raises(ValueError):
        recompress.without_repeats(docs, recompress.least_window() - 1)
    with pytest.raises(ValueError):
        recompress.without_repeats(docs, names=("h", "n_removed"))


def test_empty_table(none):
    assert recompress.report(none).collect() == []
