from __future__ import annotations

import numpy as np
import pytest
import xxhash
from edges import split
from pyspark.sql import functions as F

from tidings.llm import simhash
from tidings.llm.components import components


def fingerprint(text):
    words = split("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def lowest(prints, budget=2):
    """Smallest id reachable of each (id, fingerprint), by comparing all pairs."""
    values = sorted({p for _, p in prints})
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= budget:
                root[find(a)] = find(b)
    ids = {}
    for d, p in prints:
        ids.setdefault(find(p), []).append(d)
    return [(d, f"{p:016x}", min((i for i in ids[find(p)] if i is not None), default=None)) for d, p in prints]


def test_documents_against_brute_force(docs):
    want = lowest([(r["doc_id"], fingerprint(r["text"])) for r in docs.collect()])
    got = [tuple(r) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("spread", [2, 5, 64])
def test_links_against_brute_force(spark, spread):
    rng = np.random.default_rng(spread)
    base = [int(x) for x in rng.integers(0, 1 << 63, 6)]
    values = {0, (1 << 64) - 1, (1 << 64) - 2, 7}
    for _ in range(400):
        v = base[rng.integers(0, 6)]
        for b in rng.integers(0, spread if spread < 64 else 64, rng.integers(0, 4)):
            v ^= 1 << (int(b) * 13 % 64)
        values.add(v)
    prints = [(k, v) for k, v in enumerate(sorted(values))]
    table = spark.createDataFrame([(k, v - (1 << 64) if v >> 63 else v) for k, v in prints], "doc_id long, fingerprint long")
    got = {(r["doc_id"], r["component_id"]) for r in simhash.near_components(table).collect()}
    assert got == {(d, c) for d, _, c in lowest(prints)}


def test_trie_pairs_are_all_close_pairs():
    rng = np.random.default_rng(1)
    values = np.unique(rng.integers(0, 1 << 12, 300)).astype(np.uint64)
    bounds = np.array([0, 100, 101, len(values)])
    i, j = simhash.trie_pairs(values, bounds, 12, 2)
    bucket = np.searchsorted(bounds, np.arange(len(values)), "right")
    want = {(a, b) for a in range(len(values)) for b in range(a + 1, len(values)) if bucket[a] == bucket[b] and int(values[a] ^ values[b]).bit_count() <= 2}
    assert set(zip(i.tolist(), j.tolist())) == want and len(i) == len(want)


def test_long_chain_is_one_component(spark):
    links = spark.range(300).select(((F.col("id") * 7919) % 100003).alias("a"), (((F.col("id") + 1) * 7919) % 100003).alias("b"))
    got = components(links).collect()
    assert len(got) == 301 and {r["root"] for r in got} == {min(k * 7919 % 100003 for k in range(301))}


def test_one_row_of_each_group_stays_with_all_columns(docs):
    rows = docs.collect()
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    kept = [(r["doc_id"], fingerprint(r["text"])) for r in got.collect()]
    groups = {}
    for d, p, c in lowest([(r["doc_id"], fingerprint(r["text"])) for r in rows]):
        groups.setdefault(c if c is not None else p, set()).add(d)
    assert len(kept) == len(groups) and {d for d, _ in kept} == {c if isinstance(c, int) else None for c in groups}


def test_groups_of_null_ids_keep_one_row_each(spark):
    rows = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (None, "other words here now"), (5, "third one is it")], "doc_id long, text string")
    assert sorted(r["text"] for r in simhash.keep_one(rows).collect()) == ["a b c d", "other words here now", "third one is it"]


def test_empty_table(none):
    assert simhash.near_duplicates(none).collect() == [] and simhash.keep_one(none).collect() == []
