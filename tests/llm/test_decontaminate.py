from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidings.llm import decontaminate as d


def words(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def brute(text, items):
    w, hit, names = words(text), set(), set()
    for item, t in items:
        p = words(t)
        n = min(10, len(p))
        for k in range(len(p) - n + 1) if n else ():
            for i in range(len(w) - n + 1):
                if w[i : i + n] == p[k : k + n]:
                    hit |= set(range(i, i + n))
                    names.add(str(item))
    return len(w), len(hit), sorted(names)


def tables(spark, docs):
    rng = np.random.default_rng(5)
    pool = ["a", "b", "the", "longer", "É1", "zz"]
    text = lambda n: " ".join(pool[k] for k in rng.integers(0, len(pool), n))
    items = [(k, text(int(n))) for k, n in enumerate([1, 2, 3, 9, 10, 11, 12, 14, 30])] + [(20, None), (21, "!!"), (None, "only once here"), (2, "b zz zz"), (10, "a a a a a a a a a a a a")]
    more = [(1000 + k, text(60) + (". " + items[k % 9][1].upper().replace(" ", "--") if k % 3 == 0 else "")) for k in range(30)] + [(2000, "Only, once: here"), (2001, "A " * 40)]
    table = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    return table, spark.createDataFrame(items, "item_id long, text string"), items


@pytest.mark.parametrize("block_bytes", [d.BLOCK_BYTES, 2000])
def test_occurrences_against_brute_force(spark, docs, block_bytes):
    table, benchmark, items = tables(spark, docs)
    got = d.with_occurrences(table, benchmark, block_bytes=block_bytes).collect()
    assert len(got) == table.count()
    for r in got:
        n, n_hit, names = brute(r["text"], [i for i in items if i[0] is not None])
        hit = brute(r["text"], items)[1]
        assert (r["n_words"], sum(s["last"] - s["first"] + 1 for s in r["spans"]), r["items"]) == (n, hit, names)


def test_report_columns(spark, docs):
    table, benchmark, items = tables(spark, docs)
    for r in d.report(table, benchmark).collect():
        assert r["contaminated"] == (r["n_hit"] > 0) and len(r["items_sha256"]) == 64
        if not r["n_items"]:
            assert r["items_sha256"] == hashlib.sha256(b"").hexdigest()


def test_search_finds_each_place_once():
    rng = np.random.default_rng(2)
    text = bytes(rng.choice(list(b"ab "), 20000).astype(np.uint8))
    patterns = sorted({text[i : i + int(n)] for i, n in zip(rng.integers(0, 19000, 60), rng.integers(3, 40, 60))})
    for matcher in d.matchers(patterns):
        at, number = matcher.search(np.frombuffer(text, np.uint8))
        got = sorted(zip(at.tolist(), number.tolist()))
        mine = {int(n) for n in matcher.numbers}
        assert got == sorted((m.start(), k) for k in mine for m in re.finditer(b"(?=" + re.escape(patterns[k]) + b")", text))


def test_clean_keeps_columns_and_other_rows(spark, docs):
    benchmark = spark.createDataFrame([(1, "same text")], "item_id long, text string")
    got = d.clean(docs, benchmark)
    assert got.columns == docs.columns
    assert sorted(str(r["text"]) for r in got.collect()) == sorted(str(r["text"]) for r in docs.collect() if r["text"] != "same text again")


def test_empty_tables(spark, docs, none):
    no_items = spark.createDataFrame([], "item_id long, text string")
    assert {(r["n_hit"], r["n_items"]) for r in d.report(docs, no_items).collect()} == {(0, 0)}
    assert d.report(none, spark.createDataFrame([(1, "a")], "item_id long, text string")).collect() == []


def test_words_of_a_batch_stay_apart():
    data, before, bounds = d.normal_form(pa.array(["", "A, b", "c", " "]))
    assert [p for _, p in d.windows(data, before, bounds)] == [b" a b ", b" c "] and bounds.tolist() == [0, 0, 2, 3, 3]


def test_a_window_that_most_items_share(spark, docs):
    """Its items are named in full, and no row sent to tasks grows with them."""
    common = "this line stands in every item of the list in full"
    benchmark = spark.range(3000).selectExpr("id AS item_id", f"concat('{common} ', IF(id % 2 = 0, '', concat('and ', id))) AS text")
    table = docs.select("doc_id", "text").union(spark.createDataFrame([(900, f"x {common} y"), (901, f"x {common} y"), (902, f"{common} and 7")], "doc_id long, text string"))
    got = {r["doc_id"]: r for r in d.with_occurrences(table, benchmark).where("doc_id >= 900").collect()}
    assert got[900]["items"] == got[901]["items"] == sorted(map(str, range(3000)))
    assert got[902]["items"] == sorted(map(str, range(3000))) and len(got[902]["spans"]) == 1
    patterns = d.numbered(d.pattern_table(benchmark))
    assert patterns.columns == ["pattern", "number"] and patterns.where("length(pattern) < 100").count() == patterns.count()


def test_columns_with_clashing_names(spark, docs):
    benchmark = spark.createDataFrame([(1, "same text")], "item_id long, text string")
    table = docs.withColumn("numbers", F.lit(1)).withColumn("number", F.lit(2)).withColumn("item", F.lit(3)).withColumn("pattern", F.lit(4))
    got = d.with_occurrences(table, benchmark)
    assert got.columns == [*table.columns, "n_words", "spans", "items"] and got.count() == table.count()
    assert got.where("size(items) > 0 AND number = 2 AND numbers = 1").count() == got.where("size(items) > 0").count() > 0
    with pytest.raises(ValueError):
        d.with_occurrences(docs.withColumn("spans", F.lit(1)), benchmark)
