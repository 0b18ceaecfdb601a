from __future__ import annotations

import zlib
from collections import Counter

from pyspark.sql import functions as F

from tidings.llm import sharding


def test_rows_are_cut_evenly_and_slots_are_gapless(docs):
    got = sharding.interleave(docs, 5).collect()
    want = Counter((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in docs.collect())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    sizes = Counter(r["shard"] for r in got)
    assert set(sizes) == set(range(5)) and max(sizes.values()) - min(sizes.values()) <= 1
    for shard, n in sizes.items():
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(n))


def test_each_shard_has_each_sources_share(spark):
    rows = spark.range(30000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id")).alias("text"),
                                     F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"))
    table = Counter((r["source"], r["shard"]) for r in sharding.interleave(rows, 16, seed=3).collect())
    for source in {s for s, _ in table}:
        counts = [table[source, k] for k in range(16)]
        assert all(abs(n - sum(counts) / 16) <= 1 for n in counts)


def test_singleton_sources_spread(spark):
    rows = spark.range(1600).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.col("id").cast("string").alias("source"))
    order = [r["doc_id"] for r in sharding.interleave(rows, 16).orderBy("shard", "slot").collect()]
    assert sorted(order) == list(range(1600)) and order != list(range(1600))


def test_seed_decides_and_runs_repeat(docs):
    place = lambda seed: sorted((str(r["doc_id"]), r["text_crc32"], r["shard"], r["slot"]) for r in sharding.interleave(docs, 4, seed).collect())
    assert place(1) == place(1) != place(2)


def test_empty_table(none):
    assert sharding.interleave(none, 3).collect() == []


def test_no_window_grows_with_the_table(spark, docs, monkeypatch):
    n = 200
    counts = spark.range(2 * n).selectExpr("id % 2 AS key", "id div 2 AS at", "id % 7 + 1 AS n").where("at % 5 != 3")
    want, rows = {}, sorted(counts.collect())
    for r in rows:
        mine = [x["n"] for x in rows if x["key"] == r["key"]]
        want[r["key"], r["at"]] = (sum(x["n"] for x in rows if x["key"] == r["key"] and x["at"] < r["at"]), sum(mine))
    place = lambda: sorted((str(r["doc_id"]), r["text_crc32"], r["shard"], r["slot"]) for r in sharding.interleave(docs, 4).collect())
    whole = place()
    for block in (3, 16, 1024):
        monkeypatch.setattr(sharding, "BLOCK", block)
        got = {(r["key"], r["at"]): (r["below"], r["of_all"]) for r in sharding._below(counts, ["key"], "at", n).collect()}
        assert got == want
    monkeypatch.setattr(sharding, "BLOCK", 4)
    assert place() == whole
