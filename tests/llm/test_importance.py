from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidings.llm import importance


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def features(text):
    words = re.findall(importance.WORD, lowered(text))
    return words, [*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10000


def brute(docs, items, percent=25, seed=7):
    s, t = (Counter(bucket(f) for text in texts for f in features(text)[1]) for texts in ([x for _, x in docs], items))
    every_s, every_t = s.total() + 10000, t.total() + 10000
    rows = []
    for d, text in docs:
        words, found = features(text)
        total = sum(math.floor(1000 * math.log((t[b] + 1) * every_s / ((s[b] + 1) * every_t))) for b in map(bucket, found))
        weight = total // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append((len(words) >= 20, d, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[0]), key=lambda r: (-r[4], r[1] is None, r[1], r[2]))
    drawn = {id(r): k for k, r in enumerate(able[: percent * len(able) // 100], 1)}
    return [(*r[1:], drawn.get(id(r))) for r in rows]


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([("w1 w2 w3 passage",), (None,), ("",), ("W1 Éa x 同",)], "text string")


def test_report_against_brute_force(docs, target):
    got = [tuple(r) for r in importance.report(docs, target).collect()]
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], [r["text"] for r in target.collect()])
    assert sorted(got, key=str) == sorted(want, key=str)
    assert any(r[4] for r in got)


def test_windows_of_offset_pairs():
    splitter = importance.Splitter()
    for text in ("", "one", "é\x00à b--c 9", "x\x7fy 日本 語", "ÀÉ ab\ncd", " lead  and tail "):
        words, found = features(text)
        raw = lowered(text).encode()
        assert [(w, raw[a:b].decode()) for w, (a, b), _ in splitter.words(lowered(text))] == [(w, w) for w in words]
        n, buckets = splitter.buckets(lowered(text))
        assert n == len(words) and buckets.tolist() == [bucket(f) for f in found]


def test_a_very_long_text_and_ties(spark, target):
    rows = [(k, "tie " * 30) for k in range(20)] + [(99, "long w1 w2 " * 40000)]
    got = {r["doc_id"]: r for r in importance.report(spark.createDataFrame(rows, "doc_id long, text string"), target).collect()}
    assert got[99]["n_features"] == 240000 - 1
    assert sorted(r["rank"] for r in got.values() if r["rank"]) == [1, 2, 3, 4, 5]


def test_empty_tables(spark, docs, none, target):
    assert importance.report(none, target).count() == 0
    no_target = importance.report(docs, target.limit(0)).collect()
    assert sorted(map(tuple, no_target), key=str) == sorted(brute([(r["doc_id"], r["text"]) for r in docs.collect()], []), key=str)
    nulls = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert [(r["n_features"], r["weight"], r["rank"]) for r in importance.report(nulls, target.limit(0)).collect()] == [(0, 0, None)] * 2


def test_drawn_rows_keep_their_columns(docs, target):
    out = importance.resample(docs, target, 50)
    assert out.columns == docs.columns
    drawn = sorted(r["doc_id"] for r in importance.with_draw(docs, target, 50).where("draw.rank IS NOT NULL").collect())
    assert sorted(r["doc_id"] for r in out.collect()) == drawn != []
    assert out.exceptAll(docs).count() == 0
    with pytest.raises(ValueError):
        importance.with_draw(docs.withColumn("draw", F.lit(1)), target)


def test_texts_like_the_target_are_drawn_more_often(spark):
    near, far = " ".join(f"near{k % 7}" for k in range(30)), " ".join(f"far{k % 7}" for k in range(30))
    rows = spark.range(400).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, near).otherwise(far).alias("text"))
    out = importance.resample(rows, spark.createDataFrame([(near,)] * 50, "text string"))
    assert out.count() == 100 and out.where("doc_id % 2 = 0").count() > 90
