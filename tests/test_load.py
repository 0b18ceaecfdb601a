from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidings import storage
from tidings.operators import ids, load, quality, retention, serving, state
from tidings.schema import TARGET_SCHEMA

NEW = "seq bigint, etct_cust_no string, basc_dt string"


def target(spark, path):
    return storage.read_or_empty(spark, str(path), TARGET_SCHEMA)


@pytest.mark.parametrize("n", [0, 1, 7, 5000])
def test_ids_are_dense_and_in_order(spark, n):
    shuffled = spark.range(n).select(((F.col("id") * 7919) % max(n, 1)).alias("k")).repartition(5)
    out = [(r.k, r.nr) for r in ids.with_dense_ids(shuffled, ["k"], "nr", start=10).collect()]
    assert sorted(out) == [(i, i + 11) for i in range(n)]


def test_ids_under_a_hot_sort_key(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    out = ids.with_dense_ids(df, ["k", "id"], "nr").collect()
    assert [r.id for r in sorted(out, key=lambda r: r.nr)] == [r.id for r in sorted(out, key=lambda r: (r.k, r.id))]
    assert sorted(r.nr for r in out) == list(range(1, 9001))


def test_chunks(spark):
    out = ids.with_chunk_index(spark.range(25).toDF("k"), ["k"], 10).collect()
    assert all(r.chunk_idx == r.k // 10 for r in out)


def test_append_continues_and_repeats_add_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(2, "a", "2026.01.01"), (1, "b", "2026.01.01"), (3, None, "2026.01.02")], NEW)
    assert load.append_with_ids(spark, first, path) == (3, 3)
    assert load.append_with_ids(spark, first, path) == (0, 3)
    more = first.unionByName(spark.createDataFrame([(2, "c", "2026.01.01"), (9, "a", None)], NEW))
    assert load.append_with_ids(spark, more, path, id_floor=2) == (2, 5)
    got = sorted((r.news_mppg_id, r.seq, r.etct_cust_no) for r in target(spark, path).collect())
    assert got == [(1, 1, "b"), (2, 2, "a"), (3, 3, None), (4, 2, "c"), (5, 9, "a")]
    assert load.append_with_ids(spark, first.limit(0), path, id_floor=5) == (0, 5)


def test_the_loaded_check_reads_only_the_span_of_the_new_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    load.append_with_ids(spark, spark.createDataFrame([(i, "a", "2026.01.01") for i in range(50)], NEW), path)
    fresh = load.not_loaded(spark.createDataFrame([(40, "a", "x"), (60, "a", "x")], NEW), target(spark, path))
    plan = fresh._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(seq,40)" in plan and "LessThanOrEqual(seq,60)" in plan
    assert [r.seq for r in fresh.collect()] == [60]


def test_max_id(spark):
    assert ids.max_id(spark.createDataFrame([], TARGET_SCHEMA)).first().max_id == 0


CLASSES = [
    ("FINANCE", "1", True), (" risk ", "1", True), ("NOISE", "1", False), (" noise ", "1", False), (None, "1", False),
    ("", "1", False), ("nan", "1", False), ("RISK", None, False), ("RISK", " ", False), ("RISK", "None", False), ("RISK", "NOISE", True),
]


def test_serving_rows(spark, tmp_path):
    df = spark.createDataFrame(
        [(i, c, s, f"2026.01.0{i % 3 + 1}") for i, (c, s, _) in enumerate(CLASSES)],
        "seq bigint, news_clas string, doc_sentiment string, basc_dt string",
    )
    kept = {i for i, c in enumerate(CLASSES) if c[2]}
    assert {int(r.seq) for r in serving.serving_rows(df).collect()} == kept
    path = str(tmp_path / "s")
    serving.export_serving(df, path)
    read = lambda: {(int(r.seq), r.basc_dt) for r in spark.read.option("inferSchema", "false").parquet(path).collect()}
    before = read()
    assert {s for s, _ in before} == kept
    # Only the named day is replaced.
    serving.export_serving(df.withColumn("seq", F.col("seq") + 100), path, spark.createDataFrame([("2026.01.01",)], "basc_dt string"))
    assert read() == {(s + 100 if d == "2026.01.01" else s, d) for s, d in before}


def test_articles_without_a_day_are_served_too(spark, tmp_path):
    schema = "seq bigint, news_clas string, doc_sentiment string, basc_dt string"
    path = str(tmp_path / "s")
    df = spark.createDataFrame([(1, "RISK", "1", "2026.01.01"), (2, "RISK", "1", None)], schema)
    serving.export_serving(df, path, spark.createDataFrame([("2026.01.01",), (None,)], "basc_dt string"))
    assert sorted(r.seq for r in spark.read.parquet(path).collect()) == ["1", "2"]


def test_cursor(spark, tmp_path):
    path = str(tmp_path / "c")
    assert state.load_cursor(spark, path) == (0, "20260101")
    state.save_cursor(spark, path, 10, "20260105")
    state.save_cursor(spark, path, 5, "20260106")
    assert state.load_cursor(spark, path) == (5, "20260106") and state.load_last_id(spark, path) == 0
    state.save_published_id(spark, path, 3)
    assert state.load_cursor(spark, path) == (5, "20260106") and state.load_published_id(spark, path) == 3
    state.save_cursor(spark, path, 6, "20260107", 9)
    assert (state.load_published_id(spark, path), state.load_last_id(spark, path)) == (3, 9)
    df = spark.createDataFrame([(1, "20260109"), (7, "20260103"), (7, "20260104")], "seq bigint, part_basc_dt string")
    assert tuple(state.next_cursor(df).first()) == (7, "20260104")


def test_retention(spark, tmp_path):
    for name in ("20260101", "20260116", "20260130", "notaday", "20269999"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x").write_text("x")
    assert retention.remove_expired(spark, str(tmp_path), "20260130") == ["20260101"]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["20260116", "20260130", "20269999", "notaday"]
    assert retention.remove_expired(spark, str(tmp_path / "none")) == []


def test_quality(rows):
    mentions = rows("seq int, cust_no string", (1, "a"), (2, None))
    assert tuple(quality.mapping_rate(mentions).first()) == (2, 1, 0.5)
    assert quality.mapping_rate(mentions.limit(0)).first().mapping_rate is None
    audit = quality.duplicate_audit(rows(NEW, (1, "a", "d"), (1, "a", "d"), (2, "a", "d")))
    assert [tuple(r) for r in audit.collect()] == [(1, "a", 2)]
    counts = quality.stage_counts(one=mentions, none=mentions.limit(0))
    assert {r.stage: r.n_rows for r in counts.collect()} == {"one": 2, "none": 0}
