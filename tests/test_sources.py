from __future__ import annotations

import pytest
from pyspark.sql import Observation

from tidings.operators import load, retention
from tidings.schema import NEWS_COLUMNS, TARGET_COLUMNS
from tidings.sources import company, delimited, files, news, warehouse
from tidings.streaming import incremental

SEP = delimited.FIELD_SEP


def put(folder, name, text, encoding="utf-8"):
    path = folder / name
    path.write_bytes(text if isinstance(text, bytes) else text.encode(encoding))
    return str(path)


def read(spark, path, **kwargs):
    df = delimited.read_delimited(spark, path, **kwargs)
    return df.columns, sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize(
    "text, columns, expected",
    [
        (f"a{SEP}b||1{SEP}x\ny||2{SEP}z", ["a", "b"], [("1", "x\ny"), ("2", "z")]),
        (f"a{SEP}b||1{SEP}x||2", ["a", "b"], [("1", "x")]),
        (f"a{SEP}b||||1{SEP}x||\n", ["a", "b"], [("1", "x")]),
        (f"a{SEP}b||1{SEP}x\n", ["a", "b"], [("1", "x")]),
        (f"a{SEP}b", ["a", "b"], []),
        ("", [], []),
        (f"a{SEP}b||1{SEP}x\r\ny||2{SEP}", ["a", "b"], [("1", "x\ny"), ("2", "")]),
        (f"a{SEP}b||1{SEP}".encode() + b"\xff\xfe", ["a", "b"], [("1", "��")]),
    ],
)
def test_delimited_records(spark, tmp_path, text, columns, expected):
    path = put(tmp_path, "f.csv", text)
    assert read(spark, path) == (columns, expected)


def test_known_layout_needs_no_header_pass_and_counts_bad_records(spark, tmp_path):
    path = put(tmp_path, "f.csv", f"a{SEP}b||1{SEP}x||2||3{SEP}y")
    seen = Observation()
    df = delimited.read_delimited(spark, path, ["a", "b"], observation=seen)
    assert sorted(tuple(r) for r in df.collect()) == [("1", "x"), ("3", "y")]
    assert seen.get == {"bad_records": 1, "good_records": 2}


def test_a_known_layout_is_mapped_by_each_files_header(spark, tmp_path):
    put(tmp_path, "1.csv", f"title{SEP}seq||hello{SEP}7")
    put(tmp_path, "2.csv", f"seq{SEP}title||8{SEP}there||bad")
    put(tmp_path, "3.csv", "")
    seen = Observation()
    df = delimited.read_delimited(spark, str(tmp_path / "*.csv"), ["seq", "title"], observation=seen)
    assert sorted(map(tuple, df.collect())) == [("7", "hello"), ("8", "there")] and seen.get["bad_records"] == 1
    put(tmp_path, "4.csv", f"seq{SEP}other||1{SEP}x")
    with pytest.raises(ValueError, match="other"):
        delimited.read_delimited(spark, str(tmp_path), ["seq", "title"])


def test_each_byte_is_scanned_once(spark, tmp_path):
    put(tmp_path, "1.csv", f"a{SEP}b||1{SEP}x")
    for columns in (None, ["b", "a"]):
        plan = delimited.read_delimited(spark, str(tmp_path), columns)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_a_long_header_is_found(spark, tmp_path):
    names = [f"column_{k}" for k in range(9000)]
    path = put(tmp_path, "f.csv", "||\n||" + SEP.join(names) + "||" + SEP.join("v" * 9000))
    assert delimited.file_layouts(spark, path) == {SEP.join(names): [f"file:{path}"]}


def test_files_of_different_layouts_are_united_by_name(spark, tmp_path):
    put(tmp_path, "1.csv", f"a{SEP}b||1{SEP}x||bad")
    put(tmp_path, "2.csv", f"b{SEP}a||y{SEP}2")
    put(tmp_path, "3.csv", f"c{SEP}a||z{SEP}3")
    df = files.read_feed(spark, str(tmp_path))
    got = {r.a: (r.b, r.c) for r in df.select("a", "b", "c").collect()}
    assert got == {"1": ("x", None), "2": ("y", None), "3": (None, "z")}


def test_large_file_is_split_and_still_whole(spark, tmp_path):
    body = "||".join(f"{i}{SEP}text {i}\nmore" for i in range(5000))
    path = put(tmp_path, "big.csv", f"a{SEP}b||{body}")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        df = delimited.read_delimited(spark, path)
        assert df.rdd.getNumPartitions() > 3
        assert {int(r.a) for r in df.collect()} == set(range(5000)) and df.count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_feed_choice(spark, tmp_path):
    assert files.read_feed(spark, str(tmp_path / "none")).columns == []
    folder = tmp_path / "mixed"
    folder.mkdir()
    assert files.read_feed(spark, str(folder)).columns == []
    spark.createDataFrame([(1, "x")], "n bigint, s string").write.parquet(str(tmp_path / "p"))
    assert files.read_feed(spark, str(tmp_path / "p")).columns == ["n", "s"]
    put(folder, "a.csv", f"a{SEP}b||1{SEP}x")
    put(folder, "ignored.parquet", "not parquet")
    assert files.read_feed(spark, str(folder)).columns == ["a", "b"]


NEWS_ROWS = [
    ("11", "11", "NEWS", "t", "20260105", True, True),
    ("11", "11", "news", "t", "20260105", True, False),
    ("12", "11", "NEWS", "t", "20260106", False, False),
    ("13", "13", "BLOG", "t", "20260106", False, False),
    ("14", "14", "NEWS", " ", "20260106", False, True),
    ("10", "10", "NEWS", "t", "20260106", False, False),
    ("15", "15", "NEWS", "t", "20260104", False, False),
    ("16", "16", "NEWS", "t", None, True, False),
    ("x", "x", "NEWS", "t", "20260106", False, False),
    ("17", "17", "NEWS", "t", "", False, False),
    ("18.0", "18", "NEWS", "t", "20260106", True, None),
]


def test_increment_of_text_rows(spark):
    df = spark.createDataFrame([r[:5] for r in NEWS_ROWS], "seq string, p_seq string, channel string, title string, part_basc_dt string")
    out = news.new_articles(df, 10, "20260105")
    assert out.columns == NEWS_COLUMNS
    assert sorted(r.seq for r in out.collect()) == [11, 11, 16, 18]
    seen = Observation()
    assert news.new_articles(df, 10, "20260105", observation=seen).count() == 4
    assert seen.get == {"articles": 7, "late": 3}
    strict = news.new_articles(df, 10, "20260105", null_partition_passes=False)
    assert sorted(r.seq for r in strict.collect()) == [11, 11, 18]


def test_increment_of_a_table(spark):
    whole = [(int(r[0]), int(r[1]), *r[2:5], "s", "d", "c", None) for r in NEWS_ROWS if r[0].isdigit()]
    df = spark.createDataFrame(
        whole,
        "seq bigint, p_seq bigint, channel string, title string, part_basc_dt string, "
        "site_name string, basc_dt string, content string, doc_sentiment string",
    )
    assert sorted(r.seq for r in news.new_articles(df, 10, "20260105").collect()) == [11, 11, 16]
    df.createOrReplaceTempView("news_rows")
    assert sorted(r.seq for r in warehouse.daily_news(spark, "news_rows", 10, "20260105").collect()) == [11, 14]
    assert warehouse.daily_news(spark, "news_rows", 10, "20260105", limit=1).count() == 1
    assert warehouse.window_start(4, "20260302") == "20260227"
    recent = warehouse.recent_news(spark, "news_rows", 2, "20260106")
    assert sorted(r.seq for r in recent.collect()) == [10, 11, 14]
    assert warehouse.whole_table(spark, "news_rows", 2).count() == 2


def plan_of(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_increment_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "n")
    spark.range(10).selectExpr(
        "id AS seq", "id AS p_seq", "'NEWS' AS channel", "'t' AS title", "'20260106' AS part_basc_dt",
        "'s' AS site_name", "'d' AS basc_dt", "'c' AS content", "'x' AS doc_sentiment", "'u' AS unused",
    ).write.parquet(path)
    new = news.load_new_articles(spark, path, 5, "20260105")
    plan = plan_of(new)
    print(plan)
    assert "GreaterThan(seq,5)" in plan and "GreaterThanOrEqual(part_basc_dt,20260105)" in plan
    assert "unused" not in plan.split("ReadSchema")[-1]


def test_fetch_turns_empty_text_to_null(spark):
    spark.createDataFrame([(1, ""), (2, "x")], "n bigint, s string").createOrReplaceTempView("some_rows")
    out = warehouse.fetch(spark, "SELECT * FROM some_rows WHERE n >= :low", low=1)
    assert {r.n: r.s for r in out.collect()} == {1: None, 2: "x"}


def test_company_numbers_keep_leading_zeros(spark, tmp_path):
    put(tmp_path, "c.csv", f"cust_no{SEP}cust_nm|| 0012 {SEP}A")
    assert company.load_companies(spark, str(tmp_path)).first().cust_no == "0012"


def test_numbered_files(spark, tmp_path):
    for name in ("chunk_1.parquet", "chunk_02.parquet", "chunk_10.parquet", "chunk_x.parquet", "chunk_11.parquet.tmp"):
        put(tmp_path, name, "x")
    found = files.new_numbered_files(files.list_files(spark, str(tmp_path)), 1)
    assert sorted((r.chunk_idx, r.file_name) for r in found.collect()) == [(2, "chunk_02.parquet"), (10, "chunk_10.parquet")]


def test_stream_takes_each_file_once_and_equals_the_batch(spark, tmp_path):
    feed = tmp_path / "feed"
    feed.mkdir()
    columns = ["seq", "p_seq", "channel", "title", "part_basc_dt"]
    head = SEP.join(columns)
    line = lambda n, day: SEP.join([str(n), str(n), "NEWS", f"t{n}", day])
    put(feed, "1.csv", "||".join([head, line(9, "20260105"), line(11, "20260105")]))
    # The second file has its columns in another order.
    turned = lambda text: SEP.join(reversed(text.split(SEP)))
    put(feed, "2.csv", "||".join(map(turned, [head, line(12, "20260106"), line(13, "20260104")])))
    args = (spark, str(feed), columns, str(tmp_path / "landed"), str(tmp_path / "state"))
    landed = incremental.land_new_articles(*args, (10, "20260105"), max_files_per_trigger=1)
    batch = news.load_new_articles(spark, str(feed), 10, "20260105")
    assert sorted(map(tuple, landed.collect())) == sorted(map(tuple, batch.collect()))
    # The next file repeats article 12; the cursor of the next run leaves only the new one.
    put(feed, "3.csv", "||".join([head, line(12, "20260106"), line(14, "20260106")]))
    again = incremental.land_new_articles(*args, (12, "20260106"))
    assert sorted(r.seq for r in again.collect()) == [11, 12, 14]
    # Batches wholly behind the cursor go, but for the newest.
    assert incremental.prune_landed(spark, str(tmp_path / "landed"), (12, "20260106")) == ["batch_id=0", "batch_id=1"]
    assert incremental.prune_landed(spark, str(tmp_path / "landed"), (14, "20260106")) == []


def test_catalog_table(spark, tmp_path):
    load.create_target_table(spark, "news_target", str(tmp_path / "t"))
    rows = spark.createDataFrame(
        [(2, "a\nb", "0001", "2026.01.05"), (1, "c", "0002", "2026.01.06")],
        "seq bigint, news_tite string, etct_cust_no string, basc_dt string",
    )
    assert load.insert_with_ids(spark, rows, "news_target") == 2
    assert load.insert_with_ids(spark, rows.limit(1), "news_target") == 1
    out = spark.table("news_target")
    assert out.columns == TARGET_COLUMNS
    got = sorted((r.news_mppg_id, r.seq) for r in out.collect())
    assert [i for i, _ in got] == [1, 2, 3] and got[0][1] == 1
    assert {r.news_tite for r in out.where("seq = 2").collect()} == {"a b"}
    spark.sql("DROP TABLE news_target")


@pytest.mark.parametrize("remove_files", [False, True])
def test_expired_partitions_leave_the_catalog(spark, tmp_path, remove_files):
    name = f"kept_{int(remove_files)}"
    load.create_target_table(spark, name, str(tmp_path / "t"))
    days = ["2026.01.01", "2026.01.13", "2026.01.14", None, "it's odd", "2026.13.99"]
    rows = spark.createDataFrame([(k, "1", d) for k, d in enumerate(days)], "seq bigint, etct_cust_no string, basc_dt string")
    load.insert_with_ids(spark, rows, name)
    assert {r.basc_dt for r in retention.catalog_partitions(spark, name).collect()} == set(days)
    drop = lambda: retention.drop_expired_partitions(spark, name, "20260128", 14, remove_files=remove_files)
    assert drop() == days[:2] and drop() == []
    assert {r.basc_dt for r in spark.table(name).collect()} == set(days[2:])
    assert {r.basc_dt for r in retention.catalog_partitions(spark, name).collect()} == set(days[2:])
    assert (tmp_path / "t" / "basc_dt=2026.01.01").exists() is not remove_files and (tmp_path / "t" / "basc_dt=2026.01.14").exists()
    spark.sql(f"DROP TABLE {name}")


def test_taken_files_are_archived_when_the_next_batch_begins(spark, tmp_path):
    feed = tmp_path / "feed"
    feed.mkdir()
    columns = ["seq", "title", "part_basc_dt"]
    record = lambda n: "||".join([SEP.join(columns), SEP.join([str(n), "t", "20260106"])])
    args = (spark, str(feed), columns, str(tmp_path / "landed"), str(tmp_path / "state"), (0, "20260101"))
    for n, left in ((1, ["1.csv"]), (2, ["2.csv"]), (3, ["3.csv"])):
        put(feed, f"{n}.csv", record(n))
        out = incremental.land_new_articles(*args, clean_source="archive", archive=str(tmp_path / "archive"))
        assert sorted(r.seq for r in out.collect()) == list(range(1, n + 1))
        assert sorted(p.name for p in feed.iterdir() if p.name[0] != ".") == left
    assert sorted(p.name for p in (tmp_path / "archive").rglob("*.csv") if p.name[0] != ".") == ["1.csv", "2.csv"]
