"""Feeds of several files: how the registered queries write them, and patterns that name them."""

from __future__ import annotations

import os

import pytest

from checks import queries
from tidings import storage
from tidings.plans import daily
from tidings.sources import delimited, files

SF_DIR = "/root/testdata/sf0.001"


def test_a_large_part_is_several_files_with_a_header_each(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "_FILE_BYTES", 4000, raising=False)
    rows = spark.createDataFrame([(str(k), None if k % 7 == 0 else f"text {k} " * 5) for k in range(400)], "seq string, content string")
    queries._write_delimited(rows, str(tmp_path / "feed"), 2)
    named = storage.files_at(spark, str(tmp_path / "feed/part=*"))
    assert {f.rpartition("/")[0][-6:] for f in named} == {"part=0", "part=1"} and len(named) > 4
    for f in named:
        assert os.path.getsize(f.removeprefix("file:")) < 3 * 4000
        assert delimited.file_header(spark, f) == f"seq{delimited.FIELD_SEP}content"
    back = delimited.read_delimited(spark, str(tmp_path / "feed/part=*"))
    assert sorted(map(tuple, back.collect())) == sorted((r.seq, r.content or "") for r in rows.collect())


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", ["stream_counts", "stream_overlap"])
def test_results_do_not_depend_on_the_number_of_files(spark, monkeypatch, name):
    want = sorted(map(str, queries.QUERIES[name](spark, SF_DIR).collect()))
    monkeypatch.setattr(queries, "_FILE_BYTES", 40_000)
    assert sorted(map(str, queries.QUERIES[name](spark, SF_DIR).collect())) == want


def test_a_pattern_names_input_files_and_only_those_that_were_read_are_removed(spark, tmp_path):
    for k in range(2):
        (tmp_path / f"news-{k}.csv").write_text(f"seq{delimited.FIELD_SEP}title||{k}{delimited.FIELD_SEP}a||")
    pattern = str(tmp_path / "news-*.csv")
    assert files.is_delimited(spark, pattern) and not files.is_delimited(spark, str(tmp_path / "other-*.csv"))
    assert sorted(r.seq for r in files.read_feed(spark, pattern).collect()) == ["0", "1"]
    run = daily._Run(spark, daily.Layout(str(tmp_path / "w")), daily.Models(str), str(tmp_path / "run"), 0.5, False)
    inputs = run.note_inputs(pattern, None)
    (tmp_path / "news-1.csv").write_text("another")
    (tmp_path / "news-2.csv").write_text("later")
    assert [f.rpartition("/")[2] for f in daily.remove_delimited_inputs(spark, inputs)] == ["news-0.csv"]
    assert sorted(f.name for f in tmp_path.glob("*.csv")) == ["news-1.csv", "news-2.csv"]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_daily_files_move_an_article_once(spark, tmp_path, monkeypatch):
    """Each day's files hold the articles of four days, whole; what is shuffled is each article once."""
    monkeypatch.setattr(queries, "_FILE_BYTES", 8000, raising=False)
    path = str(tmp_path / "days")
    for first, last in ((1, 14), (15, 28)):
        queries._daily_files(spark, SF_DIR, first, last, path)
    feed = queries.view(spark, SF_DIR, "v_news").where("part_basc_dt IS NOT NULL").select("seq", "part_basc_dt").collect()
    for k in (1, 14, 15, 28):
        got = delimited.read_delimited(spark, f"{path}/part={k}", queries.NEWS_FEED_COLUMNS)
        assert sorted(int(r.seq) for r in got.collect()) == sorted(r.seq for r in feed if k - 3 <= int(r.part_basc_dt[6:8]) <= k)
        named = storage.files_at(spark, f"{path}/part={k}")
        assert all(delimited.file_header(spark, f) == delimited.FIELD_SEP.join(queries.NEWS_FEED_COLUMNS) for f in named)
        assert len(named) >= min(k, 4)
        assert sum(x == f"1{delimited.FIELD_SEP}1" for f in named for x in open(f.removeprefix("file:"), encoding="utf-8").read().split("||")) == 1
