"""Streams: distinct articles by keyed state, exactly-once appends, counts of micro-batches."""

from __future__ import annotations

import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidings import storage
from tidings.operators import load
from tidings.schema import TARGET_SCHEMA
from tidings.sources.delimited import FIELD_SEP
from tidings.streaming import incremental, ledger, windows

COLUMNS = ["seq", "title", "content", "part_basc_dt", "basc_dt"]


@pytest.fixture
def feed(tmp_path):
    (tmp_path / "in").mkdir()

    def put(name, *rows, head=COLUMNS):
        records = [FIELD_SEP.join(head), *(FIELD_SEP.join(r) for r in rows)]
        (tmp_path / "in" / name).write_text("||".join(records) + "||")

    return put


def row(seq, day, date="2026.01.01"):
    return [str(seq), f"t{seq}", "c", day, date]


def drain(spark, tmp_path, **settings):
    where = [str(tmp_path / n) for n in ("in", "landed", "state")]
    out = windows.land_distinct(spark, where[0], COLUMNS, *where[1:], **settings)
    return sorted(r.seq for r in out.collect()), where[1]


def test_articles_of_overlapping_files_come_once_and_state_outlives_a_run(spark, tmp_path, feed):
    feed("a", row(1, "20260101"), row(2, "20260101"), row(2, "20260101"), ["short"])
    feed("b", row(2, "20260101"), row(3, "20260103"), row(4, "", "2026.01.02"), row(5, "", "soon"))
    seqs, landed = drain(spark, tmp_path)
    assert seqs == [1, 2, 3, 4]
    feed("c", row(3, "20260103"), row(6, "20260104"))
    assert drain(spark, tmp_path)[0] == [1, 2, 3, 4, 6]
    assert drain(spark, tmp_path)[0] == [1, 2, 3, 4, 6]  # nothing new
    sums = windows.read_counts(spark, windows.counts_path(landed)).groupBy().sum("records", "bad_records", "undated", "late").first()
    assert tuple(sums) == (10, 1, 1, 0)


def test_rows_behind_the_watermark_are_counted(spark, tmp_path, feed):
    for k, day in enumerate(("20260101", "20260120", "20260121")):
        feed(f"f{k}", row(k, day))
        drain(spark, tmp_path)
    feed("late", row(10, "20260105"), row(11, "20260119"), row(0, "20260101"))
    seqs, landed = drain(spark, tmp_path)
    assert seqs == [0, 1, 2, 11]
    counts = windows.read_counts(spark, windows.counts_path(landed))
    assert counts.agg(F.sum("late"), F.sum("records")).first()[:] == (2, 6)


def test_state_is_kept_by_rocksdb_and_settings_are_restored(spark, tmp_path, feed):
    feed("a", row(1, "20260101"))
    drain(spark, tmp_path)
    offsets = (tmp_path / "state" / "offsets" / "0").read_text()
    assert "RocksDBStateStoreProvider" in offsets
    assert spark.conf.get(windows._PROVIDER).rpartition(".")[2] != "RocksDBStateStoreProvider"


def test_another_order_of_columns_stops_the_stream(spark, tmp_path, feed):
    feed("a", ["c", "2026.01.01", "20260101", "t1", "1"], head=COLUMNS[::-1])
    with pytest.raises(StreamingQueryException, match="another order"):
        drain(spark, tmp_path)


@pytest.fixture
def target(spark, tmp_path):
    path, book = str(tmp_path / "target"), str(tmp_path / "ledger")

    def rows(*seqs):
        return spark.createDataFrame([(s, "1", f"2026.01.0{1 + s % 3}") for s in seqs], "seq bigint, etct_cust_no string, basc_dt string")

    def append(batch, *seqs, stream="s", **entry):
        return ledger.append_once(spark, rows(*seqs), path, book, stream, batch, entry)

    append.path, append.ledger, append.rows = path, book, rows
    append.seen = lambda: sorted((r.news_mppg_id, r.seq) for r in ledger.read_committed(spark, path, book).collect())
    append.stored = lambda: sorted(r.seq for r in storage.read_or_empty(spark, path, TARGET_SCHEMA).collect())
    return append


def test_a_batch_is_appended_once(spark, target):
    assert target(0, 1, 2, 3, records=3, bad_records=1) == 3
    assert target(0, 1, 2, 3) is None and target(0, 9) is None  # the number decides
    assert target(1, 3, 4, records=2) == 1
    assert target(0, 5, stream="another checkpoint") == 1
    assert target.seen() == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5)]
    totals = ledger.totals(spark, target.ledger).first()
    assert (totals.batches, totals.records, totals.bad_records, totals.appended) == (3, 5, 1, 5)


def test_an_append_without_a_commit_is_not_seen_and_is_done_again(spark, target, monkeypatch):
    target(0, 1, 2)
    real = ledger.commit
    with monkeypatch.context() as m:
        m.setattr(ledger, "commit", lambda *args: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            target(1, 3, 4)
    assert target.stored() == [1, 2, 3, 4] and target.seen() == [(1, 1), (2, 2)]
    assert ledger.commit is real and target(1, 3, 4, 5) == 3
    assert target.stored() == [1, 2, 3, 4, 5] and target.seen() == [(k, k) for k in range(1, 6)]


def test_rows_that_were_there_before_stay(spark, target):
    load.append_with_ids(spark, target.rows(1, 2), target.path)
    assert target(0, 2, 3) == 1
    assert target.seen() == [(1, 1), (2, 2), (3, 3)]


def test_another_writer_is_an_error(spark, target):
    target(0, 1)
    load.append_with_ids(spark, target.rows(7), target.path)
    with pytest.raises(ValueError, match="doesn't know"):
        target(1, 2)
    assert target.stored() == [1, 7]


def test_empty_batches_and_an_empty_ledger(spark, target):
    assert target.seen() == []
    assert target(0) == 0 and target(1, 1) == 1 and target(2) == 0
    assert target.seen() == [(1, 1)] and ledger.totals(spark, target.ledger).first().batches == 3


def test_files_are_made_once(spark, tmp_path):
    path = str(tmp_path / "x.json")
    storage.create_once(spark, path, b"1")
    with pytest.raises(FileExistsError):
        storage.create_once(spark, path, b"2")
    assert storage.first_bytes(spark, path, 9) == b"1"
    storage.create_once(spark, path, b"3", replace=True)
    assert storage.first_bytes(spark, path, 9) == b"3"


def test_the_stream_of_a_checkpoint(spark, tmp_path, feed):
    feed("a", row(1, "20260101"))
    drain(spark, tmp_path)
    assert ledger.stream_id(spark, str(tmp_path / "state")) == json.loads((tmp_path / "state" / "metadata").read_text())["id"]


def test_counts_of_landed_batches(spark, tmp_path, feed):
    feed("a", row(1, "20260101"), row(12, "20260106"), ["short"])
    args = (spark, str(tmp_path / "in"), COLUMNS, str(tmp_path / "landed"), str(tmp_path / "state"))
    incremental.land_new_articles(*args, (10, "20260105"))
    assert tuple(incremental.landed_counts(spark, args[3]).first()) == (3, 1, 2, 1)
    storage.delete(spark, f"{args[4]}/commits/0")  # the batch runs again
    feed("b", row(12, "20260106"), row(13, "20260106"))
    incremental.land_new_articles(*args, (10, "20260105"))
    assert tuple(incremental.landed_counts(spark, args[3]).first()) == (5, 1, 4, 1)
    feed("c", row(13, "20260106"))
    incremental.land_new_articles(*args, (13, "20260106"))
    assert tuple(incremental.landed_counts(spark, args[3], (13, "20260106")).first()) == (1, 0, 1, 1)
    assert tuple(incremental.landed_counts(spark, str(tmp_path / "none")).first()) == (0, 0, 0, 0)
