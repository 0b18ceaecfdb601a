"""Snapshots with a manifest, and new chunk files by their names."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidings import storage
from tidings.operators import snapshot
from tidings.sources import files


@pytest.fixture
def rows(spark):
    return spark.range(500).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("t"), "id")).alias("odd name"))


def data_files(path):
    return sorted(p for p in path.iterdir() if p.name.startswith("part-"))


def test_a_snapshot_comes_back_whole(spark, rows, tmp_path):
    path = str(tmp_path / "s")
    told = snapshot.write_snapshot(rows, path)
    assert told["rows"] == 500 and told == snapshot.read_manifest(spark, path)
    back = snapshot.read_snapshot(spark, path, check_rows=True)
    assert back.exceptAll(rows).isEmpty() and back.count() == 500
    assert snapshot.write_snapshot(rows.orderBy(F.desc("id")), str(tmp_path / "again"))["digest"] == told["digest"]
    assert snapshot.write_snapshot(rows.where("id > 0"), str(tmp_path / "other"))["digest"] != told["digest"]
    with pytest.raises(FileExistsError):
        snapshot.write_snapshot(rows, path)


def test_an_empty_table(spark, rows, tmp_path):
    told = snapshot.write_snapshot(rows.limit(0), str(tmp_path / "s"))
    assert (told["rows"], told["digest"]) == (0, "0")
    assert snapshot.read_snapshot(spark, str(tmp_path / "s"), check_rows=True).columns == rows.columns


@pytest.mark.parametrize("fault", ["no manifest", "truncated", "lost", "added", "changed"])
def test_an_incomplete_snapshot_is_rejected(spark, rows, tmp_path, fault):
    path = tmp_path / "s"
    snapshot.write_snapshot(rows.repartition(2), str(path))
    first = data_files(path)[0]
    if fault == "no manifest":
        storage.delete(spark, f"{path}/{snapshot.MANIFEST}")
    elif fault == "truncated":
        first.write_bytes(first.read_bytes()[:-20])
    elif fault == "lost":
        first.unlink()
    elif fault == "added":
        (path / "part-new.parquet").write_bytes(first.read_bytes())
    else:  # other rows in a file of the same length
        manifest = snapshot.read_manifest(spark, str(path))
        storage.create_once(spark, f"{path}/{snapshot.MANIFEST}", snapshot.json.dumps({**manifest, "digest": "1"}).encode(), replace=True)
        assert snapshot.read_snapshot(spark, str(path)).count() == 500
    with pytest.raises(snapshot.IncompleteSnapshot):
        snapshot.read_snapshot(spark, str(path), check_rows=fault == "changed")


def test_files_that_are_done_are_not_opened(spark, tmp_path):
    folder = tmp_path / "chunks"
    for n in (1, 2, 10, 11):
        spark.range(n, n + 3).coalesce(1).write.parquet(str(tmp_path / f"w{n}"))
        storage.move(spark, str(data_files(tmp_path / f"w{n}")[0]), f"{folder}/chunk_{n}.parquet")
    (folder / "chunk_3.parquet.bad").write_text("not parquet")
    (folder / "chunk_1.parquet").write_text("opening this one fails")
    out = files.read_new_chunks(spark, str(folder), 2, "id bigint")
    assert sorted((r.id, r.chunk_idx) for r in out.collect()) == sorted((n + k, n) for n in (10, 11) for k in range(3))
    scan = out._jdf.queryExecution().executedPlan()
    while scan.getClass().getSimpleName() != "FileSourceScanExec":
        scan = scan.children().apply(0)
    assert scan.metrics().get("numFiles").get().value() == 2
    assert files.read_new_chunks(spark, str(folder), 11, "id bigint").count() == 0
