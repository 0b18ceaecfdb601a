"""Exactly-once appends of micro-batches to the target, by a ledger.

A stream runs a micro-batch again when it isn't sure that it went through. The ledger has one small file per committed
micro-batch, with the largest id in the target after it and the batch's counts; making that file is the commit. Ids only
grow, so rows beyond the newest entry's id are those of an append that wasn't committed: readers leave them out
(:func:`read_committed`), and the next try removes them before it appends. Before an append a note is left, so that rows of
another writer are an error rather than being taken for leftovers.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..operators.ids import max_id, max_id_above
from ..operators.load import append_with_ids
from ..schema import ID_COLUMN, TARGET_SCHEMA

COUNTS = ("records", "bad_records", "articles", "late", "loaded", "extracted", "mapped", "appended")
LEDGER_SCHEMA = "version bigint, stream string, batch_id bigint, last_id bigint, last_seq bigint, last_part_basc_dt string, " + ", ".join(f"{c} bigint" for c in COUNTS)
_OPENING = "opening"


def entries(spark: SparkSession, path: str) -> DataFrame:
    """One row per committed micro-batch, and one for what the target had before the first."""
    if not storage.matches(spark, f"{path}/*.json"):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).json(f"{path}/*.json")


def newest(spark: SparkSession, path: str) -> Row | None:
    return entries(spark, path).agg(F.max(F.struct("version", "last_id")).alias("top")).first().top


def is_committed(spark: SparkSession, path: str, stream: str, batch_id: int) -> bool:
    return storage.exists(spark, f"{path}/{stream}-{batch_id}.json")


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id in a stream's checkpoint: with a new checkpoint, batch numbers start again and mean other batches."""
    return json.loads(storage.first_bytes(spark, f"{checkpoint}/metadata", 1 << 12))["id"]


def commit(spark: SparkSession, path: str, stream: str, batch_id: int, last_id: int, entry: Mapping[str, object]) -> None:
    """Make the entry of a micro-batch; from then on its rows count."""
    top = newest(spark, path)
    row = {"version": 0 if top is None else top.version + 1, "stream": stream, "batch_id": batch_id, "last_id": last_id, **entry}
    storage.create_once(spark, f"{path}/{stream}-{batch_id}.json", json.dumps(row).encode())


def roll_back(spark: SparkSession, target_path: str, last_id: int) -> int:
    """Remove the files of the target with ids beyond ``last_id``; returns how many.

    An append only adds files, so these hold nothing else; otherwise nothing is removed. There are as many as one append has written.
    """
    target = spark.read.schema(TARGET_SCHEMA).parquet(target_path)
    beyond = target.where(F.col(ID_COLUMN) > last_id).select(F.col("_metadata.file_path").alias("file")).distinct()
    files = [r.file for r in beyond.collect()]
    if files:
        known = spark.read.schema(TARGET_SCHEMA).option("basePath", target_path).parquet(*files).where(F.col(ID_COLUMN) <= last_id)
        if not known.isEmpty():
            raise ValueError(f"files of {target_path} hold rows of this and of an earlier append")
    for file in files:
        storage.delete(spark, file)
    return len(files)


def append_once(
    spark: SparkSession, rows: DataFrame, target_path: str, path: str, stream: str, batch_id: int,
    entry: Mapping[str, object] | None = None, stage: str | None = None,
) -> int | None:
    """Append the rows of a micro-batch and commit it; None if it was committed before, else how many rows were new.

    One writer at a time, and every append goes through the ledger: rows beyond it that no open note explains are an error.
    """
    if is_committed(spark, path, stream, batch_id):
        return None
    top = newest(spark, path)
    if top is None:
        had = storage.exists(spark, target_path)
        first = max_id(spark.read.schema(TARGET_SCHEMA).parquet(target_path)).first().max_id if had else 0
        commit(spark, path, _OPENING, 0, first, {})
        top = newest(spark, path)
    note = f"{path}/{stream}-{batch_id}.open"
    if storage.exists(spark, target_path):
        target = storage.read_or_empty(spark, target_path, TARGET_SCHEMA)
        if max_id_above(target, top.last_id) > top.last_id:
            if not storage.exists(spark, note):
                raise ValueError(f"{target_path} has rows that the ledger {path} doesn't know")
            roll_back(spark, target_path, top.last_id)
    storage.create_once(spark, note, b"", replace=True)
    appended, last_id = append_with_ids(spark, rows, target_path, stage=stage, id_floor=top.last_id)
    commit(spark, path, stream, batch_id, last_id, {**(entry or {}), "appended": appended})
    storage.delete(spark, note)
    return appended


def read_committed(spark: SparkSession, target_path: str, path: str) -> DataFrame:
    """The target as far as the ledger goes; file statistics leave out what lies beyond."""
    top = newest(spark, path)
    return storage.read_or_empty(spark, target_path, TARGET_SCHEMA).where(F.col(ID_COLUMN) <= (0 if top is None else top.last_id))


def totals(spark: SparkSession, path: str) -> DataFrame:
    """One row: the number of committed micro-batches and the sums of their counts."""
    own = entries(spark, path).where(F.col("stream") != _OPENING)
    return own.agg(F.count("*").alias("batches"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS))
