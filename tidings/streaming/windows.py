"""Overlapping daily files as one stream of distinct articles, by keyed state instead of a cursor.

Each file repeats the articles of the days before it. The stream keeps the numbers of articles that are younger than a
watermark, in RocksDB on the executors and in the checkpoint, so its state is bounded by the days it looks back and not by
the heap. An article is passed on when it is first seen; files may come in any order within the watermark. What comes after
the watermark has passed its day is left out, and counted.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..functions.text import normalize_date
from ..schema import NEWS_SCHEMA, PARTITION_COLUMN
from ..sources.delimited import FIELD_SEP, RECORD_SEP, record_text, split_fields
from ..sources.news import new_articles

LOOK_BACK = "4 days"
EVENT_DAY = "_event_day"
COUNTS_SCHEMA = "batch_id bigint, records bigint, bad_records bigint, undated bigint, late bigint"
_OBSERVED = "records"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_REPORTS = "spark.sql.streaming.numRecentProgressUpdates"
#: Reports of micro-batches that a run keeps until it stores their counts.
MOST_REPORTS = 100_000


@contextmanager
def state_in_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams that are started inside keep their state in RocksDB, and all their reports."""
    mine = {_PROVIDER: _ROCKSDB, _REPORTS: str(MOST_REPORTS)}
    before = {k: spark.conf.get(k, None) for k in mine}
    for k, v in mine.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def article_stream(
    spark: SparkSession, folder: str, columns: list[str], look_back: str = LOOK_BACK,
    max_files_per_trigger: int | None = None, clean_source: str = "off", archive: str | None = None,
) -> DataFrame:
    """The distinct root articles of delimited files with the layout ``columns``, as a streaming DataFrame.

    An article's day is that of its partition, or else its own date. Records with another number of fields are bad ones;
    articles with neither date are undated; both are counted and left out. A file whose header has the columns in another
    order stops the stream: those are read by ``land_new_articles``.
    """
    reader = spark.readStream.option("lineSep", RECORD_SEP).option("cleanSource", clean_source)
    if archive:
        reader = reader.option("sourceArchiveDir", archive)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    header = FIELD_SEP.join(columns)
    records = reader.text(folder).select(record_text(F.col("value")).alias("value")).where(F.col("value") != "")
    fields = records.where(F.col("value") != header).select(split_fields(F.col("value")).alias("f"))
    other = F.array_sort("f") == F.array_sort(F.array(*map(F.lit, columns)))
    fields = fields.select(F.when(other, F.raise_error(F.lit("a file has its columns in another order"))).otherwise(F.col("f")).alias("f"))
    fits = F.size("f") == len(columns)
    at = {c: F.get("f", F.lit(k)) for k, c in enumerate(columns)}
    day = F.coalesce(*(F.try_to_timestamp(F.replace(normalize_date(at[c]), F.lit("."), F.lit("")), F.lit("yyyyMMdd")) for c in ("part_basc_dt", PARTITION_COLUMN) if c in at))
    dated = fields.select(*(v.alias(c) for c, v in at.items()), fits.alias("_fits"), day.alias(EVENT_DAY)).observe(
        _OBSERVED, F.count("*").alias("records"), F.count_if(~F.col("_fits")).alias("bad_records"),
        F.count_if(F.col("_fits") & F.col(EVENT_DAY).isNull()).alias("undated"))
    kept = dated.where(F.col("_fits") & F.col(EVENT_DAY).isNotNull())
    articles = new_articles(kept, -(1 << 63), "", carried=[EVENT_DAY])
    return articles.withWatermark(EVENT_DAY, look_back).dropDuplicatesWithinWatermark(["seq"])


def _counts(report) -> tuple[int, int, int, int, int]:
    """What a report of a micro-batch says of its rows."""
    told = json.loads(report.json)
    seen = told.get("observedMetrics", {}).get(_OBSERVED, {})
    late = sum(s.get("numRowsDroppedByWatermark", 0) for s in told.get("stateOperators", []))
    return (told["batchId"], seen.get("records") or 0, seen.get("bad_records") or 0, seen.get("undated") or 0, late)


def save_counts(spark: SparkSession, reports: list, path: str) -> None:
    """Store the counts of each reported micro-batch in the folder of its number; a batch run again replaces its own."""
    if len(reports) >= MOST_REPORTS:
        raise RuntimeError(f"a run of {MOST_REPORTS} micro-batches or more doesn't keep all their reports")
    best: dict[int, tuple] = {}
    for r in map(_counts, reports):  # a batch without new files is reported too
        best[r[0]] = max(best.get(r[0], r), r)
    if best:
        rows = spark.createDataFrame([best[k] for k in sorted(best)], COUNTS_SCHEMA).withColumn("batch", F.col("batch_id"))
        rows.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """One row per micro-batch: records, bad_records, undated, late."""
    if not storage.exists(spark, path):
        return spark.createDataFrame([], COUNTS_SCHEMA)
    return spark.read.schema(f"{COUNTS_SCHEMA}, batch bigint").parquet(path).drop("batch")


def land_distinct(
    spark: SparkSession, folder: str, columns: list[str], landed: str, checkpoint: str, look_back: str = LOOK_BACK,
    max_files_per_trigger: int | None = None, clean_source: str = "off", archive: str | None = None,
) -> DataFrame:
    """Drain new files into ``landed``, each article once, and return all that was landed there.

    A later call goes on from the checkpoint with the state of the earlier one. Each micro-batch owns the folder of its
    number, so one that is run again replaces its rows; counts are kept beside, see :func:`read_counts`.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        batch.drop(EVENT_DAY).write.mode("overwrite").parquet(f"{landed}/batch_id={batch_id}")

    with state_in_rocksdb(spark):
        stream = article_stream(spark, folder, columns, look_back, max_files_per_trigger, clean_source, archive)
        query = stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        try:
            query.awaitTermination()
        finally:
            save_counts(spark, query.recentProgress, counts_path(landed))
    return storage.read_or_empty(spark, landed, NEWS_SCHEMA)


def counts_path(landed: str) -> str:
    return f"{landed}-counts"
