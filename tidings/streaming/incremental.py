"""Landing new delimited files as a stream.

The file source's checkpoint takes every file once. Daily files overlap, so the same article returns
in a later file; the cursor filter removes it. The cursor is fixed while one run drains its files and
moves only when the caller saves it, as in a batch run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .. import storage
from ..plans.daily import Layout, Models, Summary, run_daily
from ..schema import NEWS_SCHEMA
from ..sources.delimited import RECORD_SEP, read_delimited
from ..sources.news import new_articles


COUNTS = ["records", "bad_records", "articles", "late"]
COUNTS_SCHEMA = StructType(
    [StructField("batch_id", LongType()), StructField("last_seq", LongType()), StructField("last_part_basc_dt", StringType()), *(StructField(c, LongType()) for c in COUNTS)]
)


def stream_files(
    spark: SparkSession,
    folder: str,
    max_files_per_trigger: int | None = None,
    clean_source: str = "off",
    archive: str | None = None,
) -> DataFrame:
    """New delimited files as a streaming DataFrame of their paths.

    The stream says which files are new; each batch reads them with :func:`read_delimited`, by their own headers.
    """
    reader = spark.readStream.option("lineSep", RECORD_SEP).option("cleanSource", clean_source)
    if archive:
        reader = reader.option("sourceArchiveDir", archive)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(folder).select(F.col("_metadata.file_path").alias("path"))


def run_available(
    stream: DataFrame,
    checkpoint: str,
    handle: Callable[[DataFrame, int], None],
) -> None:
    """Feed everything that is there now through ``handle`` in micro-batches, then stop."""
    query = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query.start().awaitTermination()


def counts_path(landed: str) -> str:
    return f"{landed}-counts"


def counted_articles(spark: SparkSession, batch: DataFrame, columns: list[str], cursor: tuple[int, str]) -> tuple[DataFrame, Callable[[], tuple[int, int, int, int]]]:
    """The new articles in the files of a micro-batch, and what counts them: records, bad ones, articles, late ones.

    The counts are there once the articles have been written, whole, a single time.
    """
    # As many paths as a batch has files.
    paths = sorted(batch.inputFiles()) or sorted(r.path for r in batch.distinct().collect())
    if not paths:
        return spark.createDataFrame([], NEWS_SCHEMA), lambda: (0, 0, 0, 0)
    records, articles = Observation(), Observation()
    rows = new_articles(read_delimited(spark, paths, columns, observation=records), *cursor, observation=articles)

    def counts() -> tuple[int, int, int, int]:
        bad = records.get["bad_records"]
        return (bad + records.get["good_records"], bad, articles.get["articles"], articles.get["late"])

    return rows, counts


def landed_counts(spark: SparkSession, landed: str, cursor: tuple[int, str] | None = None) -> DataFrame:
    """One row: the sums over landed micro-batches of records, bad records, articles and late ones.

    With a ``cursor``, over those that were landed with it, so since it last moved. A micro-batch that ran twice counts once.
    """
    rows = storage.read_or_empty(spark, counts_path(landed), COUNTS_SCHEMA)
    if cursor is not None:
        rows = rows.where((F.col("last_seq") == cursor[0]) & (F.col("last_part_basc_dt") == cursor[1]))
    return rows.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS))


def land_new_articles(
    spark: SparkSession,
    folder: str,
    columns: list[str],
    landed: str,
    checkpoint: str,
    cursor: tuple[int, str],
    max_files_per_trigger: int | None = None,
    clean_source: str = "off",
    archive: str | None = None,
) -> DataFrame:
    """Drain new files into ``landed`` and return all that was landed there.

    Each micro-batch owns the folder of its number, so a batch that is replayed after a failure
    replaces its own rows and adds none. Its counts are stored beside, see :func:`landed_counts`.

    With ``clean_source="archive"`` a file moves to ``archive``, below its own path, once the micro-batch after its own
    begins; so the files of a call's last micro-batch move in the next call that finds new ones.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        rows, counts = counted_articles(spark, batch, columns, cursor)
        rows.write.mode("overwrite").parquet(f"{landed}/batch_id={batch_id}")
        stored = spark.createDataFrame([(batch_id, *cursor, *counts())], COUNTS_SCHEMA)
        stored.coalesce(1).write.mode("overwrite").parquet(f"{counts_path(landed)}/batch_id={batch_id}")

    run_available(stream_files(spark, folder, max_files_per_trigger, clean_source, archive), checkpoint, land)
    return storage.read_or_empty(spark, landed, NEWS_SCHEMA)


def prune_landed(spark: SparkSession, landed: str, cursor: tuple[int, str]) -> list[str]:
    """Delete landed batches wholly behind the cursor; returns their names.

    Rows per batch are counted from the file footers' statistics, as only the article number is read.
    """
    names = storage.folder_names(spark, landed)
    if not names:
        return []
    rows = spark.read.schema(NEWS_SCHEMA).option("basePath", landed).parquet(landed)
    ahead = {r.batch_id for r in new_articles_with_batch(rows, cursor).select("batch_id").distinct().collect()}
    gone = [n for n in names if n.startswith("batch_id=") and int(n.split("=")[1]) not in ahead]
    # The newest batch stays, so that the folder never looks as if nothing had landed yet.
    newest = max(names, key=lambda n: int(n.split("=")[1]))
    gone = [n for n in gone if n != newest]
    for name in gone:
        storage.delete(spark, f"{landed}/{name}", recursive=True)
        storage.delete(spark, f"{counts_path(landed)}/{name}", recursive=True)
    return gone


def new_articles_with_batch(rows: DataFrame, cursor: tuple[int, str]) -> DataFrame:
    """Landed rows ahead of the cursor, with the number of their batch."""
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"/batch_id=(\d+)/", 1).cast("bigint")
    reached = (F.col("part_basc_dt") >= F.lit(cursor[1])) | F.col("part_basc_dt").isNull()
    return rows.select("seq", "part_basc_dt", folder.alias("batch_id")).where((F.col("seq") > F.lit(cursor[0])) & reached)


def run_daily_stream(
    spark: SparkSession,
    layout: Layout,
    folder: str,
    columns: list[str],
    company_path: str,
    models: Models,
    run_dt: str,
    max_files_per_trigger: int | None = None,
    clean_source: str = "off",
    archive: str | None = None,
    **settings,
) -> Summary:
    """:func:`run_daily` with the files of ``folder`` taken as a stream.

    Files are landed once. What is landed but not yet behind the cursor is processed, so a run that
    failed after landing is made good by the next one. Batches wholly behind the cursor are removed first.
    Bad records and late articles are those of all files landed since the cursor last moved.
    """
    counted: dict[str, int] = {}

    def load(last_seq: int, last_day: str) -> DataFrame:
        if not settings.get("dry_run"):
            prune_landed(spark, layout.landed, (last_seq, last_day))
        landed = land_new_articles(
            spark, folder, columns, layout.landed, layout.stream, (last_seq, last_day), max_files_per_trigger, clean_source, archive
        )
        counted.update(landed_counts(spark, layout.landed, (last_seq, last_day)).first().asDict())
        return new_articles(landed, last_seq, last_day)

    summary = run_daily(spark, layout, None, company_path, models, run_dt, load_news=load, **settings)
    summary.bad_records, summary.late = counted.get("bad_records"), counted.get("late")
    return summary
