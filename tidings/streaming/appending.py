"""The whole run per micro-batch: new files to the target, each article once, with its counts in the ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..operators.state import load_cursor, next_cursor, save_cursor
from ..plans.daily import Layout, Models, Summary, _Run
from ..schema import TARGET_SCHEMA
from ..sources.company import load_companies
from . import ledger
from .incremental import counted_articles, run_available, stream_files

_COUNTS = "records bigint, bad_records bigint, articles bigint, late bigint, loaded bigint"


class _Batch(_Run):
    """A run whose articles are the new ones in the files of a micro-batch."""

    def articles(self, files: DataFrame, columns: list[str], cursor: tuple[int, str]) -> tuple[DataFrame, dict[str, int]]:
        """The articles, stored, and their counts; both are read back if an earlier try has stored the counts."""
        raw, counts = f"{self.folder}/raw", f"{self.folder}/counts"
        if not storage.is_complete(self.spark, counts):
            rows, counted = counted_articles(self.spark, files, columns, cursor)
            loaded = storage.materialize(rows, raw).count()
            storage.materialize(self.spark.createDataFrame([(*counted(), loaded)], _COUNTS).coalesce(1), counts)
        return self.spark.read.parquet(raw), self.spark.read.parquet(counts).first().asDict()


def stream_to_target(
    spark: SparkSession, layout: Layout, folder: str, columns: list[str], company_path: str, models: Models,
    threshold: float = 0.9, company_feed_columns: list[str] | None = None, max_files_per_trigger: int | None = None,
    clean_source: str = "off", archive: str | None = None,
) -> DataFrame:
    """Take all new files of ``folder`` through extraction, matching and append, then stop; returns the ledger's totals.

    A micro-batch that fails is run again by the next call: its stored stages are read back, so that models aren't asked
    again, what it had appended without committing is removed, and its counts enter the ledger once. The cursor is the same for
    all files of one call, so that their order doesn't matter, and moves at its end. Articles that come in two
    micro-batches of a call are extracted in both and appended once.

    The target of ``layout`` must have no other writer.
    """
    cursor = load_cursor(spark, layout.state)

    def handle(batch: DataFrame, batch_id: int) -> None:
        stream = ledger.stream_id(spark, layout.batches)
        run = _Batch(spark, layout, models, f"{layout.runs}/{stream}-{batch_id}", threshold, False)
        if not ledger.is_committed(spark, layout.ledger, stream, batch_id):
            with storage.scratch_below(f"{run.folder}/scratch"):
                run.check_settings()
                raw, entry = run.articles(batch, columns, cursor)
                summary = Summary()
                mapped = spark.createDataFrame([], TARGET_SCHEMA)
                if entry["loaded"]:
                    mapped = run.extract_and_map(raw, lambda: load_companies(spark, company_path, company_feed_columns), summary)
                top = next_cursor(raw).first()
                entry |= {"extracted": summary.extracted, "mapped": summary.mapped}
                entry |= {"last_seq": top.last_seq, "last_part_basc_dt": top.last_part_basc_dt or "None"}
                ledger.append_once(
                    spark, mapped, layout.target, layout.ledger, stream, batch_id, entry, f"{run.folder}/append-{len(storage.folder_names(spark, run.folder))}")
        run.publish(Summary())
        storage.delete(spark, run.folder, recursive=True)

    run_available(stream_files(spark, folder, max_files_per_trigger, clean_source, archive), layout.batches, handle)
    reached = ledger.entries(spark, layout.ledger).agg(F.max(F.struct("last_seq", "last_part_basc_dt")).alias("top"), F.max("last_id").alias("id")).first()
    if reached.top is not None and (reached.top.last_seq or 0) > cursor[0]:
        save_cursor(spark, layout.state, reached.top.last_seq, reached.top.last_part_basc_dt, reached.id)
    return ledger.totals(spark, layout.ledger)
