"""The cursor between runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..schema import STATE_SCHEMA

# Where the very first run starts.
FIRST_CURSOR = (0, "20260101")


def next_cursor(articles: DataFrame) -> DataFrame:
    """One row: the largest article number and the partition of that row (the later one on a tie)."""
    top = F.max(F.struct("seq", "part_basc_dt"))
    return articles.agg(top.alias("top")).select(
        F.col("top.seq").alias("last_seq"), F.col("top.part_basc_dt").alias("last_part_basc_dt")
    )


def _newest(spark: SparkSession, path: str) -> Row | None:
    state = storage.read_or_empty(spark, path, STATE_SCHEMA)
    return state.agg(F.max(F.struct(*STATE_SCHEMA.names)).alias("top")).first().top


def load_cursor(spark: SparkSession, path: str) -> tuple[int, str]:
    top = _newest(spark, path)
    return FIRST_CURSOR if top is None else (top.last_seq, top.last_part_basc_dt)


def load_published_id(spark: SparkSession, path: str) -> int:
    """The largest id that the serving copy is known to have."""
    top = _newest(spark, path)
    return 0 if top is None else top.published_id or 0


def load_last_id(spark: SparkSession, path: str) -> int:
    """An id the target has reached for certain; it may be beyond it after a run that failed late."""
    top = _newest(spark, path)
    return 0 if top is None else top.last_id


def _save(spark: SparkSession, path: str, top: Row | None, last_seq: int, last_day: str, last_id: int, published_id: int) -> None:
    row = spark.createDataFrame([(1 if top is None else top.version + 1, last_seq, last_day, last_id, published_id)], STATE_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(path)


def save_cursor(spark: SparkSession, path: str, last_seq: int, last_part_basc_dt: str, last_id: int = 0) -> None:
    """Add a newer cursor. Nothing is overwritten, so a failed save leaves the old one in force."""
    top = _newest(spark, path)
    _save(spark, path, top, last_seq, last_part_basc_dt, last_id, 0 if top is None else top.published_id or 0)


def save_published_id(spark: SparkSession, path: str, published_id: int) -> None:
    """Note that the serving copy has all rows up to an id; the cursor stays where it is."""
    top = _newest(spark, path)
    last_seq, last_day = FIRST_CURSOR if top is None else (top.last_seq, top.last_part_basc_dt)
    _save(spark, path, top, last_seq, last_day, published_id if top is None else top.last_id, published_id)
