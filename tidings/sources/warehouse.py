"""Queries on catalog tables, with the run's values passed as parameters."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.text import empty_to_null
from ..schema import NEWS_COLUMNS


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Empty strings become null in every text column."""
    return df.select(
        *[
            empty_to_null(f.name).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def fetch(spark: SparkSession, query: str, **args) -> DataFrame:
    """Run a query; empty strings come back as null."""
    return blanks_to_null(spark.sql(query, args=args or None))


def _root_articles(df: DataFrame) -> DataFrame:
    return df.where((F.col("channel") == "NEWS") & (F.col("seq") == F.col("p_seq")) & F.col("title").isNotNull())


def daily_news(
    spark: SparkSession, table: str, last_seq: int, last_part_basc_dt: str, limit: int | None = None
) -> DataFrame:
    """Root news articles after the cursor. Plain comparisons, so partitions are pruned."""
    rows = _root_articles(
        spark.table(table).where(
            (F.col("part_basc_dt") >= F.lit(last_part_basc_dt)) & (F.col("seq") > F.lit(last_seq))
        )
    ).select(*NEWS_COLUMNS)
    return rows.limit(limit) if limit else rows


def window_start(days: int = 4, base_date: str | None = None) -> str:
    """First day, as YYYYMMDD, of the ``days`` days that end on ``base_date`` (today if not given)."""
    base = datetime.strptime(base_date, "%Y%m%d").date() if base_date else date.today()
    return (base - timedelta(days=days - 1)).strftime("%Y%m%d")


def recent_news(
    spark: SparkSession,
    table: str,
    days: int = 4,
    base_date: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Root news articles of the last ``days`` days, the base day included."""
    start = window_start(days, base_date)
    rows = _root_articles(spark.table(table).where(F.col("part_basc_dt") >= start)).select(*NEWS_COLUMNS)
    return rows.limit(limit) if limit else rows


def whole_table(spark: SparkSession, table: str, limit: int | None = None) -> DataFrame:
    rows = spark.table(table)
    return rows.limit(limit) if limit else rows
