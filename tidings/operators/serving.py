"""The filtered copy of the target that readers query."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import strip
from ..schema import PARTITION_COLUMN, TARGET_COLUMNS, TARGET_SCHEMA
from .align import align, all_text

# Texts that stand for a missing value or for an irrelevant article.
_MISSING = ["NONE", "NAN", "NULL"]
_CLASS_EXCLUDED = ["NOISE", *_MISSING]


#: Columns that readers look rows up by.
LOOKUP_COLUMNS = ["etct_cust_no", "seq"]


def _says_something(name: str, excluded: list[str]):
    text = F.upper(strip(name))
    return text.isNotNull() & ~text.isin("", *excluded)


def is_served() -> Column:
    """A real news class other than noise, and a real sentiment."""
    return _says_something("news_clas", _CLASS_EXCLUDED) & _says_something("doc_sentiment", _MISSING)


def serving_filter(target: DataFrame) -> DataFrame:
    return target.where(is_served())


def serving_rows(target: DataFrame) -> DataFrame:
    """Filtered rows with the target's columns, all as text."""
    return all_text(align(serving_filter(target), TARGET_SCHEMA), TARGET_COLUMNS)


def of_days(target: DataFrame, days: DataFrame) -> DataFrame:
    """Rows of the target whose day is in ``days``, a stored table of the partition column; null is a day like others.

    The days are joined, not gathered: when they are few, Spark reads only their partitions.
    """
    named = target.join(days.where(F.col(PARTITION_COLUMN).isNotNull()), PARTITION_COLUMN, "left_semi")
    if days.where(F.col(PARTITION_COLUMN).isNull()).isEmpty():
        return named
    return named.unionByName(target.where(F.col(PARTITION_COLUMN).isNull()))


def _with_filters(writer: DataFrameWriter, columns: Sequence[str]) -> DataFrameWriter:
    """Parquet bloom filters for ``columns``, as small as their values allow."""
    writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    for c in columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    return writer


def lookup(spark: SparkSession, path: str, **values: str | Sequence[str]) -> DataFrame:
    """Served rows with one of the values given for each column, such as ``seq="17"`` or ``etct_cust_no=["001", "002"]``.

    Both are plain filters that reach the scan. A customer's rows stand together in each day's files; for an article the
    bloom filters tell which row groups can hold it. So row groups without such rows aren't read.
    """
    rows = spark.read.schema(StructType([StructField(c, StringType()) for c in TARGET_COLUMNS])).parquet(path)
    for column, value in values.items():
        rows = rows.where(F.col(column).isin([value] if isinstance(value, str) else list(value)))
    return rows.select(*TARGET_COLUMNS)


def export_serving(target: DataFrame, path: str, days: DataFrame | None = None, counts: Observation | None = None) -> None:
    """Replace the serving copy, or only the day partitions in ``days`` (a stored table) of it.

    Rows are sorted by customer and article inside each file, and both have bloom filters, so that a :func:`lookup` by either
    skips row groups; this takes the place of indexes. ``counts`` gets the rows ``considered`` and ``served``.
    """
    if days is not None:
        target = of_days(target, days)
    if counts is not None:
        target = target.observe(counts, F.count("*").alias("considered"), F.count_if(is_served()).alias("served"))
    mode = "static" if days is None else "dynamic"
    rows = serving_rows(target).hint("rebalance", PARTITION_COLUMN).sortWithinPartitions(PARTITION_COLUMN, "etct_cust_no", "seq")
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(PARTITION_COLUMN)
    _with_filters(writer, LOOKUP_COLUMNS).parquet(path)
