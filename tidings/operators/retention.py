"""Removing old run folders."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..schema import PARTITION_COLUMN

RETENTION_DAYS = 14


def expired(folders: DataFrame, today: str, days: int = RETENTION_DAYS, name: str = "folder") -> DataFrame:
    """Folders named by a day (YYYYMMDD) more than ``days`` days before ``today``; other names never expire."""
    text = F.col(name)
    day = F.when(
        text.rlike(r"^\d{8}$"),
        F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2)),
    ).try_cast("date")
    base = datetime.strptime(today, "%Y%m%d").date()
    return folders.where(day < F.lit(base - timedelta(days=days)))


def remove_expired(spark: SparkSession, root: str, today: str | None = None, days: int = RETENTION_DAYS) -> list[str]:
    """Delete expired day folders below ``root``; returns their names. At most one folder per run exists."""
    names = storage.folder_names(spark, root)
    if not names:
        return []
    today = today or date.today().strftime("%Y%m%d")
    old = [r.folder for r in expired(spark.createDataFrame([(n,) for n in names], "folder string"), today, days).collect()]
    for name in old:
        storage.delete(spark, f"{root}/{name}", recursive=True)
    return sorted(old)


_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def catalog_partitions(spark: SparkSession, table: str, column: str = PARTITION_COLUMN) -> DataFrame:
    """One row per partition of a table partitioned by ``column``, as the catalog lists them; the null partition is null."""
    value = F.regexp_extract("partition", f"^{column}=(.*)$", 1)
    named = spark.sql(f"SHOW PARTITIONS {table}").select(F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))).alias(column))
    return named.select(F.when(F.col(column) != _NULL_PARTITION, F.col(column)).alias(column))


def drop_expired_partitions(
    spark: SparkSession, table: str, today: str | None = None, days: int = RETENTION_DAYS, column: str = PARTITION_COLUMN, remove_files: bool = False
) -> list[str]:
    """Drop the partitions of days more than ``days`` days before ``today``; returns their values.

    Days are YYYYMMDD or YYYY.MM.DD; partitions with another name, and the null partition, stay. Only the catalog is asked, so
    no file is read. A table with a location of its own keeps the files of dropped partitions unless ``remove_files`` is
    set; either way their rows are gone from the table at once, in one statement.
    """
    today = today or date.today().strftime("%Y%m%d")
    listed = catalog_partitions(spark, table, column).withColumn("_day", F.replace(F.col(column), F.lit("."), F.lit("")))
    gone = sorted(r[column] for r in expired(listed, today, days, "_day").collect())  # one row per partition
    if not gone:
        return []
    quoted = [v.replace("\\", "\\\\").replace("'", "\\'") for v in gone]
    folders = [_partition_folder(spark, table, column, v) for v in quoted] if remove_files else []
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(f"PARTITION ({column} = '{v}')" for v in quoted))
    for folder in folders:
        storage.delete(spark, folder, recursive=True)
    return gone


def _partition_folder(spark: SparkSession, table: str, column: str, value: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {table} PARTITION ({column} = '{value}')").collect()
    own, *others = [r[1] for r in rows if r[0] == "Location"]  # the partition's, then the table's
    if own in others:
        raise ValueError(f"partition {value} of {table} has no folder of its own")
    return own
