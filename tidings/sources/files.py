"""Choosing a reader by file name, and finding new numbered files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import storage
from .delimited import read_delimited

NUMBERED_FILE = r"^chunk_(\d+)\.parquet$"


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Union matching columns by name; a column some inputs lack is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def is_delimited(spark: SparkSession, path: str) -> bool:
    """Whether :func:`read_feed` reads delimited files there."""
    if storage.is_folder(spark, path):
        return storage.matches(spark, f"{path}/*.csv")
    return path.lower().endswith(".csv") and bool(input_files(spark, path))


def input_files(spark: SparkSession, path: str) -> list[str]:
    """What :func:`read_feed` reads for ``path``: itself if it is there, else the ``.csv`` files that it names as a pattern."""
    if storage.exists(spark, path):
        return [path]
    return storage.files_at(spark, path) if path.lower().endswith(".csv") else []


def read_feed(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    observation: Observation | None = None,
) -> DataFrame:
    """A folder reads all its ``.csv`` files if it has any, else its ``.parquet`` files.

    A ``.csv`` file, or files that a pattern such as ``news-*.csv`` names, is in delimited-record form, any other file is
    parquet; a missing path has no rows and no columns. An ``observation`` counts the records of delimited files only (see :func:`is_delimited`):
    parquet has no bad ones, and counting would keep filters from its scan.
    """
    if storage.is_folder(spark, path):
        if storage.matches(spark, f"{path}/*.csv"):
            return read_delimited(spark, f"{path}/*.csv", columns, observation=observation)
        if storage.matches(spark, f"{path}/*.parquet"):
            return spark.read.option("mergeSchema", "true").parquet(f"{path}/*.parquet")
        return spark.createDataFrame([], StructType([]))
    if not input_files(spark, path):
        return spark.createDataFrame([], StructType([]))
    if path.lower().endswith(".csv"):
        return read_delimited(spark, path, columns, observation=observation)
    return spark.read.parquet(path)


def new_numbered_files(listing: DataFrame, last_done: int, name: str = "file_name") -> DataFrame:
    """Rows of a file listing whose name is ``chunk_<n>.parquet`` with ``n > last_done``."""
    digits = F.regexp_extract(name, NUMBERED_FILE, 1)
    return listing.withColumn("chunk_idx", F.when(digits != "", digits).try_cast("bigint")).where(
        F.col("chunk_idx") > last_done
    )


def read_new_chunks(spark: SparkSession, folder: str, last_done: int, schema: StructType | str | None = None) -> DataFrame:
    """The rows of the files ``chunk_<n>.parquet`` in ``folder`` with ``n > last_done``, with their ``chunk_idx``.

    The condition is on the file's name alone, so that Spark drops other files while it plans and doesn't open them. With a
    ``schema`` no file is opened for its footer either.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    digits = F.regexp_extract("_metadata.file_name", NUMBERED_FILE, 1)
    number = F.when(digits != "", digits).try_cast("bigint")
    rows = reader.parquet(folder)
    return rows.where(number > last_done).select(*rows.columns, number.alias("chunk_idx"))


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Names of the files in ``folder``; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .load(folder)
        .select(F.col("path"), F.element_at(F.split("path", "/"), -1).alias("file_name"))
    )
