"""Appending mapped rows to the target, once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .. import storage
from ..functions.text import flatten_newlines
from ..schema import ID_COLUMN, PARTITION_COLUMN, TARGET_COLUMNS, TARGET_SCHEMA
from .align import align, to_target
from .ids import in_order, max_id, max_id_above, number_stored

LOAD_KEY = ["seq", "etct_cust_no"]


def not_loaded(new: DataFrame, target: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """New rows whose key the target lacks.

    The target is first cut to the range of the new article numbers, which parquet statistics answer,
    so a daily load does not read or shuffle all history. Null keys count as equal.
    """
    keys = keys or LOAD_KEY
    first = keys[0]
    span = new.agg(F.min(first).alias("low"), F.max(first).alias("high"), F.count_if(F.col(first).isNull()).alias("n"))
    low, high, nulls = span.first()
    if low is None and not nulls:
        return new
    inside = F.col(first).between(low, high) if low is not None else F.lit(False)
    if nulls:
        inside = inside | F.col(first).isNull()
    known = target.where(inside).select(*[F.col(k).alias(f"_t_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in keys]
    return new.join(known, same, "left_anti")


def flatten_text(df: DataFrame) -> DataFrame:
    """Line breaks in text columns become blanks, as an insert statement would store them."""
    return df.select(
        *[
            flatten_newlines(f.name).alias(f.name) if isinstance(f.dataType, StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def append_with_ids(
    spark: SparkSession,
    new: DataFrame,
    target_path: str,
    order: list[str] | None = None,
    stage: str | None = None,
    id_floor: int = 0,
) -> tuple[int, int]:
    """Append rows not yet in the target, numbered on from its largest id.

    Rows are fitted to the target's columns first; columns they lack are null. Returns how many, and the largest id after them. ``id_floor`` is an id known to be in the target.

    Written by day partition: the rebalance hint joins small days in a task and spreads large ones.
    One writer at a time is assumed, as ids continue from the stored maximum.
    """
    target = storage.read_or_empty(spark, target_path, TARGET_SCHEMA)
    start = max_id_above(target, id_floor)
    fresh = not_loaded(to_target(new), target)
    stored = storage.materialize(in_order(fresh, order or LOAD_KEY), stage, "append")
    count = stored.count()
    if count:
        rows = align(number_stored(stored, ID_COLUMN, start), TARGET_SCHEMA)
        rows.hint("rebalance", PARTITION_COLUMN).write.mode("append").partitionBy(PARTITION_COLUMN).parquet(target_path)
    return count, start + count


def create_target_table(spark: SparkSession, table: str, location: str | None = None) -> None:
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TARGET_SCHEMA.fields)
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
        f"OPTIONS (compression='snappy') PARTITIONED BY ({PARTITION_COLUMN}){at}"
    )


def insert(df: DataFrame, table: str) -> None:
    """Insert by position, the partition column last; line breaks become blanks."""
    flatten_text(df).hint("rebalance", df.columns[-1]).write.insertInto(table)


def insert_with_ids(spark: SparkSession, new: DataFrame, table: str, order: list[str] | None = None) -> int:
    """Insert rows into a catalog table, numbered on from its largest id; returns how many."""
    start = max_id(spark.table(table)).first().max_id
    stored = storage.materialize(in_order(to_target(new), order or LOAD_KEY), label="insert")
    insert(align(number_stored(stored, ID_COLUMN, start), TARGET_SCHEMA).select(*TARGET_COLUMNS), table)
    return stored.count()
