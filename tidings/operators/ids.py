"""Running numbers over a distributed table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import storage
from ..schema import ID_COLUMN

# Spark puts the partition number in the upper bits of the position and the row in the lower 33.
_ROW_BITS = 33


def max_id(df: DataFrame, id_column: str = ID_COLUMN) -> DataFrame:
    """One row ``max_id``; 0 for an empty table."""
    return df.agg(F.coalesce(F.max(id_column), F.lit(0)).cast("bigint").alias("max_id"))


def max_id_above(df: DataFrame, floor: int, id_column: str = ID_COLUMN) -> int:
    """The largest id, knowing that ``floor`` is reached: statistics then skip all older row groups."""
    return max(floor, max_id(df.where(F.col(id_column) > floor), id_column).first().max_id)


def in_order(df: DataFrame, order: list[Column | str]) -> DataFrame:
    """Rows range-partitioned and sorted by ``order``, with their position ``_pos``.

    Write the result once and number it from the stored copy: positions are only stable there.
    """
    return df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_pos", F.monotonically_increasing_id())


def number_stored(stored: DataFrame, id_column: str = ID_COLUMN, start: int = 0) -> DataFrame:
    """Dense numbers ``start + 1, start + 2, ...`` for rows stored with ``_pos`` by :func:`in_order`.

    Only the row count of each written partition is gathered (one small row per partition); the rows
    themselves are not moved again.
    """
    part = F.shiftright(F.col("_pos"), _ROW_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stored.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    row = F.col("_pos").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    # One row per written partition, so its size is bounded by the number of tasks.
    numbered = stored.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return numbered.withColumn(
        id_column, (F.lit(start) + F.col("_offset") + row + 1).cast("bigint")
    ).drop("_part", "_offset", "_pos")


def with_dense_ids(
    df: DataFrame,
    order: list[Column | str],
    id_column: str = ID_COLUMN,
    start: int = 0,
    path: str | None = None,
) -> DataFrame:
    """Number rows by ``order``, continuing after ``start``, without sorting them in one task."""
    return number_stored(storage.materialize(in_order(df, order), path, "ordered"), id_column, start)


def with_chunk_index(df: DataFrame, order: list[Column | str], rows: int, name: str = "chunk_idx") -> DataFrame:
    """Fixed-size batches: the first ``rows`` rows by ``order`` are batch 0, the next ones 1, and so on."""
    numbered = with_dense_ids(df, order, "_nr")
    return numbered.withColumn(name, F.floor((F.col("_nr") - 1) / rows).cast("bigint")).drop("_nr")
