"""Fitting a DataFrame to a fixed column list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import normalize_date
from ..schema import TARGET_COLUMNS, TARGET_DATA_COLUMNS, TARGET_RENAMES, TARGET_SCHEMA


def align(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema`` in its order and types; absent ones are null, others are dropped."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def keep_present(df: DataFrame, names: list[str]) -> DataFrame:
    """Those of ``names`` that exist, in that order."""
    return df.select(*[c for c in names if c in df.columns])


def to_target(df: DataFrame) -> DataFrame:
    """Mapped rows under the target's names, order and types; the id is not assigned yet."""
    renamed = df.withColumnsRenamed(TARGET_RENAMES)
    fitted = align(renamed, StructType([TARGET_SCHEMA[c] for c in TARGET_DATA_COLUMNS]))
    return fitted.withColumn("basc_dt", normalize_date("basc_dt")).select(*TARGET_DATA_COLUMNS)


def all_text(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Every column as text; null stays null."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in names or TARGET_COLUMNS])
