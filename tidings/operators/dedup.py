"""Duplicates: flags, keep-first and distinct."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key, the first by ``order``.

    The rank filter lets Spark drop all but one row per key on the map side, so a hot key does not
    travel to one task whole. ``order`` should be total.
    """
    by_key = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(by_key)).where(F.col("_rank") == 1).drop("_rank")


def key_counts(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def flag_duplicates(df: DataFrame, keys: list[str], flag: str = "is_duplicate") -> DataFrame:
    """Mark every row whose key occurs more than once.

    Counts are pre-aggregated and joined back rather than taken in a window: a window would hold a hot
    key's rows in one task, while the join lets adaptive execution split them. Null keys match.
    """
    counts = key_counts(df, keys, "_n").select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_n")
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    joined = df.join(counts, on=same, how="left")
    return joined.withColumn(flag, F.col("_n") > 1).drop("_n", *[f"_k_{k}" for k in keys])


def duplicate_keys(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return key_counts(df, keys, name).where(F.col(name) > 1)
