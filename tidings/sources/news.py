"""The incremental news source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructType

from ..functions.text import is_blank, same_number, to_long
from ..operators.align import align
from ..schema import NEWS_SCHEMA
from .files import read_feed


def _is_integral(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, IntegralType)


def new_articles(
    df: DataFrame,
    last_seq: int,
    last_part_basc_dt: str,
    null_partition_passes: bool = True,
    observation: Observation | None = None,
    carried: Sequence[str] = (),
) -> DataFrame:
    """Root news articles after the cursor ``(last_seq, last_part_basc_dt)``.

    Channel and parent filters apply only where the feed has those columns. Bigint ``seq`` is compared
    as it is, so the filters reach a parquet scan; text is coerced and rows without a number dropped.
    A null partition compares as the text ``None``, which sorts after every date and so passes.

    An ``observation`` counts the ``articles`` seen and the ``late`` ones that the cursor excludes. The
    cursor is then not pushed down, since late rows must be read to be counted. Columns ``carried`` stay beside the feed's.
    """
    if "channel" in df.columns:
        df = df.where(F.upper("channel") == "NEWS")
    if "p_seq" in df.columns:
        if _is_integral(df, "seq") and _is_integral(df, "p_seq"):
            df = df.where(F.col("seq") == F.col("p_seq"))
        else:
            df = df.where(same_number("seq", "p_seq"))
    if "seq" in df.columns and not _is_integral(df, "seq"):
        df = df.withColumn("seq", to_long("seq"))
    extra = [df.schema[c] for c in carried]
    rows = align(df, StructType([*NEWS_SCHEMA.fields, *extra])).where(~is_blank("title") & F.col("seq").isNotNull())
    reached = F.col("part_basc_dt") >= F.lit(last_part_basc_dt)
    if null_partition_passes and "None" >= last_part_basc_dt:
        reached = reached | F.col("part_basc_dt").isNull()
    after = F.col("seq") > F.lit(last_seq)
    if observation is not None:
        rows = rows.observe(
            observation, F.count("*").alias("articles"), F.count_if(~F.coalesce(after & reached, F.lit(False))).alias("late")
        )
    return rows.where(after).where(reached)


def load_new_articles(
    spark: SparkSession,
    path: str,
    last_seq: int,
    last_part_basc_dt: str,
    columns: list[str] | None = None,
    observation: Observation | None = None,
    late: Observation | None = None,
) -> DataFrame:
    """New articles of a feed; ``observation`` counts its good and bad records, ``late`` the articles the cursor excludes."""
    feed = read_feed(spark, path, columns, observation)
    if not feed.columns:
        feed = spark.createDataFrame([], NEWS_SCHEMA)
    return new_articles(feed, last_seq, last_part_basc_dt, observation=late)
