"""The company master feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.text import strip
from .files import read_feed


def load_companies(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """The feed with customer numbers as trimmed text, so that leading zeros stay."""
    feed = read_feed(spark, path, columns)
    if "cust_no" in feed.columns:
        feed = feed.withColumn("cust_no", strip(feed["cust_no"].cast("string")))
    return feed
