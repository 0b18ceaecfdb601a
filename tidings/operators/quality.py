"""Counts and audits of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedup import duplicate_keys
from .load import LOAD_KEY


def extraction_rate(extracted: DataFrame) -> DataFrame:
    """Articles, and those with at least one company name."""
    return extracted.agg(
        F.count("*").alias("n_articles"), F.count_if(F.size("company_names") > 0).alias("n_with_names")
    )


def mapping_rate(mentions: DataFrame, matched: str = "cust_no") -> DataFrame:
    """Mentions, those with a customer number, and their share (null without mentions)."""
    hit = F.count_if(F.col(matched).isNotNull())
    return mentions.agg(
        F.count("*").alias("n_mentions"),
        hit.alias("n_mapped"),
        F.try_divide(hit.cast("double"), F.count("*").cast("double")).alias("mapping_rate"),
    )


def duplicate_audit(target: DataFrame) -> DataFrame:
    """Article and customer pairs that occur more than once in the target."""
    return duplicate_keys(target, LOAD_KEY, "n_rows")


def stage_counts(**stages: DataFrame) -> DataFrame:
    """One row per stage with its row count."""
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("stage"), "n_rows")
        for name, df in stages.items()
    ]
    out = counts[0]
    for more in counts[1:]:
        out = out.unionByName(more)
    return out
