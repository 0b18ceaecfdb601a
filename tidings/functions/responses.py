"""Turning raw model responses into columns, without leaving the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import or_none_text, strip

FAILURE_PREFIX = "Failure:"


def strip_fences(c: Column) -> Column:
    """Remove Markdown code fences around a JSON body."""
    fence = "`" * 3
    bare = F.replace(F.replace(c, F.lit(fence + "json"), F.lit("")), F.lit(fence), F.lit(""))
    return strip(bare)


def missing_braces(c: Column) -> Column:
    """How many closing braces are needed to balance the text (braces in strings count too)."""
    opened = F.length(c) - F.length(F.replace(c, F.lit("{"), F.lit("")))
    closed = F.length(c) - F.length(F.replace(c, F.lit("}"), F.lit("")))
    return F.greatest(F.lit(0), opened - closed)


def is_failure(raw: Column) -> Column:
    return raw.isNull() | (raw == "") | raw.startswith(FAILURE_PREFIX)


def parse_json_text(df: DataFrame, raw: str, out: str = "parsed", status: str = "parse_status") -> DataFrame:
    """Parse ``raw`` to a variant: as it is, or once more with the missing braces added.

    ``status`` is ``ok``, ``repaired``, ``failed`` or ``call_error``.
    """
    body = strip_fences(F.col(raw))
    return (
        df.withColumn("_body", F.when(~is_failure(F.col(raw)), body))
        .withColumn("_plain", F.try_parse_json("_body"))
        .withColumn("_lack", missing_braces(F.col("_body")))
        .withColumn(
            out,
            F.when(F.col("_plain").isNotNull(), F.col("_plain")).when(
                F.col("_lack") > 0,
                F.try_parse_json(F.concat("_body", F.repeat(F.lit("}"), F.col("_lack")))),
            ),
        )
        .withColumn(
            status,
            F.when(is_failure(F.col(raw)), "call_error")
            .when(F.col("_plain").isNotNull(), "ok")
            .when(F.col(out).isNotNull(), "repaired")
            .otherwise("failed"),
        )
        .drop("_body", "_plain", "_lack")
    )


def name_list(names: Column) -> Column:
    """Array of names from a variant that is a list, or a string holding a list literal."""
    listed = F.when(F.schema_of_variant(names).startswith("ARRAY"), F.try_variant_get(names, "$", "array<string>"))
    quoted = F.from_json(
        F.when(F.schema_of_variant(names) == "STRING", F.try_variant_get(names, "$", "string")),
        "array<string>",
        {"allowSingleQuotes": "true"},
    )
    return F.coalesce(listed, quoted, F.array().cast("array<string>"))


def parse_responses(df: DataFrame, raw: str = "raw_content") -> DataFrame:
    """Add names, class, category, summary, error text and parse status; drop ``raw``.

    A response whose ``results`` is no object yields nulls and an empty list, never an error.
    """
    names = F.try_variant_get("parsed", "$.results.company_names", "variant")
    text = lambda field: F.try_variant_get("parsed", f"$.results.{field}", "string")
    return (
        parse_json_text(df, raw)
        .withColumn("_names", names)
        .withColumns(
            {
                "company_names": name_list(F.col("_names")),
                "classification": text("classification"),
                "category": text("category"),
                "summary": text("summary"),
                "llm_error": F.when(is_failure(F.col(raw)), or_none_text(raw)),
            }
        )
        .drop("parsed", "_names", raw)
    )
