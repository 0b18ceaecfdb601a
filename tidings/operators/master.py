"""Company master: latest record per customer, name directory, change detection, name vectors."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import to_number, with_normalized_name
from ..schema import ASSESSED_ON, COMPANY_CLASS_SOURCE, COMPANY_COLUMNS
from .dedup import keep_first
from .inference import embed

log = logging.getLogger(__name__)

# Tells a failure of the encoder from others in what Spark reports.
_ENCODER_FAILED = "the encoder failed"


def latest_per_customer(df: DataFrame, date_col: str = ASSESSED_ON, ties: list[str] | None = None) -> DataFrame:
    """The newest record of each customer; rows without a customer number or a numeric date are dropped.

    Equal dates are decided by ``ties`` (all other columns unless given), smallest first.
    """
    others = ties if ties is not None else [c for c in df.columns if c not in ("cust_no", date_col)]
    dated = df.withColumn("_day", to_number(date_col)).where(F.col("cust_no").isNotNull())
    # Null days come last and are dropped afterwards: a condition here would parse every date twice.
    newest = keep_first(dated, ["cust_no"], [F.desc("_day"), *[F.asc_nulls_first(c) for c in others]])
    return newest.where(F.col("_day").isNotNull()).withColumn(date_col, F.col("_day").cast("bigint").cast("string")).drop("_day")


def company_columns(df: DataFrame) -> DataFrame:
    """The five master columns used downstream, with the class column under its short name."""
    return df.withColumnRenamed(COMPANY_CLASS_SOURCE, "sglr_ases_modl_clas_cd").select(*COMPANY_COLUMNS)


def with_clean_name(df: DataFrame) -> DataFrame:
    return with_normalized_name(df, "cust_nm", "clean_cust_nm")


def name_directory(master: DataFrame) -> DataFrame:
    """One row per normalised name: how many companies share it, and the first of them by number."""
    first = F.min(F.struct("cust_no", "cust_nm"))
    return (
        master.where(F.col("cust_no").isNotNull())
        .groupBy("clean_cust_nm")
        .agg(F.count("*").alias("n_candidates"), first.alias("first"))
        .select("clean_cust_nm", "n_candidates", "first.cust_no", "first.cust_nm")
    )


def fingerprint(master: DataFrame, key: str = "cust_no") -> DataFrame:
    """One row ``fingerprint``: the key count and an order-free digest of the keys.

    The digest sums two 60-bit halves of each key's MD5, so it is built from partial sums and never
    gathers the keys in one place.
    """
    digest = F.md5(F.col(key).cast("binary"))
    half = lambda start: F.conv(F.substring(digest, start, 15), 16, 10).cast("decimal(20,0)")
    total = lambda start: F.coalesce(F.sum(half(start)), F.lit(0)).cast("string")
    return master.where(F.col(key).isNotNull()).agg(
        F.concat_ws(":", F.count("*").cast("string"), total(1), total(17)).alias("fingerprint")
    )


def unseen_rows(master: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Master rows whose ``keys`` are not stored yet: new and renamed companies."""
    return master.join(stored.select(*keys).distinct(), list(keys), "left_anti")


def refresh_name_vectors(
    master: DataFrame,
    stored: DataFrame,
    encode: Callable[[list[str]], object],
    encoder_id: str,
    save: Callable[[DataFrame], None],
    on_failure: str = "keep_previous",
    tasks: int | None = None,
) -> bool:
    """Embed the normalised names this encoder has not seen and hand them to ``save``.

    A name is embedded once however many companies share it, in ``tasks`` tasks. If the encoder fails, stored
    vectors stay in use (``keep_previous``) unless there are none; returns whether the refresh went through. Any
    other failure, of storage for instance, is raised.
    """
    known = stored.where(F.col("encoder_id") == encoder_id)
    names = master.select("clean_cust_nm").distinct()
    todo = unseen_rows(names, known, ["clean_cust_nm"])

    def marked(texts: list[str]) -> object:
        try:
            return encode(texts)
        except Exception as error:
            raise RuntimeError(f"{_ENCODER_FAILED}: {error}") from error

    try:
        save(embed(todo, "clean_cust_nm", marked, encoder_id, tasks=tasks))
        return True
    except PySparkException as error:
        if _ENCODER_FAILED not in str(error) or on_failure != "keep_previous" or known.isEmpty():
            raise
        log.warning("name vectors not refreshed, the stored ones stay in use", exc_info=True)
        return False
