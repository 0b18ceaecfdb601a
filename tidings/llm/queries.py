"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bitpack, decontaminate, html_paths, imatch, importance, language, licenses, pieces, quality_rules, recompress, sharding, simhash, whitening


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.interleave(_read(spark, sf_dir, "documents"), 16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op2_byte_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.report(_read(spark, sf_dir, "documents"))


def op3_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.report(_read(spark, sf_dir, "documents"))


def op4_bitpack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitpack.round_trip(_read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)


def op5_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op6_recompress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recompress.report(_read(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"))


def op8_patience(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(_read(spark, sf_dir, "documents"))


def op9_tag_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_paths.report(_read(spark, sf_dir, "pages"))


def op10_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.report(_read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op11_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.report(_read(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.report(_read(spark, sf_dir, "embeddings"))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.report(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_interleave": op1_interleave,
    "op2_byte_network": op2_byte_network,
    "op3_imatch": op3_imatch,
    "op4_bitpack": op4_bitpack,
    "op5_wu_manber": op5_wu_manber,
    "op6_recompress": op6_recompress,
    "op7_simhash": op7_simhash,
    "op8_patience": op8_patience,
    "op9_tag_paths": op9_tag_paths,
    "op10_transducer": op10_transducer,
    "op11_rules": op11_rules,
    "op12_whitening": op12_whitening,
    "op13_importance": op13_importance,
}
ORACLES: dict[str, str] = {
    "op5_wu_manber": decontaminate.REPORT_SQL,
    "op6_recompress": recompress.REPORT_SQL,
    "op9_tag_paths": html_paths.REPORT_SQL,
    "op11_rules": quality_rules.REPORT_SQL,
    "op13_importance": importance.REPORT_SQL,
}
