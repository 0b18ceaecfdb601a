"""The corpus pipeline over ``documents``: five stages, each on all that the one before kept.

Language ID, near-duplicate removal, removal of repeated passages, benchmark decontamination, SentencePiece ids. All but
the last return the columns of ``documents``. Each stage's result is written before the next one reads it, so a lost
executor costs at most one stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidings import storage
from tidings.llm import decontaminate, language, pieces, recompress, simhash


def _spare(docs: DataFrame, n: int) -> list[str]:
    """``n`` column names that the table doesn't have."""
    return [c for c in (f"_{k}" for k in range(len(docs.columns) + n)) if c not in docs.columns][:n]


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language. Those without a letter, and null texts, are rejected.

    The network learns from the labelled texts of ``docs`` that aren't held out.
    """
    net = language.fit(docs.where(F.col("doc_id").isNotNull() & ~language.held_out()))
    lang, score = _spare(docs, 2)
    if net is None:  # nothing was labelled: a letter is all that can be asked for
        return docs.where(F.col("text").rlike(r"\p{L}"))
    return language.with_language(docs, net, (lang, score)).where(F.col(lang) != language.UNKNOWN).drop(lang, score)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id."""
    return simhash.keep_one(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 50 words and more that a smaller doc_id has, and with the new length.

    A document of which nothing is left goes.
    """
    words, removed = _spare(docs, 2)
    left = recompress.without_repeats(docs, names=(words, removed))
    left = left.where((F.col(removed) == 0) | (F.col(removed) < F.col(words)))
    return left.withColumn("n_chars", F.when(F.col(removed) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).drop(words, removed)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten consecutive words of a benchmark item stand."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document: doc_id, number and checksum of its ids, and whether decoding gives the text back."""
    # Fewer words are kept than by default, as executors hold what the earlier stages have left.
    return pieces.report(docs, public_tokenizers.path("piece_bpe_32k.model"), kept_words=300_000)


STAGES = [
    ("language", in_a_language),
    ("near_duplicates", one_of_each_group),
    ("passages", without_repeated_passages),
    ("benchmark", without_benchmark),
    ("token_ids", token_ids),
]

#: SQL has no counterpart of the network, the fingerprints' components and the ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = storage.materialize(stage(spark, docs, sf_dir), label=name)
    return STAGES[-1][1](spark, docs, sf_dir)
