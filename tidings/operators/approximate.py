"""Approximate top-1 vector search by random projections, re-ranked on the full vectors.

A table of random planes gives every vector a code, a bit for the side of each plane; vectors of small angle often share it.
Several tables are used, and a query also visits the codes that differ in one of its least certain bits. Codes are the cells of
:func:`best_in_cells`: each query is compared with the whole vectors in its cells, in tiles of bounded size on both sides, so that
a code which a third of the rows share is spread over many tasks, and no list of candidates exists. What comes out is right but for
queries whose nearest row shares none of their codes. :func:`nearest` stays the exact search and the default.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import storage
from ..functions.vectors import relevance
from .nearest import _CELL, _PLACES, _ROUNDING, _matrix, best_in_cells, nearest

TABLES, BITS, PROBES, SEED = 8, 10, 3, 11


def codes(unit: np.ndarray, tables: int, bits: int, probes: int, seed: int) -> np.ndarray:
    """The cells of each row: per table its own code, then ``probes`` codes with one of the least certain bits turned."""
    planes = np.random.default_rng(seed).standard_normal((unit.shape[1], tables * bits))
    side = (unit @ planes).reshape(len(unit), tables, bits)
    weights = 1 << np.arange(bits)
    own = (side > 0) @ weights
    doubtful = np.argsort(np.abs(side), axis=2, kind="stable")[:, :, : min(probes, bits)]
    every = np.concatenate((own[:, :, None], own[:, :, None] ^ weights[doubtful]), axis=2)
    return (every + (np.arange(tables) << bits)[None, :, None]).reshape(len(unit), -1).astype(np.int32)


def _in_cells(rows: DataFrame, key: str, vector: str, tables: int, bits: int, probes: int, seed: int) -> DataFrame:
    """``rows`` once per cell. Rows of a batch and cell stand together, as they are needed so."""

    def each(batches):
        for batch in batches:
            found = codes(_matrix(pa.chunked_array([batch.column(1)]), batch.num_rows), tables, bits, probes, seed)
            for k in range(found.shape[1]):
                yield pa.RecordBatch.from_arrays([pa.array(found[:, k]), *batch.columns], names=["cell", key, vector])

    return rows.select(key, vector).mapInArrow(each, T.StructType([_CELL, rows.schema[key], rows.schema[vector]]))


def nearest_approximate(
    queries: DataFrame,
    index: DataFrame,
    threshold: float | None = None,
    tables: int = TABLES,
    bits: int = BITS,
    probes: int = PROBES,
    seed: int = SEED,
    exact_for_rest: bool = True,
) -> DataFrame:
    """``(query_key, item_key, cos, score)``, as :func:`nearest` gives it, found among the rows that share a code.

    Queries that share no code with any row are searched exactly, unless ``exact_for_rest`` is off; then they are absent.
    A row below the ``threshold`` (a relevance) isn't returned. More tables and probes find more, more bits compare less; with
    vectors of D entries and n rows, ``bits`` near log2(n / 1000) keeps cells at some thousand rows. Vectors travel once per
    table, queries once per table and probe, so this pays where exact search would have to visit most cells.

    Pass stored tables, with vectors of one length.
    """
    if tables << bits > 1 << 31:
        raise ValueError("too many tables of so many bits")
    wanted = storage.materialize(_in_cells(queries, "query_key", "query_vec", tables, bits, probes, seed), label="query-codes")
    rows = storage.materialize(_in_cells(index, "item_key", "item_vec", tables, bits, 0, seed), label="index-codes")
    found = storage.materialize(best_in_cells(wanted, rows), label="approximate")
    best = found.withColumn("score", relevance(F.col("cos")))
    if threshold is not None:
        best = best.where(F.round(relevance(F.col("top")), _PLACES) >= threshold)
    best = best.drop("top")
    if not exact_for_rest:
        return best
    rest = storage.materialize(queries.join(found.select("query_key"), "query_key", "left_anti").select("query_key", "query_vec"), label="rest")
    return best if rest.isEmpty() else best.unionByName(nearest(rest, index, threshold))


def recall(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: ``n`` queries with an exact nearest row, and how many were ``found`` with as high a cosine as that."""
    both = exact.select("query_key", F.col("cos").alias("_best")).join(approximate.select("query_key", "cos"), "query_key", "left")
    return both.agg(F.count("*").alias("n"), F.count_if(F.col("cos") >= F.col("_best") - _ROUNDING).alias("found"))
