"""Snapshots of tables that are known to be whole.

Row count and digest are observed while the rows are written, so that they are read once. The manifest, which also has the
size of every file, is made last, by one rename: without it there is no snapshot.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import storage

MANIFEST = "_manifest.json"


class IncompleteSnapshot(ValueError):
    """A snapshot without a manifest, or with other files or rows than its manifest says."""


def _measures(columns: list[str]) -> list[Column]:
    """The row count, and a digest that doesn't depend on the order of rows."""
    digest = F.sum(F.xxhash64(*(F.col(f"`{c}`") for c in columns)).cast("decimal(38,0)")) if columns else F.lit(0)
    return [F.count("*").alias("rows"), F.coalesce(digest, F.lit(0)).cast("string").alias("digest")]


def _sizes(spark: SparkSession, path: str) -> dict[str, int]:
    """Data files and their lengths, as one listing gives them."""
    return {f.rpartition("/")[2]: storage.file_state(spark, f)[0] for f in storage.files_at(spark, path)}


def write_snapshot(rows: DataFrame, path: str) -> dict:
    """Write ``rows`` to ``path``, which must be new, and return the manifest."""
    spark = rows.sparkSession
    if storage.exists(spark, path):
        raise FileExistsError(path)
    seen = Observation()
    rows.observe(seen, *_measures(rows.columns)).write.parquet(path)
    manifest = {"rows": seen.get["rows"], "digest": seen.get["digest"], "schema": rows.schema.json(), "files": _sizes(spark, path)}
    storage.create_once(spark, f"{path}/{MANIFEST}", json.dumps(manifest).encode())
    return manifest


def read_manifest(spark: SparkSession, path: str) -> dict:
    state = storage.file_state(spark, f"{path}/{MANIFEST}")
    if state is None:
        raise IncompleteSnapshot(f"{path} has no manifest")
    return json.loads(storage.first_bytes(spark, f"{path}/{MANIFEST}", state[0]))


def read_snapshot(spark: SparkSession, path: str, check_rows: bool = False) -> DataFrame:
    """The rows of a snapshot whose files are as its manifest says; with ``check_rows`` they are also counted and digested anew."""
    manifest = read_manifest(spark, path)
    if (found := _sizes(spark, path)) != manifest["files"]:
        other = sorted(f for f in found.keys() | manifest["files"].keys() if found.get(f) != manifest["files"].get(f))
        raise IncompleteSnapshot(f"{path}: {len(other)} files differ from the manifest, {other[0]} first")
    rows = spark.read.schema(StructType.fromJson(json.loads(manifest["schema"]))).parquet(path)
    if check_rows and tuple(rows.agg(*_measures(rows.columns)).first()) != (manifest["rows"], manifest["digest"]):
        raise IncompleteSnapshot(f"{path}: its rows differ from the manifest")
    return rows
