"""Which rows of a keyed table changed, by a tree of digests.

Keys are dealt to buckets by hash. A bucket's digest is the number of its rows and the sums of the two halves of their MD5
checksums, which doesn't depend on their order and is built from partial sums; a group's is the sum over its buckets, and the
root's the sum over all groups. Two versions are compared from the top: an equal root ends it, an equal group leaves out its
buckets. Rows are stored by group and sorted by bucket, so that only the files of groups with a changed bucket are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage

GROUPS, BUCKETS_PER_GROUP = 64, 64
_SUMS = ("n", "high", "low")
_VERSION = "version string, made bigint"


def bucket_of(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(GROUPS * BUCKETS_PER_GROUP)).cast("int")


def _row_digest(columns: Sequence[str]) -> Column:
    """The MD5 of all values, each with its length, so that values can't run into each other; null is told from empty."""
    part = lambda c: F.coalesce(F.concat(F.length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
    return F.md5(F.concat(*(part(F.col(f"`{c}`")) for c in columns)).cast("binary"))


def digests(rows: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(grp, bucket, n, high, low): a row for each bucket that isn't empty."""
    half = lambda start: F.conv(F.substring("_digest", start, 15), 16, 10).cast("decimal(20,0)")
    marked = rows.select(bucket_of(keys).alias("bucket"), _row_digest([*keys, *columns]).alias("_digest"))
    sums = marked.groupBy("bucket").agg(F.count("*").alias("n"), F.sum(half(1)).alias("high"), F.sum(half(17)).alias("low"))
    return sums.select(F.expr(f"bucket div {BUCKETS_PER_GROUP}").cast("int").alias("grp"), "bucket", *_SUMS)


def _differing(new: DataFrame, old: DataFrame, by: Sequence[str]) -> DataFrame:
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in _SUMS]
    every = same[0] & same[1] & same[2]
    joined = new.alias("a").join(old.alias("b"), list(by), "full_outer")
    return joined.where(~every).select(*by)


def _level(sums: DataFrame, by: Sequence[str]) -> DataFrame:
    return sums.groupBy(*by).agg(*(F.sum(c).alias(c) for c in _SUMS))


def changed_buckets(new: DataFrame, old: DataFrame) -> list[int]:
    """The buckets whose digests differ, from the top; at most all buckets of the tree.

    ``old`` is only read as far as it has to be: its groups, and the buckets of those that differ.
    """
    root = lambda d: tuple(d.agg(*(F.sum(c).alias(c) for c in _SUMS)).first())
    if root(new) == root(old):
        return []
    groups = sorted(r.grp for r in _differing(_level(new, ["grp"]), _level(old, ["grp"]), ["grp"]).collect())
    inside = F.col("grp").isin(groups)
    return sorted(r.bucket for r in _differing(new.where(inside), old.where(inside), ["grp", "bucket"]).collect())


def store(sums: DataFrame, path: str) -> None:
    """Keep the digests of a table's buckets as those of its last known version."""
    version = uuid.uuid4().hex
    storage.materialize(sums.coalesce(1), f"{path}/{version}")
    storage.create_once(sums.sparkSession, f"{path}/newest", version.encode(), replace=True)


def load(spark: SparkSession, path: str) -> DataFrame | None:
    """What :func:`store` kept last; None if there is nothing, so that all buckets count as changed."""
    if not storage.exists(spark, f"{path}/newest"):
        return None
    return spark.read.parquet(f"{path}/{storage.first_bytes(spark, f'{path}/newest', 64).decode()}")


@dataclass(frozen=True)
class Changes:
    """What :meth:`KeyedSnapshot.compare` found: the changed buckets, and a row per changed key."""

    buckets: list[int]
    rows: DataFrame
    digests: DataFrame


class KeyedSnapshot:
    """The last known version of a table with unique keys, and its digests, below ``path``.

    A version is the rows of changed groups beside those of the versions before; which folder holds a group is in the
    version's table of digests, whose folder is named last. So a version is seen whole or not at all.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], columns: Sequence[str]):
        self.spark, self.path, self.keys, self.columns = spark, path.rstrip("/"), list(keys), list(columns)

    def _versions(self) -> DataFrame:
        return storage.read_or_empty(self.spark, f"{self.path}/versions", self.spark.createDataFrame([], _VERSION).schema)

    def _newest(self) -> str | None:
        top = self._versions().agg(F.max(F.struct("made", "version")).alias("top")).first().top
        return top and top.version

    def stored_digests(self) -> DataFrame:
        version = self._newest()
        if version is None:
            return self.spark.createDataFrame([], "grp int, bucket int, n bigint, high decimal(30,0), low decimal(30,0), held string")
        return self.spark.read.parquet(f"{self.path}/digests/{version}")

    def _stored_rows(self, old: DataFrame, buckets: list[int], schema) -> DataFrame:
        """Stored rows of ``buckets``: only the files of their groups are named to the scan."""
        folders = [r.folder for r in old.where(F.col("bucket").isin(buckets)).select(F.concat("held", F.lit("/grp="), "grp").alias("folder")).distinct().collect()]
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/rows/{f}" for f in folders)).where(F.col("bucket").isin(buckets))

    def compare(self, table: DataFrame) -> Changes:
        """Changes from the stored version to ``table``: the keys and ``change``, which is insert, update or delete.

        Keys are unique and not null on both sides. ``table`` is read twice, its second reading only in changed buckets.
        """
        now = storage.materialize(digests(table, self.keys, self.columns), label="digests")
        old = self.stored_digests()
        buckets = changed_buckets(now, old)
        mine = table.select(*self.keys, *self.columns).withColumn("bucket", bucket_of(self.keys)).where(F.col("bucket").isin(buckets))
        stored = self._stored_rows(old, buckets, mine.schema)
        marked = lambda d, side: d.select(*self.keys, _row_digest([*self.keys, *self.columns]).alias(side))
        both = marked(mine, "_new").join(marked(stored, "_old"), self.keys, "full_outer")
        change = F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNull(), "delete").otherwise("update")
        rows = both.where(~F.col("_new").eqNullSafe(F.col("_old"))).select(*self.keys, change.alias("change"))
        return Changes(buckets, rows, now)

    def save(self, table: DataFrame, changes: Changes) -> None:
        """Make ``table`` the stored version; only groups with changed buckets are written."""
        if not changes.buckets and self._newest() is not None:
            return
        version = uuid.uuid4().hex
        groups = sorted({b // BUCKETS_PER_GROUP for b in changes.buckets})
        bucket = bucket_of(self.keys)
        rows = table.select(*self.keys, *self.columns, bucket.alias("bucket")).withColumn("grp", F.expr(f"bucket div {BUCKETS_PER_GROUP}").cast("int"))
        (
            rows.where(F.col("grp").isin(groups)).hint("rebalance", "grp").sortWithinPartitions("grp", "bucket")
            .write.mode("overwrite").partitionBy("grp").parquet(f"{self.path}/rows/{version}")
        )
        held = self.stored_digests().select("grp", "held").distinct().where(~F.col("grp").isin(groups))
        mine = changes.digests.join(held, "grp", "left").withColumn("held", F.coalesce("held", F.lit(version)))
        storage.materialize(mine.select("grp", "bucket", *(F.col(c).cast(t).alias(c) for c, t in zip(_SUMS, ("bigint", "decimal(30,0)", "decimal(30,0)"))), "held").coalesce(1), f"{self.path}/digests/{version}")
        made = self._versions().agg(F.coalesce(F.max("made"), F.lit(0)).alias("made")).first().made
        self.spark.createDataFrame([(version, made + 1)], _VERSION).coalesce(1).write.mode("append").parquet(f"{self.path}/versions")
