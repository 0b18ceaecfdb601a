"""Shards by proportional stratified interleaving.

Rows of each source are ranked in a seeded order, a row's fractional rank is its rank over the rows of its source,
and the order by fractional rank is cut into shards of equal row counts. So each shard has a source's share of the
corpus, give or take a row.

No window holds a whole source or the whole table: rows are ranked in small buckets, and the row counts of the
buckets before (one row for each bucket and source) give the offset. Those are summed in blocks, and the blocks in blocks of their
own, so that no window grows with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import materialize

BUCKET_ROWS = 2048
#: Buckets, or blocks of them, in one window.
BLOCK = 1024


def _below(counts: DataFrame, keys: list[str], order: str, size: int) -> DataFrame:
    """Rows in the buckets before each bucket, and in all buckets, per ``keys``; ``order`` is from 0 to ``size`` - 1."""
    before = lambda w: F.sum("n").over(w.orderBy(order).rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    if size <= BLOCK:
        w = Window.partitionBy(*keys)
        return counts.select(*keys, order, before(w).alias("below"), F.sum("n").over(w).alias("of_all"))
    block = f"{order}_block"
    counts = counts.withColumn(block, F.expr(f"{order} div {BLOCK}"))
    blocks = _below(counts.groupBy(*keys, block).agg(F.sum("n").alias("n")), keys, block, -(-size // BLOCK))
    inside = counts.select(*keys, order, block, before(Window.partitionBy(*keys, block)).alias("inside"))
    return inside.join(blocks, [*keys, block]).select(*keys, order, (F.col("below") + F.col("inside")).alias("below"), "of_all")


def interleave(
    docs: DataFrame, n_shards: int = 16, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, source, rank (fractional), shard, slot.

    Shards differ by one row at most, and slots of a shard are 0, 1, 2 and so on. A null text has size 1 and the
    checksum of no bytes; null sources are one source; repeated rows are placed one by one; an empty table gives no
    rows; other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    ).select("*", F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size").alias("h"))
    base = materialize(base, label="shard-rows")
    n = base.count()
    buckets = max(1, -(-n // BUCKET_ROWS)) * 16
    stratum = F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), F.col("source").cast("string")))
    base = base.select("*", stratum.alias("stratum"), F.pmod("h", F.lit(buckets)).alias("b"))

    below = _below(base.groupBy("stratum", "b").agg(F.count("*").alias("n")), ["stratum"], "b", buckets)
    within = F.row_number().over(Window.partitionBy("stratum", "b").orderBy("h", "doc_id", "size", "text_crc32"))
    # Each source starts at its own point of the first step, so that small sources don't all meet at one place.
    start = (F.pmod(F.xxhash64(F.lit(seed + 1), "stratum"), F.lit(1 << 20)) + 0.5) / float(1 << 20)
    ranked = (
        base.join(below, ["stratum", "b"])
        .withColumn("nth", F.col("below") + within)
        .withColumn("rank", (F.col("nth") - 1 + start) / F.col("of_all"))
        .select("doc_id", "source", "size", "text_crc32", "stratum", "nth", "rank", F.floor(F.col("rank") * buckets).alias("place"))
    )
    ranked = materialize(ranked, label="shard-ranks")

    # One row per place, 16 for each 2,048 documents.
    placed = ranked.groupBy("place").agg(F.count("*").alias("n")).withColumn("one", F.lit(0))
    offsets = _below(placed, ["one"], "place", buckets).select("place", "below")
    at = F.col("below") + F.row_number().over(Window.partitionBy("place").orderBy("rank", "stratum", "nth")) - 1
    return (
        ranked.join(offsets, "place")
        .withColumn("at", at)
        .withColumn("shard", F.expr(f"cast(at * {n_shards}L div {max(n, 1)}L as int)"))
        .withColumn("slot", F.expr(f"at - (shard * {n}L + {n_shards - 1}L) div {n_shards}L"))
        .select("doc_id", "size", "text_crc32", "source", "rank", "shard", "slot")
    )
