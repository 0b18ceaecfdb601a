"""Target-distribution importance resampling over hashed words and word pairs.

The ``tokenizers`` library cuts a text, A-Z in lower case, by an untrained regular-expression split, and gives every word
with its byte offsets. A feature is the window of one offset pair, or of two neighbouring ones joined by one space; its bucket is
the CRC-32 of the window's bytes modulo ``BUCKETS``. The checksum of a pair goes on from that of its first word.

Each task adds up a histogram of its own; Spark sums them, for the corpus and for the target. A bucket's gain is the floored
logarithm of how much commoner it is in the target, and a document's weight the floored mean of its features' gains. Seeded
Gumbel noise makes the highest scores a draw without replacement. Texts are split once: their buckets, two bytes for each
feature, are written and read back for the weights. What goes to the driver and to all tasks is a number for each bucket,
however large the tables are. Ranks come from a range-partitioned order, without a window over all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from ..operators.ids import in_order, number_stored
from ..storage import materialize
from .batches import bytes_and_offsets, slices

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
PERCENT, SEED, LEAST_WORDS = 25, 7, 20


class Splitter:
    """Words of a text with their byte offsets, and the buckets of its features."""

    def __init__(self) -> None:
        from tokenizers import PreTokenizedString, Regex, pre_tokenizers

        self.split = pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)
        self.start = PreTokenizedString

    def words(self, text: str) -> list[tuple[str, tuple[int, int], None]]:
        """Each word of a text in lower case, and where its bytes start and end."""
        found = self.start(text)
        self.split.pre_tokenize(found)
        return found.get_splits(offset_referential="original", offset_type="byte") if text else []

    def buckets(self, text: str) -> tuple[int, np.ndarray]:
        """The number of words, and the buckets of all words and then of all pairs."""
        raw = text.encode()
        spans = [raw[a:b] for _, (a, b), _ in self.words(text)]
        ones = list(map(crc32, spans))
        pairs = map(crc32, [b" " + s for s in spans[1:]], ones)
        return len(spans), (np.array([*ones, *pairs], np.int64) % BUCKETS).astype("<u2")


def _features(docs: DataFrame, text_col: str, keep: list[str], names: tuple[str, str]) -> DataFrame:
    """The columns ``keep`` of ``docs``, the number of words, and the buckets as 16-bit numbers."""
    inner = "_text" if "_text" not in keep else next(f"_text{k}" for k in range(len(keep) + 1) if f"_text{k}" not in keep)
    rows = docs.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{text_col}`").alias(inner))
    out = StructType([*rows.schema.fields[:-1], StructField(names[0], LongType()), StructField(names[1], BinaryType())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter()
        for batch in slices(batches, inner):
            at = batch.schema.get_field_index(inner)
            found = [splitter.buckets(t) for t in pc.ascii_lower(batch.column(at)).to_pylist()]
            columns = [*batch.columns[:at], pa.array([n for n, _ in found], pa.int64()), pa.array([b.tobytes() for _, b in found], pa.binary())]
            schema = pa.schema([*list(batch.schema)[:at], pa.field(names[0], pa.int64()), pa.field(names[1], pa.binary())])
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return rows.mapInArrow(each, out)


def histogram(features: DataFrame, column: str) -> DataFrame:
    """(bucket, n): how many features each bucket holds; at most ``BUCKETS`` rows."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            raw, _ = bytes_and_offsets(batch.column(0).fill_null(b""))
            counts += np.bincount(np.frombuffer(raw.tobytes(), "<u2"), minlength=BUCKETS)
        full = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(counts[full])], ["bucket", "n"])

    return features.select(column).mapInArrow(each, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame) -> np.ndarray:
    """The gain of every bucket, from two histograms; a bucket of neither has one as well."""
    both = corpus.withColumnRenamed("n", "s").join(target.withColumnRenamed("n", "t"), "bucket", "full_outer")
    s, t = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for r in both.collect():  # at most BUCKETS rows
        s[r["bucket"]], t[r["bucket"]] = r["s"] or 0, r["t"] or 0
    ratio = (t + 1.0) * (float(s.sum()) + BUCKETS) / ((s + 1.0) * (float(t.sum()) + BUCKETS))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weighed(features: DataFrame, column: str, gain: np.ndarray, names: tuple[str, str]) -> DataFrame:
    """``features`` with the number of features and the weight in place of the buckets."""
    fields = [f for f in features.schema.fields if f.name != column]
    out = StructType([*fields, *(StructField(n, LongType()) for n in names)])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(column)
            raw, bounds = bytes_and_offsets(batch.column(at))
            sums = np.concatenate(([0], np.cumsum(gain[np.frombuffer(raw.tobytes(), "<u2")])))
            bounds = bounds // 2
            n = np.diff(bounds)
            weight = np.diff(sums[bounds]) // np.maximum(n, 1)
            rest = [k for k in range(batch.num_columns) if k != at]
            schema = pa.schema([*(batch.schema.field(k) for k in rest), *(pa.field(c, pa.int64()) for c in names)])
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in rest), pa.array(n), pa.array(weight)], schema=schema)

    return features.mapInArrow(each, out)


def noise(id_col: Column, seed: int) -> Column:
    """1000 times a standard Gumbel number, floored, that the seed and the id decide."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def with_draw(
    docs: DataFrame, target: DataFrame, percent: int = PERCENT, seed: int = SEED, least_words: int = LEAST_WORDS,
    id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text", name: str = "draw", keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` (or its columns ``keep``) with a struct column: ``n_features``, ``weight``, ``score``, ``rank``.

    Of the documents with at least ``least_words`` words, ``percent`` in 100, rounded down, are drawn; those have ranks from 1
    by falling score, equal scores by id, null ids last. Null texts have no words, and weight 0; so has everything if both
    tables are empty of words. Repeated rows are judged one by one, and share their noise where they share their id. A column of
    ``docs`` called ``name`` is an error; other columns may have any name. Empty tables give no rows.
    """
    keep = docs.columns if keep is None else keep
    if name in keep:
        raise ValueError(f"the table already has a column {name}")
    n_words, n_features, weight, score, buckets, number, able = (f"{name}_{c}" for c in ("n_words", "n_features", "weight", "score", "buckets", "number", "able"))
    if clash := {n_words, n_features, weight, score, buckets, number, able, "_pos", "_part", "_offset"} & set(keep):
        raise ValueError(f"the table has columns {sorted(clash)}; choose another name")
    q = lambda c: F.col(f"`{c}`")
    features = materialize(_features(docs, text_col, keep, (n_words, buckets)), label="features")
    aim = _features(target, target_text_col, [], (n_words, buckets))
    gain = gains(histogram(features.select(q(buckets).alias("b")), "b"), histogram(aim.select(q(buckets).alias("b")), "b"))
    rows = _weighed(features, buckets, gain, (n_features, weight))
    rows = rows.withColumn(score, q(weight) + noise(q(id_col), seed)).withColumn(able, q(n_words) >= least_words)
    order = [q(able).desc(), q(score).desc(), q(id_col).asc_nulls_last(), q(n_features), q(weight)]
    stored = materialize(in_order(rows, order), label="scored")
    drawn = stored.where(q(able)).count() * percent // 100
    out = number_stored(stored, number)
    rank = F.when(q(number) <= drawn, q(number))
    return out.select(*map(q, keep), F.struct(q(n_features).alias("n_features"), q(weight).alias("weight"), q(score).alias("score"), rank.alias("rank")).alias(name))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, **settings) -> DataFrame:
    """The rows of ``docs`` that are drawn, with their columns."""
    spare = next(f"_{k}" for k in range(len(docs.columns) + 1) if f"_{k}" not in docs.columns)
    return with_draw(docs, target, percent, name=spare, **settings).where(F.col(spare)["rank"].isNotNull()).drop(spare)


def report(docs: DataFrame, target: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank."""
    found = with_draw(docs.select("doc_id", "text"), target, keep=["doc_id"])
    return found.select("doc_id", *(F.col("draw")[c].alias(c) for c in ("n_features", "weight", "score", "rank")))


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
_FEATURES = "unnest(list_concat(w, list_transform(list_zip(w[:-2], w[2:]), lambda p: concat(p[1], ' ', p[2]))))"
#: CRC-32 by its table, whose 256 numbers come from the polynomial.
_CRC_TABLE = """SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(CAST(i AS BIGINT), CAST(range(8) AS BIGINT[])),
  lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab"""
_CRC = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, octet_length(e) + 1),
  lambda i: CAST(concat('0x', h[2 * i - 1:2 * i]) AS BIGINT))), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)"""
REPORT_SQL = f"""
WITH crc AS MATERIALIZED ({_CRC_TABLE}),
d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
f AS (SELECT r, f, count(*) AS n FROM (SELECT r, {_FEATURES} AS f FROM d) GROUP BY ALL),
g AS (SELECT f, count(*) AS n FROM (SELECT {_FEATURES} AS f FROM (SELECT {_WORDS} AS w FROM benchmark)) GROUP BY ALL),
u AS MATERIALIZED (SELECT f, {_CRC} % {BUCKETS} AS b
  FROM (SELECT f, encode(f) AS e, hex(encode(f)) AS h FROM (SELECT f FROM f UNION SELECT f FROM g)), crc),
s AS (SELECT b, sum(n) AS n FROM f JOIN u USING (f) GROUP BY b),
t AS (SELECT b, sum(n) AS n FROM g JOIN u USING (f) GROUP BY b),
gain AS (SELECT b, CAST(floor(1000 * ln((CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * CAST((SELECT coalesce(sum(n), 0) FROM s) + {BUCKETS} AS DOUBLE))
  / (CAST(s.n + 1 AS DOUBLE) * CAST((SELECT coalesce(sum(n), 0) FROM t) + {BUCKETS} AS DOUBLE)))) AS BIGINT) AS gain FROM s LEFT JOIN t USING (b)),
w AS (SELECT r, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(CAST(sum(n * gain) AS DOUBLE) / sum(n)) AS BIGINT) AS weight
  FROM f JOIN u USING (f) JOIN gain USING (b) GROUP BY r),
x AS (SELECT doc_id, len(w) >= {LEAST_WORDS} AS able, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(concat('0x', substr(sha256(concat('{SEED}:', CAST(doc_id AS VARCHAR))), 1, 8)) AS BIGINT) + 0.5::DOUBLE)
    / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM d LEFT JOIN w USING (r))
SELECT doc_id, n_features, weight, score, CASE WHEN k <= (SELECT {PERCENT} * count(*) // 100 FROM x WHERE able) THEN k END AS rank
FROM (SELECT *, row_number() OVER (ORDER BY able DESC, score DESC, doc_id) AS k FROM x)
"""
