"""Repeated passages by recompression.

Words are named by a 64-bit hash, and rounds of recompression name runs and pairs of names: a run of one name becomes
one symbol, then each symbol falls on the left or right side by a bit of its name, and a left one followed by a right
one becomes one symbol. A name is a hash of what it stands for, so equal substrings get equal names in every task
without an exchange; only symbols near a substring's ends depend on what surrounds it.

How near is known. A run stays one frozen symbol whatever its length, and pairs at most double a symbol, so two rounds
reach 2 * (1 + 2) = 6 words from either end, and the 38 words in the middle of a 50-word window are parsed alike
wherever it stands. A symbol has four words at most, so one starts among any four of them. The start with the smallest
name among the first 34 is the window's anchor, at the same place in all its occurrences.

Spark groups anchors by the words around them that every such window holds, 6 before and 10 from its start on. Anchors
that two different texts share tell which windows can repeat; those windows are named by 128 bits of their text, and Spark
finds the smallest doc_id of each name. The names decide which windows repeat; anchors only choose which are named. Equal
texts are found by their checksum, and all windows of a copy are repeats. Names of windows and the smallest doc_ids of
those that repeat are written before they are joined, so that Spark can split a passage that very many documents share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..storage import materialize
from .batches import bytes_and_offsets, join_words, slices, split_words

ROUNDS = 2
#: Words that the rounds reach from the end of a window, and the longest symbol after them.
REACH = 2 * ((1 << ROUNDS) - 1)
LONGEST = 1 << ROUNDS
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def least_window() -> int:
    """The shortest window with an anchor: both reaches, words that hold a start, and the symbol that starts last."""
    return 2 * REACH + 2 * LONGEST


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_names(words: pa.Array) -> np.ndarray:
    coded = pc.dictionary_encode(words)
    digest = xxhash.xxh64_intdigest
    names = np.fromiter((digest(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()), np.uint64, len(coded.dictionary))
    return names[np.asarray(coded.indices)] if len(words) else np.zeros(0, np.uint64)


def symbol_starts(names: np.ndarray, bounds: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """For each word the name of the symbol that starts there, or ``NONE``. Each copy in a run is a start."""
    out = np.full(len(names), NONE)
    first = np.zeros(len(names) + 1, bool)
    first[bounds] = True  # no run or pair reaches into the next text
    symbol, start, frozen = names, np.arange(len(names)), np.zeros(len(names), bool)
    for t in range(rounds):
        salt = np.uint64(0x9E3779B97F4A7C15 * (2 * t + 1) & 0xFFFFFFFFFFFFFFFF)
        # Runs: all copies but the first go, and the first gets the run's name.
        like = np.zeros(len(symbol), bool)
        like[1:] = (symbol[1:] == symbol[:-1]) & ~first[start[1:]] & ~frozen[1:] & ~frozen[:-1]
        in_run = like.copy()
        in_run[:-1] |= like[1:]
        named = _mix(symbol[in_run] ^ salt) | np.uint64(1)
        out[start[in_run]] = np.minimum(named, NONE - np.uint64(1))
        symbol = symbol.copy()
        symbol[in_run] = named
        frozen = frozen | in_run
        symbol, start, frozen = symbol[~like], start[~like], frozen[~like]
        # Pairs.
        left = (_mix(symbol + salt) & np.uint64(1)).astype(bool)
        pair = np.zeros(len(symbol), bool)
        pair[:-1] = left[:-1] & ~left[1:] & ~first[start[1:]] & ~frozen[:-1] & ~frozen[1:]
        at = np.flatnonzero(pair)
        symbol[at] = _mix(symbol[at] * np.uint64(0xA0761D6478BD642F) + symbol[at + 1] * np.uint64(0xE7037ED1A0B428DB) + salt)
        keep = np.ones(len(symbol), bool)
        keep[at + 1] = False
        symbol, start, frozen = symbol[keep], start[keep], frozen[keep]
    whole = ~frozen
    out[start[whole]] = np.minimum(symbol[whole] | np.uint64(1), NONE - np.uint64(1))
    return out


def window_anchors(names: np.ndarray, bounds: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The word place of each window of ``window`` words, and that of its anchor."""
    choose = window - 2 * REACH - LONGEST
    counts = np.diff(bounds)
    within = np.arange(len(names)) - np.repeat(bounds[:-1], counts)
    left = np.repeat(counts, counts) - within
    starts = symbol_starts(names, bounds)
    least, width = np.arange(len(names)), 1  # the first of the smallest names among ``width`` words from each on
    while width < choose and len(names) > 1:
        step = min(width, choose - width, len(names) - 1)
        here, there = least[:-step], least[step:]
        least = np.concatenate((np.where(starts[there] < starts[here], there, here), least[-step:]))
        width += step
    chosen = np.flatnonzero((within >= REACH) & (left >= window - REACH))  # windows lie within a text
    return chosen - REACH, least[chosen]


def _around(names: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """A hash of the words that every window with its anchor at ``at`` holds."""
    key = np.zeros(len(at), np.uint64)
    choose = window - 2 * REACH - LONGEST
    for k in range(-REACH, window - REACH - choose + 1):
        key = key * np.uint64(0x9E3779B97F4A7C15) + names[at + k]
    return _mix(key)


def _anchor_rows(window: int):
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words, bounds = split_words(batch.column(2))
            names = word_names(words)
            at = np.unique(window_anchors(names, bounds, window)[1])
            text = np.searchsorted(bounds, at, "right") - 1
            rows = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(_around(names, at, window).view(np.int64)), batch.column(0).take(rows), batch.column(1).take(rows),
                 pa.array((at - bounds[text]).astype(np.int32))],
                ["key", "id", "h", "at"])

    return each


def _window_rows(window: int):
    """(name, id, h, at) of the windows whose anchor is one of ``places``, without those of ``copies``."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words, bounds = split_words(batch.column("text"))
            raw = bytes_and_offsets(join_words(words, bounds))[0].tobytes()
            lengths = np.asarray(pc.binary_length(words)).astype(np.int64)
            counts = np.diff(bounds)
            # Joined texts stand one after the other without a space between them.
            starts = np.cumsum(lengths + 1) - (lengths + 1) - np.repeat(np.cumsum(counts > 0) - (counts > 0), counts)
            shared = np.zeros(len(words), bool)
            for t, (h, found, copies) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("h", "places", "copies")))):
                if h not in copies:
                    at = np.array(found, np.int64)
                    shared[bounds[t] + at[at < counts[t]]] = True  # another text may have the same id
            first, anchor = window_anchors(word_names(words), bounds, window)
            first = first[shared[anchor]]
            last = first + window - 1
            names = [xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(starts[first].tolist(), (starts[last] + lengths[last]).tolist())]
            text = np.searchsorted(bounds, first, "right") - 1
            rows = pa.array(text)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.binary()), batch.column("id").take(rows), batch.column("h").take(rows), pa.array((first - bounds[text]).astype(np.int32))],
                ["name", "id", "h", "at"])

    return each


def _without(window: int, respace: bool):
    """Take the words of the windows that start at ``gone`` (h, at) out of each text; -1 stands for all windows."""

    def one(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        words, bounds = split_words(batch.column("text"))
        counts = np.diff(bounds)
        change = np.zeros(len(words) + 1, np.int64)
        for t, (h, gone) in enumerate(zip(batch.column("h").to_pylist(), batch.column("gone").to_pylist())):
            places = np.array([g["at"] for g in gone or () if g["h"] == h], np.int64)
            if (places == -1).any():
                places = np.arange(max(0, counts[t] - window + 1))
            np.add.at(change, bounds[t] + places, 1)
            np.add.at(change, bounds[t] + places + window, -1)
        stays = np.cumsum(change)[:-1] == 0
        bounds = np.concatenate(([0], np.cumsum(stays)))[bounds]
        lost = counts - np.diff(bounds)
        texts = join_words(words.filter(pa.array(stays)), bounds)
        return counts, lost, texts if respace else pc.if_else(pa.array(lost > 0), texts, batch.column("text"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [one(x) for x in slices(iter([batch]), "text")] or [(np.zeros(0, np.int64), np.zeros(0, np.int64), pa.array([], pa.string()))]
            n_words, n_removed = (pa.array(np.concatenate([p[k] for p in parts])) for k in (0, 1))
            kept = pa.concat_arrays([p[2] for p in parts])
            if not respace:
                kept = pc.if_else(batch.column("text").is_valid(), kept, pa.scalar(None, pa.string()))
            row = batch.schema.get_field_index("row")
            yield pa.RecordBatch.from_arrays(
                [batch.column(row), n_words, n_removed, kept],
                schema=pa.schema([batch.schema.field(row), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())]))

    return each


def shared_places(rows: DataFrame, window: int) -> DataFrame:
    """(id, places, copies): the anchors of its texts that a different text has too, and the hashes of its texts that
    a smaller id has.

    ``rows`` has id (not null), h and text. Keys are combined to their smallest and largest text before they are joined
    back, so an anchor that many texts share is one row there. The shared keys are written, as Spark splits a hot key of a
    join between shuffled tables, but not of one with an aggregate right below.
    """
    found = rows.select("id", "h", "text").mapInArrow(_anchor_rows(window), "key long, id long, h long, at int")
    shared = found.groupBy("key").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo < hi").select("key")
    shared = materialize(shared, label="shared-anchors")
    texts = rows.select("id", "h", F.md5(F.col("text").cast("binary")).alias("m"))
    first = texts.groupBy("m").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi")
    first = materialize(first, label="first-copies")
    copies = texts.join(first, "m").where("lo < id").select("id", F.lit(None).cast("int").alias("at"), "h")
    places = found.select("key", "id", "at").join(shared, "key").select("id", "at", F.lit(None).cast("long").alias("h"))
    return places.union(copies).groupBy("id").agg(F.collect_set("at").alias("places"), F.collect_set("h").alias("copies"))


def without_repeats(
    docs: DataFrame, window: int = 50, respace: bool = False, names: tuple[str, str] = ("n_words", "n_removed"),
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``docs`` with repeated passages taken out of the text, and the numbers of words before and of words removed.

    Words are runs of anything but ASCII white space. A word goes if a window of ``window`` consecutive words around it
    also stands in a document with a smaller id; all windows are judged on the texts as given. What is left is joined
    by one space where words were removed, or everywhere with ``respace``. Null and short texts have no windows, and
    neither has a null id, which also gives none. Rows of one id, repeated ones too, don't take from each other. All
    columns are kept; one of the table's that is named like one of ``names`` is an error.
    """
    if window < least_window():
        raise ValueError(f"a window of fewer than {least_window()} words need not hold an anchor")
    if clash := set(names) & set(docs.columns):
        raise ValueError(f"the table already has columns {sorted(clash)}")
    others = [F.col(c) for c in docs.columns if c != text_col]
    # The key can't be null, so that both joins below see the same shuffled texts, which Spark then shuffles once.
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("id"), F.xxhash64(text_col).alias("h"),
        F.col(text_col).alias("text"), F.struct(*others).alias("row"))
    numbered = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text"))
    places = materialize(shared_places(numbered, window), label="anchors")

    named = rows.join(places.where(F.size("places") > 0), "id").mapInArrow(_window_rows(window), "name binary, id long, h long, at int")
    named = materialize(named, label="named-windows")
    first = named.groupBy("name").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("name", "lo")
    first = materialize(first, label="first-windows")
    gone = named.join(first, "name").where("lo < id").select("id", "h", "at")
    copies = places.select("id", F.explode("copies").alias("h"), F.lit(-1).alias("at"))
    gone = gone.union(copies).groupBy("id").agg(F.collect_set(F.struct("h", "at")).alias("gone"))
    out = StructType([StructField("row", rows.schema["row"].dataType), StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept", StringType())])
    done = rows.join(gone, "id", "left").select("h", "text", "row", "gone").mapInArrow(_without(window, respace), out)
    columns = [F.col("kept").alias(text_col) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns]
    return done.select(*columns, F.col("n_words").alias(names[0]), F.col("n_removed").alias(names[1]))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256."""
    left = without_repeats(docs.select("doc_id", "text"), respace=True)
    return left.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


REPORT_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS p FROM (
  SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
first AS (SELECT p, min(doc_id) AS m FROM win GROUP BY p),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS k FROM win JOIN first USING (p) WHERE m < doc_id),
words AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS k FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY k) AS s
  FROM words ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(s, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
