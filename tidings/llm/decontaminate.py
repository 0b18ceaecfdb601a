"""Benchmark passages in documents by Wu-Manber multi-pattern search.

Words are runs of digits, letters a-z (A-Z in lower case) and all non-ASCII characters. A pattern is ten consecutive
words of an item, or all words of a shorter one, with a space before, after and between them; a document is put into
the same form, so that an occurrence of the bytes is an occurrence of the words.

Patterns of similar length share a matcher. Its shift table tells, by a hash of the last bytes of the place looked at,
how many places can't start an occurrence and are skipped; at shift 0 a bucket keyed by those bytes names the patterns
to compare directly. Many cursors, each on its own stretch of the batch, are moved together by numpy.

The distinct patterns are the query set. They are cut by hash into blocks of at most ``BLOCK_BYTES``; each block goes to the
tasks by itself, with one pass over the documents per block. Tasks know patterns by number only. Which items have a pattern is
a table, joined in Spark with the distinct sets of patterns that documents hold, however many items share one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from ..storage import materialize
from .batches import bytes_and_offsets, ranges, slices

WINDOW = 10
BLOCK_BYTES = 8 << 20
CURSORS = 1 << 13
SPACE, START = 0x20, 0x01

_LOWER = np.full(256, SPACE, np.uint8)
_LOWER[0x30:0x3A] = np.arange(0x30, 0x3A)
_LOWER[0x41:0x5B] = _LOWER[0x61:0x7B] = np.arange(0x61, 0x7B)
_LOWER[0x80:] = np.arange(0x80, 0x100)


def normal_form(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts as one byte array, the places of the spaces before words, and the n + 1 bounds of the texts in those.

    Each text is a start byte, then its words with one space before, between and after them.
    """
    raw, offsets = bytes_and_offsets(texts)
    n = len(texts)
    wide = np.full(len(raw) + 3 * n, SPACE, np.uint8)
    firsts = offsets[:-1] + 3 * np.arange(n)
    wide[firsts] = START
    wide[ranges(firsts + 2, np.diff(offsets))] = _LOWER[raw]
    space = wide == SPACE
    keep = np.ones(len(wide), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    data = wide[keep]
    space = data == SPACE
    before = np.flatnonzero(space[:-1] & (data[1:] > SPACE)) if n else np.zeros(0, np.int64)
    bounds = np.searchsorted(before, np.concatenate((np.flatnonzero(data == START), [len(data)])))
    return data, before, bounds


def windows(data: np.ndarray, before: np.ndarray, bounds: np.ndarray, size: int = WINDOW) -> Iterator[tuple[int, bytes]]:
    """(text, pattern) of every window."""
    raw = data.tobytes()
    for t in range(len(bounds) - 1):
        lo, hi = int(bounds[t]), int(bounds[t + 1])
        n = min(size, hi - lo)
        for k in range(lo, hi - n + 1) if n else ():
            last = raw.index(b" ", int(before[k + n - 1]) + 1)
            yield t, raw[int(before[k]) : last + 1]


class Matcher:
    """Wu-Manber search for patterns whose lengths are less than a factor of two apart."""

    def __init__(self, patterns: list[bytes], numbers: list[int]):
        self.least = min(map(len, patterns))
        self.size = min(8, self.least)
        self.mask = np.uint64((1 << 8 * self.size) - 1)
        heads = np.frombuffer(b"".join(p[: self.least] for p in patterns) + bytes(8), np.uint8)
        places = self.least - self.size + 1
        starts = (np.arange(len(patterns)) * self.least)[:, None] + np.arange(places)
        blocks = self._blocks(heads, starts.ravel()).reshape(starts.shape)
        self.bits = max(10, int(8 * blocks.size - 1).bit_length())
        self.shift = np.full(1 << self.bits, min(places, 255), np.uint8)
        for j in range(places):  # later places have smaller shifts
            self.shift[self._hash(blocks[:, j])] = min(places - 1 - j, 255)
        order = np.argsort(blocks[:, -1], kind="stable")
        self.suffix, self.prefix = blocks[order, -1], blocks[order, 0]
        self.patterns = [patterns[k] for k in order]
        self.numbers = np.array(numbers)[order]
        self.lengths = np.array([len(p) for p in self.patterns])

    def _blocks(self, padded: np.ndarray, at: np.ndarray) -> np.ndarray:
        every = np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), (len(padded) - 7,), (1,), writeable=False)
        return every[at] & self.mask

    def _hash(self, blocks: np.ndarray) -> np.ndarray:
        return (blocks * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)

    def candidates(self, padded: np.ndarray) -> np.ndarray:
        """Places, in no order, that the shift table can't rule out."""
        stop = len(padded) - 8 - self.least + 1
        if stop <= 0:
            return np.zeros(0, np.int64)
        cuts = np.linspace(0, stop, max(1, min(CURSORS, stop // 64)) + 1).astype(np.int64)
        at, end, found = cuts[:-1].copy(), cuts[1:], []
        while len(at):
            skip = self.shift[self._hash(self._blocks(padded, at + (self.least - self.size)))]
            found.append(at[skip == 0])
            at = at + np.maximum(skip, 1)
            going = at < end
            if not going.all():
                at, end = at[going], end[going]
        return np.concatenate(found)

    def search(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, pattern number) of every occurrence."""
        padded = np.concatenate((data, np.zeros(8, np.uint8)))
        at = self.candidates(padded)
        suffix = self._blocks(padded, at + (self.least - self.size))
        lo, hi = np.searchsorted(self.suffix, suffix, "left"), np.searchsorted(self.suffix, suffix, "right")
        pattern, at = ranges(lo, hi - lo), np.repeat(at, hi - lo)
        same = self._blocks(padded, at) == self.prefix[pattern]
        pattern, at = pattern[same], at[same]
        raw = data.tobytes()
        equal = np.fromiter((raw.startswith(self.patterns[p], a) for p, a in zip(pattern.tolist(), at.tolist())), bool, len(at))
        return at[equal], self.numbers[pattern[equal]]


def matchers(patterns: list[bytes]) -> list[Matcher]:
    """One matcher for each power of two that the lengths span."""
    classes: dict[int, list[int]] = {}
    for k, p in enumerate(patterns):
        classes.setdefault(len(p).bit_length(), []).append(k)
    return [Matcher([patterns[k] for k in ks], ks) for _, ks in sorted(classes.items())]


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def occurrences(texts: pa.Array, found_by: list[Matcher], sizes: np.ndarray) -> tuple[np.ndarray, dict[int, tuple[list, set]]]:
    """Words per text, and for texts with occurrences their merged word spans and the pattern numbers."""
    data, before, bounds = normal_form(texts)
    hits: dict[int, tuple[list, set]] = {}
    for matcher in found_by:
        at, pattern = matcher.search(data)
        word = np.searchsorted(before, at)
        text = np.searchsorted(bounds, word, "right") - 1
        for t, first, p in zip(text.tolist(), (word - bounds[text]).tolist(), pattern.tolist()):
            spans, numbers = hits.setdefault(t, ([], set()))
            spans.append((first, first + int(sizes[p]) - 1))
            numbers.add(p)
    return np.diff(bounds), {t: (_merged(s), p) for t, (s, p) in hits.items()}


SPANS = ArrayType(StructType([StructField("first", LongType()), StructField("last", LongType())]))


def _scan(docs: DataFrame, text_col: str, names: tuple[str, str, str], block: list[tuple[bytes, int]]) -> DataFrame:
    """Add the block's occurrences to the columns ``names``: words, spans and sorted pattern numbers."""
    shared = docs.sparkSession.sparkContext.broadcast(block)
    words_col, spans_col, found_col = names
    fields = [f for f in docs.schema.fields if f.name not in names]
    out = StructType([*fields, StructField(words_col, LongType()), StructField(spans_col, SPANS), StructField(found_col, ArrayType(LongType()))])
    first_block = words_col not in docs.columns
    kinds = [pa.int64(), pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())])), pa.list_(pa.int64())]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns, ids = [p for p, _ in shared.value], [i for _, i in shared.value]
        sizes = np.array([p.count(b" ") - 1 for p in patterns])
        found_by = matchers(patterns)
        for whole in batches:
            n_words, spans, found = [], [], []
            for batch in slices(iter([whole]), text_col):
                counts, hits = occurrences(batch.column(text_col), found_by, sizes)
                n_words.append(counts)
                old = [([], [])] * batch.num_rows if first_block else list(zip(batch.column(spans_col).to_pylist(), batch.column(found_col).to_pylist()))
                for t in range(batch.num_rows):
                    new_spans, numbers = hits.get(t, ([], ()))
                    old_spans = [(s["first"], s["last"]) for s in old[t][0]]
                    spans.append([{"first": a, "last": b} for a, b in (_merged(old_spans + new_spans) if old_spans else new_spans)])
                    found.append(sorted([ids[p] for p in numbers] + old[t][1]))  # no pattern is in two blocks
            columns = [whole.column(f.name) for f in fields]
            added = [pa.array(np.concatenate(n_words) if n_words else [], kinds[0]), pa.array(spans, kinds[1]), pa.array(found, kinds[2])]
            schema = pa.schema([*(whole.schema.field(f.name) for f in fields), *(pa.field(n, k) for n, k in zip(names, kinds))])
            yield pa.RecordBatch.from_arrays([*columns, *added], schema=schema)

    return docs.mapInArrow(each, out)


def pattern_table(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(pattern binary, item string): the distinct windows of each item."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = list(windows(*normal_form(batch.column(1))))
            items = batch.column(0).take(pa.array([t for t, _ in found], pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([p for _, p in found], pa.binary()), items], ["pattern", "item"])

    rows = benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    return rows.mapInArrow(each, "pattern binary, item string").distinct()


def numbered(pairs: DataFrame) -> DataFrame:
    """(pattern, number): the distinct patterns of ``pairs``, written, so that a number stays with its pattern."""
    return materialize(pairs.select("pattern").distinct().withColumn("number", F.monotonically_increasing_id()), label="patterns")


def scanned(docs: DataFrame, patterns: DataFrame, names: tuple[str, str, str], text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with its number of words, the merged spans of words inside occurrences (0-based, both ends included), and the
    sorted numbers of the occurring patterns."""
    if clash := set(names) & set(docs.columns):
        raise ValueError(f"the table already has columns {sorted(clash)}")
    total = patterns.agg(F.sum(F.length("pattern") + 40)).first()[0] or 0
    n_blocks = max(1, -(-total // block_bytes))
    for k in range(n_blocks):
        rows = patterns.where(F.pmod(F.xxhash64("pattern"), F.lit(n_blocks)) == k).collect()  # at most about block_bytes
        docs = _scan(docs, text_col, names, [(bytes(r["pattern"]), r["number"]) for r in rows])
        if k + 1 < n_blocks:
            docs = materialize(docs, label="scanned")
    return docs


def _with_items(found: DataFrame, pairs: DataFrame, patterns: DataFrame, column: str) -> DataFrame:
    """``found`` with item ids, sorted and distinct, instead of the pattern numbers in ``column``.

    Documents that hold the same patterns, such as copies, share one list; those without any aren't shuffled.
    """
    found = materialize(found, label="found")
    hit = found.where(F.size(column) > 0)
    items = pairs.where(F.col("item").isNotNull()).join(patterns, "pattern").select("number", "item")
    sets = hit.select(F.col(column).alias("numbers")).distinct()
    lists = sets.withColumn("number", F.explode("numbers")).join(items, "number", "left").groupBy("numbers").agg(F.array_sort(F.collect_set("item")).alias("items"))
    lists = materialize(lists, label="items")  # a plain table, so that a set many documents hold can be split in the join
    joined = hit.join(lists, hit[column] == lists["numbers"]).select(*(lists["items"].alias(c) if c == column else hit[c] for c in found.columns))
    none = found.where(F.size(column) == 0).withColumn(column, F.array().cast("array<string>"))
    return none.unionAll(joined)


def with_occurrences(
    docs: DataFrame, benchmark: DataFrame, names: tuple[str, str, str] = ("n_words", "spans", "items"), text_col: str = "text",
    block_bytes: int = BLOCK_BYTES, keep_text: bool = True
) -> DataFrame:
    """``docs`` with its number of words, the merged spans of words inside occurrences (0-based, both ends included),
    and the ids, as sorted strings, of the items with occurring windows.

    Null and wordless texts have no words and no spans; items without words have no windows; items with equal windows
    are all named, repeated ids once, null ids never. Without items nothing is hit. Rows stay as they are, repeated
    ones too. A column of ``docs`` named like one of ``names`` is an error; choose other names then. The result is
    written on the way; without ``keep_text`` that leaves out the text.
    """
    pairs = materialize(pattern_table(benchmark), label="pattern_items")
    patterns = numbered(pairs)
    found = scanned(docs, patterns, names, text_col, block_bytes)
    return _with_items(found if keep_text else found.drop(text_col), pairs, patterns, names[2])


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = with_occurrences(docs.select("doc_id", "text"), benchmark, keep_text=False)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no window of ``benchmark`` occurs, with their columns."""
    spare = [f"_{k}" for k in range(len(docs.columns) + 3) if f"_{k}" not in docs.columns][:3]
    return scanned(docs, numbered(pattern_table(benchmark)), tuple(spare), text_col).where(F.size(spare[1]) == 0).drop(*spare)


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
REPORT_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS p FROM (
  SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS p FROM (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
occ AS (SELECT doc_id, i, n, item_id FROM dw JOIN win USING (n, p)),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (
  SELECT doc_id, unnest(range(i, i + n)) AS k FROM (SELECT DISTINCT doc_id, i, n FROM occ)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS names FROM (
  SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""
