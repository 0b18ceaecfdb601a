"""Near duplicates by SimHash: a binary trie of fingerprints is joined with itself.

Two fingerprints that differ in at most ``budget`` bits agree in some choice of ``blocks - budget`` of ``blocks`` bit
blocks. So Spark deals each distinct fingerprint to one bucket per choice, keyed by the agreeing bits. Inside a bucket
the other bits form a trie, and the trie is joined with itself: pairs of nodes are followed downwards together, the
differing bits are added up, and a pair is dropped when it exceeds the budget. A bucket has at most 2^22 distinct
fingerprints however large a group of copies is, and one fingerprint has at most 254 neighbours in it. Of the links
found in a bucket only one per fingerprint leaves it: that to the smallest of its component there.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..storage import materialize
from .batches import bytes_and_offsets, join_words, slices, split_words
from .components import components

SEED = 42


def shingle_bounds(lengths: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all shingles in texts of joined words, and the number of shingles per text."""
    counts = np.diff(bounds)
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    # Texts stand one after the other without a space between them.
    starts -= np.repeat(np.cumsum(counts > 0) - (counts > 0), counts)
    shingles = np.where(counts > 0, np.maximum(counts - width + 1, 1), 0)
    firsts = np.repeat(bounds[:-1] - (np.cumsum(shingles) - shingles), shingles) + np.arange(shingles.sum())
    lasts = firsts + np.repeat(np.minimum(counts, width) - 1, shingles)
    return starts[firsts], starts[lasts] + lengths[lasts], shingles


def fingerprints(texts: pa.Array, width: int = 3) -> np.ndarray:
    """SimHash of each text over shingles of ``width`` words, unsigned 64-bit; 0 for a text without words."""
    words, bounds = split_words(pc.ascii_lower(texts))
    lengths = np.asarray(pc.binary_length(words)).astype(np.int64)
    data, _ = bytes_and_offsets(join_words(words, bounds))
    starts, ends, shingles = shingle_bounds(lengths, bounds, width)
    out = np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(shingles)
    if not len(full):
        return out
    raw, digest = data.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(raw[s:e], SEED) for s, e in zip(starts.tolist(), ends.tolist())), np.uint64, len(starts))
    votes = np.zeros((len(full), 64), np.int64)
    firsts = np.cumsum(shingles) - shingles
    step = 1 << 17  # shingles at a time, so that the bit matrix stays small
    text_of = np.repeat(np.arange(len(texts)), shingles)
    place = np.full(len(texts), -1)
    place[full] = np.arange(len(full))
    for k in range(0, len(hashes), step):
        part = hashes[k : k + step]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        cuts = np.unique(np.concatenate(([0], firsts[full][(firsts[full] > k) & (firsts[full] < k + len(part))] - k)))
        votes[place[text_of[k + cuts]]] += np.add.reduceat(bits, cuts, axis=0, dtype=np.int64)
    ones = votes * 2 > shingles[full][:, None]
    out[full] = np.packbits(ones, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def with_fingerprint(docs: DataFrame, text_col: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with the SimHash of the whole text as a signed long (its 64 bits); null and wordless texts get 0."""
    if name in docs.columns:
        raise ValueError(f"the table already has a column {name}")

    def each(batches):
        schema = pa.schema([(name, pa.int64())])
        for batch in batches:
            parts = [fingerprints(s.column(0)).view(np.int64) for s in slices(iter([batch.select([text_col])]), text_col)]
            column = pa.array(np.concatenate(parts)) if parts else pa.array([], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], schema=pa.schema([*batch.schema, *schema]))

    return docs.mapInArrow(each, StructType([*docs.schema.fields, StructField(name, LongType())]))


def masks(bits: int = 64, blocks: int = 6, budget: int = 2) -> list[int]:
    """One mask per choice of ``blocks - budget`` blocks: the bits in which a pair of the bucket agrees."""
    cuts = [round(k * bits / blocks) for k in range(blocks + 1)]
    of = [(1 << cuts[k + 1]) - (1 << cuts[k]) for k in range(blocks)]
    return [sum(of[k] for k in kept) for kept in combinations(range(blocks), blocks - budget)]


def _gather(values: np.ndarray, positions: list[int]) -> np.ndarray:
    """The chosen bits of each value, close together."""
    out = np.zeros(len(values), np.uint64)
    for k, p in enumerate(positions):
        out |= ((values >> np.uint64(p)) & np.uint64(1)) << np.uint64(k)
    return out


def trie_pairs(values: np.ndarray, bounds: np.ndarray, bits: int, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i < j) of all pairs of one bucket that differ in at most ``budget`` bits.

    ``values`` are distinct and ascending inside each bucket [bounds[k], bounds[k + 1]). A node of a bucket's trie is a
    range of values with a common prefix; all node pairs of a level are followed at once.
    """
    lo = bounds[:-1][np.diff(bounds) > 1]
    hi = bounds[1:][np.diff(bounds) > 1]
    a, b, c, d, off = lo, hi, lo, hi, np.zeros(len(lo), np.int64)
    found = []
    for level in range(bits - 1, -1, -1):
        bit = (values >> np.uint64(level)) & np.uint64(1)
        zeros = np.concatenate(([0], np.cumsum(bit == 0)))
        cut_ab, cut_cd = a + zeros[b] - zeros[a], c + zeros[d] - zeros[c]
        same = (a == c) & (b == d)
        every = np.ones(len(a), bool)
        pairs = [(a, cut_ab, c, cut_cd, off, every), (cut_ab, b, cut_cd, d, off, every),
                 (a, cut_ab, cut_cd, d, off + 1, every), (cut_ab, b, c, cut_cd, off + 1, ~same)]
        a, b, c, d, off = (np.concatenate([p[k][p[5]] for p in pairs]) for k in range(5))
        alone = (b - a == 1) & (a == c) & (b == d)  # a leaf with itself
        keep = (b > a) & (d > c) & (off <= budget) & ~alone
        a, b, c, d, off = a[keep], b[keep], c[keep], d[keep], off[keep]
        # Two leaves: the rest of their bits is compared at once.
        leaves = (b - a == 1) & (d - c == 1)
        i, j = a[leaves], c[leaves]
        near = np.bitwise_count(values[i] ^ values[j]) <= budget
        found.append((np.minimum(i, j)[near], np.maximum(i, j)[near]))
        a, b, c, d, off = a[~leaves], b[~leaves], c[~leaves], d[~leaves], off[~leaves]
        if not len(a):
            break
    return np.concatenate([f[0] for f in found] or [lo]), np.concatenate([f[1] for f in found] or [lo])


def smallest_linked(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest position of each position's component."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        following = root.copy()
        np.minimum.at(following, root[i], low)
        np.minimum.at(following, root[j], low)
        following = following[following]
        if (following == root).all():
            return root
        root = following


def _bucket_links(budget: int, blocks: int):
    rest = [[p for p in range(64) if not mask >> p & 1] for mask in masks(64, blocks, budget)]

    def links(table: np.ndarray, key: np.ndarray, value: np.ndarray) -> pa.RecordBatch:
        out = []
        for t in np.unique(table):
            at = np.flatnonzero(table == t)
            small = _gather(value[at].view(np.uint64), rest[t])
            order = np.lexsort((small, key[at]))
            at, small = at[order], small[order]
            new = np.flatnonzero(np.concatenate(([True], key[at][1:] != key[at][:-1], [True])))
            i, j = trie_pairs(small, new, len(rest[t]), budget)
            if len(i):
                root = smallest_linked(len(at), i, j)
                linked = np.flatnonzero(root != np.arange(len(at)))
                out.append((value[at][linked], value[at][root[linked]]))
        a, b = (np.concatenate([x[k] for x in out]) if out else np.zeros(0, np.int64) for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    def each(batches):
        held = None
        for batch in batches:  # sorted by table and key: only the last bucket of a batch can go on in the next
            now = [np.asarray(batch.column(k)) for k in range(3)]
            held = now if held is None else [np.concatenate(x) for x in zip(held, now)]
            if not len(held[0]):
                continue
            last = (held[0] == held[0][-1]) & (held[1] == held[1][-1])
            whole = ~last
            if whole.any():
                yield links(*(x[whole] for x in held))
            held = [x[last] for x in held]
        if held is not None and len(held[0]):
            yield links(*held)

    return each


def near_links(values: DataFrame, budget: int = 2, blocks: int = 6) -> DataFrame:
    """(a, b): links that join all fingerprints differing in at most ``budget`` bits into the right components.

    ``values`` has one long column, ``fingerprint``, of distinct values.
    """
    cases = F.array(*(F.struct(F.lit(t).alias("t"), F.col("fingerprint").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)).alias("k"))
                      for t, m in enumerate(masks(64, blocks, budget))))
    dealt = values.select("fingerprint", F.explode(cases).alias("c")).select(F.col("c.t").alias("t"), F.col("c.k").alias("k"), "fingerprint")
    dealt = dealt.repartition("t", "k").sortWithinPartitions("t", "k")
    return dealt.mapInArrow(_bucket_links(budget, blocks), "a long, b long")


def near_components(prints: DataFrame, budget: int = 2) -> DataFrame:
    """(fingerprint, doc_id, root, component_id) of each distinct fingerprint.

    ``prints`` has doc_id and fingerprint. Copies are combined to one row per fingerprint first: doc_id is the smallest
    of the fingerprint, component_id that of its component, and root the component's smallest fingerprint. Null ids
    are passed over; where all ids are null, so is the smallest.
    """
    classes = materialize(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id")), label="fingerprints")
    roots = components(near_links(classes.select("fingerprint"), budget))
    rooted = classes.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "doc_id", F.coalesce("root", "fingerprint").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rooted.join(lowest, "root").select("fingerprint", "doc_id", "root", "component_id")


def near_duplicates(docs: DataFrame, budget: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hexadecimal digits), component_id (smallest doc_id reachable).

    Words are runs of anything but ASCII white space, A-Z in lower case; shingles are three words, repeats included; a
    text of fewer words is one shingle. Wordless and null texts have fingerprint 0 and are linked like any other.
    Repeated rows stay; an empty table gives no rows; other columns are not read.
    """
    prints = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    prints = materialize(with_fingerprint(prints).select("doc_id", "fingerprint"), label="simhash")
    named = F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint")
    return prints.join(near_components(prints, budget).drop("doc_id"), "fingerprint").select("doc_id", named, "component_id")


def keep_one(docs: DataFrame, budget: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component, one row with the smallest id stays.

    A null id counts as larger than any other. All columns are kept.
    """
    spare = [f"_{k}" for k in range(len(docs.columns) + 2) if f"_{k}" not in docs.columns]
    mark, key = spare[:2]
    marked = with_fingerprint(docs, text_col, mark)
    named = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.lit(" "), F.col(mark).cast("string"))
    prints = materialize(marked.select(F.col(id_col).alias("doc_id"), F.col(mark).alias("fingerprint")), label="simhash")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fingerprint")).alias("first")
    kept = near_components(prints, budget).groupBy("root").agg(first).select(
        F.col("first.doc_id").alias(id_col), F.col("first.fingerprint").alias(mark)).select(named.alias(key))
    # One key column for the join and for rows that repeat id and fingerprint, so that texts are shuffled once.
    return marked.withColumn(key, named).join(kept, key, "left_semi").dropDuplicates([key]).drop(mark, key)
