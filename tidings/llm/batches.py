"""Arrow batches of texts: slices of bounded size, and words as flat arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20


def bytes_and_offsets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array without nulls, and the n + 1 bounds of its texts in them."""
    _, bounds, data = texts.buffers()
    width = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    offsets = np.frombuffer(bounds, width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of a slice have at most ``limit`` bytes, or are one text. Null texts become empty."""
    for batch in batches:
        k = batch.schema.get_field_index(column)
        batch = batch.set_column(k, batch.schema.field(k), batch.column(k).fill_null(""))
        _, offsets = bytes_and_offsets(batch.column(k))
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The maximal runs of bytes other than space and U+0009 to U+000D, and the n + 1 bounds of the texts in them."""
    lists = pc.ascii_split_whitespace(texts)
    words = lists.flatten()
    bounds = np.asarray(lists.offsets).astype(np.int64)
    bounds -= bounds[0]
    full = np.asarray(pc.greater(pc.binary_length(words), 0))
    if not full.all():
        words = words.filter(pa.array(full))
        bounds = np.concatenate(([0], np.cumsum(full, dtype=np.int64)))[bounds]
    return words, bounds


def join_words(words: pa.Array, bounds: np.ndarray) -> pa.Array:
    """One text per range of words, joined by one space."""
    lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), words)
    return pc.binary_join(lists, " ")


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after the other."""
    total = int(lengths.sum())
    firsts = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - firsts, lengths)
