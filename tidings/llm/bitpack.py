"""Token ids in files of fixed-width bits.

A file holds ids of ``bits`` bits each, the fewest that hold every id of the vocabulary, in blocks of ``BLOCK`` ids.
After the blocks stand one entry per document (whether it has a doc_id, doc_id, number of ids) and the byte offset of
each block; a footer says where both begin. So any range of ids can be read alone, and a block is unpacked by numpy at
once. Layout, little-endian: magic, u8 bits, u32 ids per block; blocks, each filled up to a whole byte; documents as
three arrays u8, i64, u64; block offsets u64; footer (u64 documents, ids, blocks, start of the documents, start of the
offsets; u32 crc32 of all that); magic.

Tasks write a file under a name of their own, and the list of files is a table that Spark commits. So a task that is
lost or repeated leaves at most a file that no list names.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..storage import materialize, scratch_path
from .batches import SLICE_BYTES, slices, split_words
from .word_ids import KEPT_WORDS, Recent, WordIds

MAGIC = b"TIDBITS1"
BLOCK = 1 << 16
FILE_IDS = 1 << 26
HEAD = "<8sBI"
FOOT = "<5QI8s"


def width(vocabulary: int) -> int:
    """The bits that hold the ids 0 to ``vocabulary`` - 1."""
    return max(1, (max(vocabulary, 1) - 1).bit_length())


def _shares(bits: int) -> Iterator[tuple[int, int, int]]:
    """Of eight ids in ``bits`` bytes: (byte, id, right shift of the id that puts its share there)."""
    for j in range(bits):
        for k in range(8 * j // bits, (8 * j + 7) // bits + 1):
            yield j, k, (k + 1) * bits - 8 * (j + 1)


def _shift(x: np.ndarray, right: int) -> np.ndarray:
    return x >> np.uint64(right) if right >= 0 else x << np.uint64(-right)


def pack(ids: np.ndarray, bits: int) -> bytes:
    """``ids`` as consecutive numbers of ``bits`` bits, most significant first, filled up to a whole byte."""
    if len(ids) and (int(ids.max()) >> bits or int(ids.min()) < 0):
        raise ValueError(f"an id needs more than {bits} bits")
    eights = np.zeros((-(-len(ids) // 8), 8), np.uint64)
    eights.reshape(-1)[: len(ids)] = ids
    columns = np.ascontiguousarray(eights.T)
    out = np.zeros((len(eights), bits), np.uint8)
    for j, k, right in _shares(bits):
        out[:, j] |= _shift(columns[k], right).astype(np.uint8)
    return out.tobytes()[: -(-len(ids) * bits // 8)]


def unpack(data: bytes, bits: int, n: int) -> np.ndarray:
    """The first ``n`` ids of :func:`pack`."""
    raw = np.zeros((-(-n // 8), bits), np.uint8)
    size = -(-n * bits // 8)
    raw.reshape(-1)[:size] = np.frombuffer(data, np.uint8, size)
    columns = np.ascontiguousarray(raw.T).astype(np.uint64)
    out = np.zeros((len(raw), 8), np.uint64)
    for j, k, right in _shares(bits):
        out[:, k] |= _shift(columns[j], -right)
    return (out.reshape(-1)[:n] & np.uint64((1 << bits) - 1)).astype(np.uint32)


class Writer:
    """Write one file; :meth:`close` gives (documents, ids)."""

    def __init__(self, stream, bits: int):
        self.stream, self.bits, self.waiting, self.held = stream, bits, [], 0
        self.docs, self.n_docs, self.n_ids = [], 0, 0
        self.offsets, self.at = [], 0
        self._write(struct.pack(HEAD, MAGIC, bits, BLOCK))

    def _write(self, data: bytes) -> None:
        self.stream.write(data)
        self.at += len(data)

    def _blocks(self, least: int) -> None:
        """Write whole blocks, and the last short one if ``least`` is 1."""
        if self.held < least or not self.held:
            return
        ids = np.concatenate(self.waiting)
        stop = len(ids) if least == 1 else len(ids) // BLOCK * BLOCK
        for k in range(0, stop, BLOCK):
            self.offsets.append(self.at)
            self._write(pack(ids[k : min(k + BLOCK, stop)], self.bits))
        self.waiting, self.held = [ids[stop:]], len(ids) - stop

    def add(self, doc_ids: pa.Array, counts: np.ndarray, ids: np.ndarray) -> None:
        self.docs.append((np.asarray(doc_ids.is_valid()).astype(np.uint8), np.asarray(doc_ids.fill_null(0)).astype("<i8"), counts.astype("<u8")))
        self.waiting.append(ids)
        self.held += len(ids)
        self.n_docs += len(counts)
        self.n_ids += len(ids)
        self._blocks(BLOCK)

    def close(self) -> tuple[int, int]:
        self._blocks(1)
        docs_at = self.at
        for k in range(3):
            for part in self.docs:
                self._write(part[k].tobytes())
        offsets_at = self.at
        self._write(np.array(self.offsets, "<u8").tobytes())
        fields = struct.pack("<5Q", self.n_docs, self.n_ids, len(self.offsets), docs_at, offsets_at)
        self._write(fields + struct.pack("<I", zlib.crc32(fields)) + MAGIC)
        self.stream.close()
        return self.n_docs, self.n_ids


class Reader:
    """Read one file: its documents, and any range of its ids."""

    def __init__(self, stream):
        self.stream = stream
        size = stream.size()
        magic, self.bits, self.block = struct.unpack(HEAD, stream.read_at(struct.calcsize(HEAD), 0))
        foot = stream.read_at(struct.calcsize(FOOT), size - struct.calcsize(FOOT))
        self.n_docs, self.n_ids, n_blocks, docs_at, offsets_at, check, end = struct.unpack(FOOT, foot)
        if magic != MAGIC or end != MAGIC or check != zlib.crc32(foot[:40]):
            raise ValueError("not a whole file of packed ids")
        self.offsets = np.frombuffer(stream.read_at(8 * n_blocks, offsets_at), "<u8")
        raw = stream.read_at(17 * self.n_docs, docs_at)
        n = self.n_docs
        self.doc_ids = pa.array(np.frombuffer(raw, "<i8", n, n), mask=np.frombuffer(raw, np.uint8, n) == 0)
        self.counts = np.frombuffer(raw, "<u8", n, 9 * n).astype(np.int64)

    def ids(self, start: int, count: int) -> np.ndarray:
        """Ids ``start`` to ``start + count - 1``; only their blocks are read."""
        if not count:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (start + count - 1) // self.block
        n = min((last + 1) * self.block, self.n_ids) - first * self.block
        size = int(self.offsets[last] - self.offsets[first]) + -(-min(self.block, self.n_ids - last * self.block) * self.bits // 8)
        raw = self.stream.read_at(size, int(self.offsets[first]))  # whole blocks fill whole bytes, as BLOCK is a multiple of 8
        return unpack(raw, self.bits, n)[start - first * self.block :][:count]


#: How the word tokenizer prepares a text, and its letters whose lower case and composition are plain.
_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN = r"([A-Za-zÀ-ÖØ-Þß-öø-ÿ]+)([!\"#$%&()*+,\-./:;<=>?@\[\\\]^_`{}~|]*)"


def _byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if it prints, else the next from U+0100."""
    printing = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printing]
    return [chr(b) if b in printing else chr(0x100 + others.index(b)) for b in range(256)]


def _learner(tokenizer):
    """The ids of words by the tokenizer; a plain word goes to its merges by letters and marks, each once.

    That holds for one preparation of texts: a run of letters in lower case and a run of marks are what it splits such a
    word into. With any other, or with an added token in reach, the tokenizer sees the word as it is.
    """
    whole = lambda words: [e.ids for e in tokenizer.encode_batch(words, add_special_tokens=False)]
    made = json.loads(tokenizer.to_str())
    steps = (made["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    if made["normalizer"] != _NORMALIZER or [s.get("type") for s in steps] != ["Split", "ByteLevel"]:
        return whole
    if steps[0]["pattern"] != {"Regex": _SPLIT} or steps[0]["behavior"] != "Removed" or not steps[0]["invert"] or steps[1]["add_prefix_space"] or steps[1]["use_regex"]:
        return whole
    if any(not t["content"].startswith("<|") for t in made["added_tokens"]):
        return whole
    plain, letters, tokenize, parts = re.compile(_PLAIN).fullmatch, _byte_letters(), tokenizer.model.tokenize, Recent(KEPT_WORDS)

    def ids(part: str) -> list[int]:
        known = parts.get(part)
        if known is None:
            shown = part if part.isascii() else "".join([letters[b] for b in part.encode()])
            known = [t.id for t in tokenize(shown)]
            parts.put(part, known)
        return known

    def learn(words: list[str]) -> list[list[int]]:
        found = [plain(w) for w in words]
        rest = iter(whole([w for w, m in zip(words, found) if m is None or "<|" in w]))
        return [next(rest) if m is None or "<|" in w else ids(m[1].lower()) + ids(m[2]) if m[2] else ids(m[1].lower()) for w, m in zip(words, found)]

    return learn


@lru_cache(maxsize=1)
def _encoder(path: str):
    """(ids, numbers of ids) of texts by a tokenizers file, which sees each distinct white-space word; and its vocabulary.

    The next task in the same process finds the words that this one has learned. The file must not join words across ASCII white space.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    import tokenizers

    tokenizer = tokenizers.Tokenizer.from_file(path)
    lookup = WordIds(_learner(tokenizer))

    def encode(texts: pa.Array, end: int | None) -> tuple[np.ndarray, np.ndarray]:
        ids, bounds = lookup(*split_words(texts))
        if end is not None:
            ids = np.insert(ids, bounds[1:], end)
        return ids, np.diff(bounds) + (end is not None)

    return encode, tokenizer.get_vocab_size(with_added_tokens=True)


def write_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the ids of whole texts below ``folder`` in ascending order of id; returns the list of files.

    The list has part, nth, path, n_docs, n_ids, and ``start``: the ids in the files before. Null ids come first, null
    texts are empty, rows that repeat an id are ordered by text. An empty table gives no files. Other columns are not
    read. ``folder`` is a URI that pyarrow can write, ``tokenizer`` a tokenizers file on every executor.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        encode, vocabulary = _encoder(tokenizer)
        bits, part = width(vocabulary), TaskContext.get().partitionId()
        writer, path, done = None, "", []
        for batch in slices(batches, "text", 2 * SLICE_BYTES):
            if writer is None:
                path = f"{base}/{part:06d}-{len(done):04d}-{uuid.uuid4().hex}.ids"
                writer = Writer(store.open_output_stream(path, compression=None), bits)
            ids, counts = encode(batch.column(1), end_id)
            writer.add(batch.column(0), counts, ids)
            if writer.n_ids >= FILE_IDS:
                done.append((part, len(done), path, *writer.close()))
                writer = None
        if writer is not None:
            done.append((part, len(done), path, *writer.close()))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], ["part", "nth", "path", "n_docs", "n_ids"])

    ordered = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    files = materialize(ordered.mapInArrow(each, "part long, nth long, path string, n_docs long, n_ids long"), label="id-files")
    before = Window.orderBy("part", "nth").rowsBetween(Window.unboundedPreceding, 0)  # one row per file
    return files.withColumn("start", F.sum("n_ids").over(before) - F.col("n_ids"))


def read_documents(files: DataFrame, folder: str) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, and the crc32 of its ids as unsigned 32-bit numbers."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with store.open_input_file(path) as stream:
                    yield from _documents(Reader(stream), start)

    spread = files.select("path", "start").repartition(max(1, files.count()), "path")
    return spread.mapInArrow(each, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _documents(file: Reader, start: int, step: int = 32 * BLOCK) -> Iterator[pa.RecordBatch]:
    ends = np.cumsum(file.counts)
    doc, check, out = 0, 0, np.zeros(file.n_docs, np.int64)
    for k in range(0, file.n_ids, step):
        n = min(step, file.n_ids - k)
        raw = memoryview(file.ids(k, n).astype("<u4").tobytes())
        at = k
        while doc < file.n_docs and at <= k + n:
            stop = min(int(ends[doc]), k + n)
            check = zlib.crc32(raw[4 * (at - k) : 4 * (stop - k)], check)
            at = stop
            if stop < ends[doc]:
                break
            out[doc], check, doc = check, 0, doc + 1
    yield pa.RecordBatch.from_arrays(
        [file.doc_ids, pa.array(ends - file.counts + start), pa.array(file.counts), pa.array(out)],
        ["doc_id", "start", "n_tokens", "ids_crc32"])


def round_trip(docs: DataFrame, tokenizer: str, end_id: int | None, folder: str | None = None) -> DataFrame:
    """Write ``docs`` and read the files back, one row per document."""
    folder = folder or scratch_path(docs.sparkSession, "ids")
    uri = folder if "://" in folder else f"file://{folder}"
    return read_documents(write_files(docs, uri, tokenizer, end_id), uri)
