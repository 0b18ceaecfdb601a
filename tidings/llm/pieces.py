"""SentencePiece ids by weighted finite-state transduction, and text from ids.

The model is compiled to three transducers. The normaliser puts a mark for each space and one before the text. The
pieces map strings to ids, each at the negative of its score; a character that no piece has maps to the ids of its
bytes. The merge rules of a byte-pair model are an acceptor over neighbouring pieces: a pair costs nothing if the
model, given both strings together, would leave them as they are, and infinity otherwise.

Composed with an input they give a lattice over its characters, and the ids are the labels of the path of least weight
in the tropical semiring (weights add along a path, the least wins). A sequence of pieces is what the merges make of its
string exactly if they make each neighbouring pair of it; so one path to each position has finite weight, and one state
per position is enough.

No piece goes on past a mark, apart from pieces of marks alone, which merge after all others. So the lattice falls into
words, whose paths are found once per distinct word, and runs of single marks, which are joined at the end.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .batches import ranges, slices
from .word_ids import Recent, WordIds

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
#: Parts of words and pairs of pieces whose results a process keeps.
KEPT_PARTS, KEPT_PAIRS = 400_000, 400_000


class Transducer:
    """A byte-pair SentencePiece model with byte fallback and without a character map."""

    def __init__(self, path: str, kept_parts: int = KEPT_PARTS):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules, spec = model.normalizer_spec, model.trainer_spec
        if spec.model_type != spec.BPE or not spec.byte_fallback or spec.treat_whitespace_as_suffix:
            raise ValueError("only byte-pair models with byte fallback and leading marks are supported")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not (rules.escape_whitespaces and rules.add_dummy_prefix):
            raise ValueError("only the identity normaliser with a mark before the text is supported")
        if {p.type for p in model.pieces} - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("unused and user-defined pieces are not supported")
        self.ids = {p.piece: k for k, p in enumerate(model.pieces) if p.type == NORMAL}
        self.weight = {p.piece: -p.score for p in model.pieces if p.type == NORMAL}
        self.bytes = [0] * 256
        self.surface = []
        for k, p in enumerate(model.pieces):
            if p.type == BYTE:
                self.bytes[int(p.piece[3:5], 16)] = k
            self.surface.append(bytes([int(p.piece[3:5], 16)]) if p.type == BYTE else p.piece.replace(MARK, " ").encode() if p.type == NORMAL
                                else spec.unk_surface.encode() if p.type == UNKNOWN else b"")
        marks = [p for p in self.ids if set(p) == {MARK}]
        letters = [p for p in self.ids if set(p) != {MARK}]
        least = max(self.weight[p] for p in letters)
        if any(MARK in p[1:] for p in letters) or any(len(p) > 1 and self.weight[p] <= least for p in marks) or MARK not in self.ids:
            raise ValueError("marks must stand at the start of pieces, or merge after all other pieces")
        if any(c not in self.ids for p in self.ids for c in p):
            raise ValueError("each character of a piece must be a piece")
        self.arcs = ahocorasick.Automaton()
        for p, k in self.ids.items():
            self.arcs.add_word(p, k)
        self.arcs.make_automaton()
        self.inside = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        self.names = [p.piece for p in model.pieces]
        self.sizes = [len(p) for p in self.names]
        self._parts, self._apart = Recent(kept_parts), Recent(KEPT_PAIRS)
        self._whole: dict[int, bool] = {}

    def merged(self, symbols: list[str]) -> list[str]:
        """What the merges make of the symbols: the neighbours of least weight first, of equal ones the leftmost."""
        symbols, weight = list(symbols), self.weight
        if len(symbols) > 32:
            return self._merged_long(symbols)
        costs = [weight.get(a + b, math.inf) for a, b in zip(symbols, symbols[1:])]
        while costs and (least := min(costs)) < math.inf:
            k = costs.index(least)
            symbols[k : k + 2] = [symbols[k] + symbols[k + 1]]
            del costs[k]
            if k < len(costs):
                costs[k] = weight.get(symbols[k] + symbols[k + 1], math.inf)
            if k:
                costs[k - 1] = weight.get(symbols[k - 1] + symbols[k], math.inf)
        return symbols

    def _merged_long(self, symbols: list[str]) -> list[str]:
        weight = self.weight
        after = list(range(1, len(symbols) + 1))
        before = list(range(-1, len(symbols) - 1))
        heap = [(weight[a + b], k, a, b) for k, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in weight]
        heapq.heapify(heap)
        while heap:
            _, k, a, b = heapq.heappop(heap)
            j = after[k]
            if symbols[k] != a or j >= len(symbols) or symbols[j] != b:
                continue
            symbols[k], symbols[j] = a + b, ""
            after[k] = after[j]
            if after[k] < len(symbols):
                before[after[k]] = k
                both = a + b + symbols[after[k]]
                if both in weight:
                    heapq.heappush(heap, (weight[both], k, a + b, symbols[after[k]]))
            if before[k] >= 0:
                both = symbols[before[k]] + a + b
                if both in weight:
                    heapq.heappush(heap, (weight[both], before[k], symbols[before[k]], a + b))
        return [s for s in symbols if s]

    def apart(self, a: int, b: int) -> bool:
        """True if the merges leave the pieces ``a`` and ``b`` as two."""
        left, right = self.names[a], self.names[b]
        found = self.merged(list(left + right)) == [left, right]
        self._apart.put(a << 20 | b, found)
        return found

    def whole(self, a: int) -> bool:
        """True if the merges make one piece of the letters of ``a``."""
        known = self._whole.get(a)
        if known is None:
            known = self._whole[a] = self.merged(list(self.names[a])) == [self.names[a]]
        return known

    def path(self, word: str) -> list[int]:
        """Ids of the path of least weight through the lattice of a word; its marks, if any, stand before the rest."""
        n, sizes, kept = len(word), self.sizes, self._apart
        last = [-1] * (n + 1)  # the piece that ends here, or -1 for the start and for bytes
        start = list(range(-1, n))
        done = bytearray(n + 1)
        for end, piece in self.arcs.iter(word):  # by their ends; of one end, the longest first
            j = end + 1
            if done[j]:
                continue
            i = j - sizes[piece]
            left = last[i]
            if left < 0:
                finite = self.whole(piece)
            elif (finite := kept.young.get(left << 20 | piece)) is None and (finite := kept.get(left << 20 | piece)) is None:
                finite = self.apart(left, piece)
            if finite:
                last[j], start[j], done[j] = piece, i, 1  # the only finite weight
        out: list[int] = []
        j = n
        while j:
            i = start[j]
            out.extend([last[j]] if last[j] >= 0 else [self.bytes[b] for b in reversed(word[i:j].encode())])
            j = i
        return out[::-1]

    def word(self, word: str) -> list[int]:
        """Ids of a word: no arc crosses two neighbouring characters that stand together in no piece, so it is cut there."""
        cuts = [0, *(k for k in range(1, len(word)) if word[k - 1 : k + 1] not in self.inside), len(word)]
        out: list[int] = []
        for a, b in zip(cuts, cuts[1:]):
            part = word[a:b]
            known = self._parts.get(part)
            if known is None:
                known = self.path(part)
                self._parts.put(part, known)
            out += known
        return out


class Encoder:
    """Ids of batches of texts."""

    def __init__(self, fst: Transducer, kept_words: int | None = None):
        self.fst = fst
        self.lone = fst.ids[MARK]
        self.lookup = WordIds(lambda words: [fst.word(w if w[:1] == "\n" else MARK + w) for w in words], kept_words)
        self.runs: dict[int, list[int]] = {}
        self.break_at = not any("\n" in p for p in fst.ids)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and the n + 1 bounds of the texts."""
        plain = pc.replace_substring(texts, MARK, " ")
        if self.break_at:  # a line end is bytes, which no piece crosses: a word may start there, without a mark
            plain = pc.replace_substring(plain, "\n", " \n")
        lists = pc.split_pattern(plain, " ")
        bounds = np.asarray(lists.offsets).astype(np.int64)
        ids, ends = self.lookup(lists.flatten(), bounds - bounds[0])
        empty = np.asarray(pc.equal(pc.binary_length(texts), 0))
        if empty.any():  # no text, no mark
            counts = np.diff(ends)
            ids = ids[np.repeat(~empty, counts)]
            ends = np.concatenate(([0], np.cumsum(np.where(empty, 0, counts))))
        return self._joined(ids, ends)

    def _joined(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Join runs of two and more single marks."""
        lone = ids == self.lone
        first = np.zeros(len(ids) + 1, bool)
        first[ends] = True
        again = np.zeros(len(ids), bool)
        again[1:] = lone[1:] & lone[:-1] & ~first[1:-1]
        if not again.any():
            return ids, ends
        edges = np.diff(np.concatenate(([0], again.astype(np.int8), [0])))
        starts, stops = np.flatnonzero(edges == 1) - 1, np.flatnonzero(edges == -1)
        parts, at, change = [], 0, np.zeros(len(ids) + 1, np.int64)
        for a, b in zip(starts.tolist(), stops.tolist()):
            if b - a not in self.runs:
                self.runs[b - a] = [self.fst.ids[p] for p in self.fst.merged([MARK] * (b - a))]
            parts += [ids[at:a], np.array(self.runs[b - a], ids.dtype)]
            change[b] += len(self.runs[b - a]) - (b - a)
            at = b
        return np.concatenate([*parts, ids[at:]]), ends + np.cumsum(change)[ends]


class Decoder:
    """Text from ids."""

    def __init__(self, fst: Transducer):
        self.flat = np.frombuffer(b"".join(fst.surface), np.uint8)
        self.lengths = np.array([len(s) for s in fst.surface])
        self.starts = np.cumsum(self.lengths) - self.lengths

    def __call__(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """One text per range of ids, without the first mark; bytes that are no UTF-8 become U+FFFD."""
        raw = self.flat[ranges(self.starts[ids], self.lengths[ids])].tobytes()
        bounds = np.concatenate(([0], np.cumsum(self.lengths[ids])))[ends].tolist()
        return [raw[a + (raw[a : a + 1] == b" ") : b].decode("utf-8", "replace") if b > a else "" for a, b in zip(bounds, bounds[1:])]


@lru_cache(maxsize=1)
def _encoder(model: str, kept_words: int | None = None) -> Encoder:
    """The encoder of a process, which the next task in it finds with the words it has learned."""
    return Encoder(Transducer(model, KEPT_PARTS if kept_words is None else kept_words // 2), kept_words)


def _rows(docs: DataFrame, column: str) -> DataFrame:
    return docs.select(F.col(column).alias("x"), F.struct(*(c for c in docs.columns if c != column)).alias("row")) if len(docs.columns) > 1 else docs.select(F.col(column).alias("x"), F.struct(F.lit(0)).alias("row"))


def _back(done: DataFrame, docs: DataFrame, column: str, name: str) -> DataFrame:
    columns = [F.col("x").alias(c) if c == column else F.col("row")[c].alias(c) for c in docs.columns]
    return done.select(*columns, F.col("y").alias(name))


def encode(docs: DataFrame, model: str, text_col: str = "text", name: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole text, an array of ints in the column ``name``.

    A null or empty text has no ids. Rows stay as they are, repeated ones too; a column called ``name`` is an error.
    ``model`` is a file on every executor. No ids for the start or end of a text are added.
    """
    if name in docs.columns:
        raise ValueError(f"the table already has a column {name}")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model)
        for whole in batches:
            at = 0
            for batch in slices(iter([whole]), "x"):
                ids, ends = encoder(batch.column(0))
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))
                same = whole.slice(at, batch.num_rows)
                at += batch.num_rows
                yield pa.RecordBatch.from_arrays([*same.columns, lists], schema=pa.schema([*whole.schema, ("y", lists.type)]))

    rows = _rows(docs, text_col)
    return _back(rows.mapInArrow(each, StructType([*rows.schema.fields, StructField("y", ArrayType(IntegerType()))])), docs, text_col, name)


def decode(docs: DataFrame, model: str, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """``docs`` with the text of each array of ids in the column ``name``; null ids give an empty text."""
    if name in docs.columns:
        raise ValueError(f"the table already has a column {name}")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(_encoder(model).fst)
        for batch in batches:
            lists = batch.column(0)
            lengths = np.asarray(pc.list_value_length(lists).fill_null(0)).astype(np.int64)
            texts = decoder(np.asarray(lists.flatten()).astype(np.int64), np.concatenate(([0], np.cumsum(lengths))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], schema=pa.schema([*batch.schema, ("y", pa.string())]))

    rows = _rows(docs, ids_col)
    return _back(rows.mapInArrow(each, StructType([*rows.schema.fields, StructField("y", StringType())])), docs, ids_col, name)


def report(docs: DataFrame, model: str, kept_words: int | None = None) -> DataFrame:
    """One row per document: doc_id, n_ids, ids_crc32 (of little-endian unsigned 32-bit numbers), decoded_sha256, and
    whether decoding gave the text back.

    A process keeps the ids of ``kept_words`` words, and parts of words of half that number (``KEPT_WORDS`` unless given).
    Marks (U+2581) in a text are spaces to the model and come back as such. Encoding and decoding are one pass, so that a
    task has one Python process and ids needn't leave it.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model, kept_words)
        decoder = Decoder(encoder.fst)
        for batch in slices(batches, "text"):
            ids, ends = encoder(batch.column(1))
            raw, bounds = ids.astype("<u4").tobytes(), (4 * ends).tolist()
            texts = decoder(ids.astype(np.int64), ends)
            plain = pc.replace_substring(batch.column(1), MARK, " ").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(ends)), pa.array([zlib.crc32(raw[a:b]) for a, b in zip(bounds, bounds[1:])], pa.int64()),
                 pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string()), pa.array([t == p for t, p in zip(texts, plain)], pa.bool_())],
                ["doc_id", "n_ids", "ids_crc32", "decoded_sha256", "same_text"])

    out = "n_ids long, ids_crc32 long, decoded_sha256 string, same_text boolean"
    rows = docs.select("doc_id", "text")
    return rows.mapInArrow(each, StructType([rows.schema["doc_id"], *StructType.fromDDL(out).fields]))
