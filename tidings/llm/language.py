"""Language of a text by a convolutional network over its bytes.

A text is cut into windows of ``LENGTH`` bytes, all of them. Filters of several widths slide over a window's bytes, each
filter's greatest response is kept, and a softmax over those gives the window's languages. A text's scores are the
means over its windows, weighted by their letters.

The network is trained in numpy on windows of a bounded sample of labelled texts (``SAMPLE_TEXTS`` distinct texts,
spread evenly over the languages, ``TEXT_WINDOWS`` windows of each).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .batches import bytes_and_offsets, ranges, slices

LENGTH = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
SAMPLE_TEXTS = 2000
TEXT_WINDOWS = 4
UNKNOWN = "und"

_LETTER = np.zeros(256, np.float32)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = 1


@dataclass
class Network:
    """Filters by width (width x 256 x filters), their biases, and the softmax layer of ``languages``."""

    languages: list[str]
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    weights: np.ndarray
    offsets: np.ndarray

    def responses(self, windows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each width the greatest response of each filter and where it is."""
        out = []
        for table, bias in zip(self.filters, self.biases):
            places = windows.shape[1] - len(table) + 1
            total = sum(table[j][windows[:, j : j + places]] for j in range(len(table)))
            at = total.argmax(axis=1)
            out.append((np.take_along_axis(total, at[:, None], 1)[:, 0] + bias, at))
        return out


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], epochs: int = 12, batch: int = 64, rate: float = 0.01, seed: int = 0) -> Network:
    """Fit a network to byte windows (n x LENGTH) and the numbers of their languages, by Adam on the cross entropy."""
    rng = np.random.default_rng(seed)
    features = len(WIDTHS) * FILTERS
    net = Network(
        list(languages), [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS], [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        rng.normal(0, 0.1, (features, len(languages))).astype(np.float32), np.zeros(len(languages), np.float32))
    values = [*net.filters, *net.biases, net.weights, net.offsets]
    first, second, step = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values], 0
    for _ in range(epochs):
        order = rng.permutation(len(windows))
        for k in range(0, len(order), batch):
            x, y = windows[order[k : k + batch]], labels[order[k : k + batch]]
            found = net.responses(x)
            pooled = np.concatenate([r for r, _ in found], axis=1)
            active = np.maximum(pooled, 0)
            wrong = _softmax(active @ net.weights + net.offsets)
            wrong[np.arange(len(y)), y] -= 1
            wrong /= len(y)
            back = (wrong @ net.weights.T) * (pooled > 0)
            grads = []
            for i, (w, (_, at)) in enumerate(zip(WIDTHS, found)):
                mine = back[:, i * FILTERS : (i + 1) * FILTERS]
                grad = np.zeros_like(net.filters[i])
                for j in range(w):  # only the greatest response of a filter learns
                    np.add.at(grad[j], (x[np.arange(len(y))[:, None], at + j], np.arange(FILTERS)[None]), mine)
                grads.append(grad)
            grads += [back[:, i * FILTERS : (i + 1) * FILTERS].sum(axis=0) for i in range(len(WIDTHS))]
            grads += [active.T @ wrong, wrong.sum(axis=0)]
            step += 1
            for v, g, m, s in zip(values, grads, first, second):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return net


class Predictor:
    """The same responses as :meth:`Network.responses`, with two bytes looked up at a time."""

    def __init__(self, net: Network):
        self.net = net
        two = lambda table, j: (table[j][:, None] + table[j + 1][None, :]).reshape(65536, -1)
        self.heads = np.concatenate([two(t, 0) for t in net.filters], axis=1)
        self.third, self.last = net.filters[1][2], two(net.filters[2], 2)

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        wide = windows.astype(np.int32)
        pairs = (wide[:, :-1] << 8) | wide[:, 1:]
        out = []
        for k in range(0, len(windows), 32):  # few at a time, so that responses stay in the cache
            head = self.heads[pairs[k : k + 32]]
            a, b = FILTERS, 2 * FILTERS
            three = head[:, :-1, a:b] + self.third[windows[k : k + 32, 2:]]
            four = head[:, :-2, b:] + self.last[pairs[k : k + 32, 2:]]
            out.append(np.concatenate([head[:, :, :a].max(axis=1), three.max(axis=1), four.max(axis=1)], axis=1))
        pooled = np.concatenate(out) + np.concatenate(self.net.biases)
        return _softmax(np.maximum(pooled, 0) @ self.net.weights + self.net.offsets)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The number of each text's language and its score, from all of the text's windows."""
        raw, offsets = bytes_and_offsets(texts)
        sizes = np.diff(offsets)
        counts = -(-sizes // LENGTH)
        firsts = np.cumsum(counts) - counts
        padded = np.zeros((int(counts.sum()), LENGTH), np.uint8)
        padded.reshape(-1)[ranges(firsts * LENGTH, sizes)] = raw
        score = np.zeros((len(texts), len(self.net.languages)))
        if len(padded):
            weight = _LETTER[padded].sum(axis=1, dtype=np.float64)
            owner = np.repeat(np.arange(len(texts)), counts)
            shares = self.probabilities(padded) * weight[:, None]
            for k in range(score.shape[1]):
                score[:, k] = np.bincount(owner, shares[:, k], len(texts))
            score /= np.maximum(np.bincount(owner, weight, len(texts)), 1e-9)[:, None]
        best = score.argmax(axis=1)
        return best, score[np.arange(len(texts)), best]


def held_out(id_col: str = "doc_id") -> Column:
    """True for documents whose labels are kept for testing: the checksum of the id modulo three is one."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, n_texts: int = SAMPLE_TEXTS, n_windows: int = TEXT_WINDOWS, text_col: str = "text", label_col: str = "lang") -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Windows of at most ``n_texts`` distinct labelled texts, in the order of a hash of the text, by turns of the labels.

    Copies count once. The sample is chosen from hashes alone; only the windows of the chosen texts leave the tasks.
    """
    labelled = docs.where(F.col(text_col).isNotNull() & F.col(label_col).isNotNull()).select(
        F.col(label_col).cast("string").alias("label"), F.xxhash64(text_col).alias("h"), F.col(text_col).cast("binary").alias("b"))
    turn = F.row_number().over(Window.partitionBy("label").orderBy("h"))
    texts = labelled.where(F.octet_length("b") > 0).select("label", "h").distinct()
    chosen = texts.withColumn("turn", turn).where(F.col("turn") <= n_texts).orderBy("turn", "label").limit(n_texts).select("label", "h")
    # At most n_texts rows of two short columns.
    mine = labelled.join(F.broadcast(chosen), ["label", "h"])
    cut = F.array(*(F.expr(f"substring(b, cast(1 + pmod(xxhash64(h, {k}), greatest(octet_length(b) - {LENGTH} + 1, 1)) as int), {LENGTH})") for k in range(n_windows)))
    rows = mine.groupBy("label", "h").agg(F.min(cut).alias("windows")).orderBy("label", "h").collect()
    languages = sorted({r["label"] for r in rows})
    cuts = [(languages.index(r["label"]), bytes(w)) for r in rows for w in r["windows"]]
    windows = np.frombuffer(b"".join(w.ljust(LENGTH, b"\0") for _, w in cuts), np.uint8).reshape(-1, LENGTH)
    return windows, np.array([y for y, _ in cuts], np.int64), languages


def fit(docs: DataFrame, text_col: str = "text", label_col: str = "lang", n_texts: int = SAMPLE_TEXTS) -> Network | None:
    """A network for the labels of ``docs``; None if no text has a label."""
    windows, labels, languages = sample(docs, n_texts, text_col=text_col, label_col=label_col)
    return train(windows, labels, languages) if languages else None


def with_language(docs: DataFrame, net: Network | None, names: tuple[str, str] = ("lang_pred", "score"), text_col: str = "text") -> DataFrame:
    """``docs`` with the language of each whole text and its score from 0 to 1.

    A text that is null or has no letter is ``und`` with score 0, and so is every text if nothing could be learned.
    Equal scores go to the language that sorts first. Rows stay as they are, repeated ones too. A column of ``docs``
    named like one of ``names`` is an error.
    """
    if clash := set(names) & set(docs.columns):
        raise ValueError(f"the table already has columns {sorted(clash)}")
    if net is None:
        return docs.withColumns({names[0]: F.lit(UNKNOWN), names[1]: F.lit(0.0)})
    lettered = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col(text_col).alias("text"), lettered.alias("lettered"), F.struct(*(c for c in docs.columns if c != text_col)).alias("row"))
    parts = (net.languages, net.filters, net.biases, net.weights, net.offsets)
    shared = docs.sparkSession.sparkContext.broadcast(parts)  # a few hundred kilobytes

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = Predictor(Network(*shared.value))
        languages = np.array([*shared.value[0], UNKNOWN], object)
        for batch in batches:
            found = [predict(s.column(0)) for s in slices(iter([batch]), "text")]
            lettered = np.asarray(batch.column(1)).astype(bool) if batch.num_rows else np.zeros(0, bool)
            best = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64)
            score = np.concatenate([f[1] for f in found]) if found else np.zeros(0)
            named = pa.array(languages[np.where(lettered, best, -1)].tolist(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, named, pa.array(np.where(lettered, np.minimum(score, 1), 0.0))],
                schema=pa.schema([*batch.schema, ("lang", pa.string()), ("score", pa.float64())]))

    out = StructType([*rows.schema.fields, StructField("lang", StringType()), StructField("score", DoubleType())])
    done = rows.mapInArrow(each, out)
    columns = [F.col("text").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns]
    return done.select(*columns, F.col("lang").alias(names[0]), F.col("score").alias(names[1]))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score; trained on the documents that are not held out."""
    net = fit(docs.where(F.col("doc_id").isNotNull() & ~held_out()).select("text", "lang"))
    return with_language(docs.select("doc_id", "text", held_out().alias("held_out")), net).drop("text").select("doc_id", "held_out", "lang_pred", "score")
