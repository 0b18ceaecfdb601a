"""Vector expressions, and the offline encoder used when no model is supplied."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

BIGRAM_DIM = 256
BIGRAM_ENCODER_ID = "char-bigram-256"
# Characters that the encoder looks at together, unless one text has more.
_CHARACTERS = 1 << 18


def dot(a: Column, b: Column) -> Column:
    pairs = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays in double precision; 0 when either is a zero vector."""
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm).otherwise(F.lit(0.0))


def relevance(cos: Column) -> Column:
    """Relevance of unit vectors from squared L2 distance: 1 - d / sqrt(2), d = 2 - 2 cos."""
    return F.lit(1.0) - F.lit(math.sqrt(2.0)) * (F.lit(1.0) - cos)


def cosine_for_relevance(score: float) -> float:
    """The cosine at which ``relevance`` reaches ``score``."""
    return 1.0 - (1.0 - score) / math.sqrt(2.0)


def bigram_encoder(texts: list[str], dim: int = BIGRAM_DIM) -> np.ndarray:
    """Unit-length counts of character pairs, hashed to ``dim`` buckets.

    Stands in for a real model in tests and offline runs. A blank is put before and after each text,
    and the pair (a, b) goes to bucket ``(31 * a + b) mod dim`` of the two code points.
    """
    if not texts:
        return np.zeros((0, dim), dtype=np.float32)
    if len(texts) > 1 and sum(map(len, texts)) > _CHARACTERS:
        half = len(texts) // 2
        return np.concatenate((bigram_encoder(texts[:half], dim), bigram_encoder(texts[half:], dim)))
    codes = np.frombuffer("".join(f" {t} " for t in texts).encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.int64)
    ends = np.cumsum([len(t) + 2 for t in texts])
    row = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))
    pair = np.ones(len(codes) - 1, dtype=bool)
    pair[ends[:-1] - 1] = False  # no pair reaches into the next text
    buckets = (row[:-1] * dim + (31 * codes[:-1] + codes[1:]) % dim)[pair]
    counts = np.bincount(buckets, minlength=len(texts) * dim).reshape(len(texts), dim).astype(np.float64)
    norms = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
    return (counts / norms).astype(np.float32)
