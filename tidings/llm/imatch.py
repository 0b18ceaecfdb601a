"""Document fingerprints by I-Match, in DataFrame expressions only.

Terms are runs of letters and digits in lower case, named by their 64-bit hash. The lexicon holds the terms whose inverse
document frequency, ln(documents / documents with the term), lies in a band; document frequencies are counted over all
distinct texts, so that copies don't push their own terms out. A term of the lexicon is in at least the share exp(-idf_max)
of them, so the lexicon has at most exp(idf_max) times the mean number of distinct terms of a text, however large the corpus
is; it is sent to all tasks.

A fingerprint has one signature for the whole lexicon and one for each of 24 random subsets, which keep from an eighth to
one in 256 of its terms: the hash of the text's distinct terms there, in order. The likeness of two fingerprints is the
share of equal signatures among those that aren't empty in both.

Terms of near copies that are many, or of a language with few texts, lie outside the band. A text with few of its terms in
the lexicon is signed by all its terms instead, and so is, for their likeness, whatever it is compared with. A text without
terms has the hash of its whole text as fingerprint, and is like only what has the same.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

IDF_MIN, IDF_MAX = 2.3, 5.3
#: A subset of scale b keeps the terms whose seeded hash starts with b zero bits, so it is half of that of scale b - 1.
SEEDS, SCALES = (1, 2, 3, 4), range(3, 9)
#: The share of a text's distinct terms that must be in the lexicon.
ENOUGH = 0.25


def _terms(text: Column) -> Column:
    words = F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")
    return F.transform(words, lambda w: F.xxhash64(w))


def distinct_texts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Each text once; a task sends one row for all its copies of a text."""
    return docs.groupBy(F.xxhash64(text_col).alias("h")).agg(F.first(text_col).alias(text_col)).select(text_col)


def lexicon(docs: DataFrame, text_col: str = "text", idf_min: float = IDF_MIN, idf_max: float = IDF_MAX) -> list[int]:
    """The hashes of the terms in the band, ascending; terms of a single text are left out."""
    n = docs.count()
    counts = docs.select(F.explode(F.array_distinct(_terms(F.col(text_col)))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    least, most = max(2, math.ceil(n * math.exp(-idf_max))), n * math.exp(-idf_min)
    return sorted(r["term"] for r in counts.where((F.col("df") >= least) & (F.col("df") <= most)).select("term").toLocalIterator())


def _constant(numbers: list[int]) -> Column:
    """A constant array of longs, as one literal in the plan."""
    return F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<bigint>") if numbers else F.lit(None).cast("array<bigint>")


def _floor_position(numbers: list[int], x: Column) -> Column:
    """The position of the last of the ascending numbers that is at most ``x``, or -1, by halving."""
    if not numbers:
        return F.lit(-1)
    table = _constant(numbers)
    steps = F.array(*(F.lit(1 << k) for k in reversed(range(len(numbers).bit_length()))))
    return F.aggregate(steps, F.lit(-1), lambda at, step: F.when(F.get(table, at + step) <= x, at + step).otherwise(at))


def _signed(rows: DataFrame, held: str, name: str) -> DataFrame:
    """``rows`` with the signatures of the ascending terms ``held``, 32 bits each and 0 for no term; null for null."""
    subset = lambda scale, seed: f"{name}_{scale}_{seed}" if scale else held
    out = rows
    for scale in SCALES:
        larger = (lambda seed: subset(scale - 1, seed)) if scale > SCALES[0] else (lambda seed: held)
        zero = lambda seed: lambda c: F.shiftrightunsigned(F.xxhash64(c, F.lit(seed)), 64 - scale) == 0
        out = out.withColumns({subset(scale, seed): F.filter(larger(seed), zero(seed)) for seed in SEEDS})
    names = [held, *(subset(scale, seed) for scale in SCALES for seed in SEEDS)]
    signs = [F.when(F.size(c) == 0, F.lit(0).cast("long")).otherwise(F.xxhash64(c).bitwiseAND(F.lit((1 << 32) - 1)).bitwiseOR(F.lit(1).cast("long"))) for c in names]
    return out.withColumn(name, F.when(F.col(held).isNotNull(), F.array(*signs))).drop(*names)


def with_signatures(rows: DataFrame, text_col: str, terms: list[int], name: str) -> DataFrame:
    """``rows`` with the text's signatures in the lexicon, or null if it has less than ``ENOUGH`` of its terms there.

    Columns of ``rows`` may not start with ``name``.
    """
    every, held = f"{name}_all", f"{name}_held"
    out = rows.withColumn(every, F.array_distinct(_terms(F.col(text_col))))
    out = out.withColumn(held, F.array_sort(F.coalesce(F.array_intersect(every, _constant(terms)), F.array().cast("array<bigint>"))))
    enough = (F.size(held) > 0) & (F.size(held) >= ENOUGH * F.size(every))
    return _signed(out.withColumn(held, F.when(enough, F.col(held))).drop(every), held, name)


def with_all_signatures(rows: DataFrame, text_col: str, wanted: Column, name: str) -> DataFrame:
    """``rows`` with the signatures of all terms of the text; null where they aren't ``wanted`` or the text has no terms."""
    held = f"{name}_held"
    out = rows.withColumn(held, F.when(wanted, F.array_sort(F.array_distinct(_terms(F.col(text_col))))))
    return _signed(out.withColumn(held, F.when(F.size(held) > 0, F.col(held))), held, name)


def fingerprint(signs: Column, text: Column) -> Column:
    """Signatures, or the hash of a text without any, as hexadecimal digits."""
    whole = F.lpad(F.lower(F.hex(F.xxhash64(text))), 16, "0")
    parts = F.transform(signs, lambda s: F.lpad(F.lower(F.hex(s)), 8, "0"))
    return F.when(signs.isNull(), whole).otherwise(F.array_join(parts, ""))


def likeness(a: Column, b: Column, same: Column) -> Column:
    """Share of equal signatures; where either has none, whether the fingerprints are the ``same``."""
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: (x == y) & (x != 0)), lambda z: z))
    full = F.size(F.filter(F.zip_with(a, b, lambda x, y: (x != 0) | (y != 0)), lambda z: z))
    return F.when(a.isNull() | b.isNull(), same.cast("double")).otherwise(equal / full)


def with_next(rows: DataFrame, parts: int) -> DataFrame:
    """``rows`` (k long not null, text, signs) with ``next_text`` and ``next_signs`` of the row that follows by k; the first
    follows the last.

    Rows are cut at values of k into buckets of about equal size, and the first row of a bucket is also put at the end of
    the one before. So each row finds its successor in its own bucket, and texts are shuffled once.
    """
    points = [i / parts for i in range(1, parts)]
    found = rows.agg(F.min("k").alias("least"), F.percentile_approx("k", points, 10000).alias("cuts") if points else F.array().alias("cuts")).first()
    if found["least"] is None:
        return rows.select("*", F.col("text").alias("next_text"), F.col("signs").alias("next_signs"))
    cuts = sorted({found["least"], *(found["cuts"] or [])})
    own = _floor_position(cuts, F.col("k"))
    is_cut = F.get(_constant(cuts), F.col("own")) == F.col("k")
    before = F.when(F.col("own") == 0, F.lit(len(cuts) - 1)).otherwise(F.col("own") - 1)
    place = lambda part, guest: F.struct(part.cast("int").alias("part"), F.lit(guest).alias("guest"))
    dealt = rows.withColumn("own", own).withColumn(
        "place", F.explode(F.when(is_cut, F.array(place(F.col("own"), 0), place(before, 1))).otherwise(F.array(place(F.col("own"), 0)))))
    dealt = dealt.select(*rows.columns, F.col("place.part").alias("part"), F.col("place.guest").alias("guest"))
    order = Window.partitionBy("part").orderBy("guest", "k", "text")
    led = dealt.select("*", F.lead("text").over(order).alias("next_text"), F.lead("signs").over(order).alias("next_signs"))
    return led.where("guest = 0").drop("part", "guest")


def report(docs: DataFrame, idf_min: float = IDF_MIN, idf_max: float = IDF_MAX) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text ends with the first code points of the next document, as many as a quarter of its own, rounded down,
    in place of its last ones. A null text is empty. Documents that repeat a doc_id follow each other by text; a null
    doc_id comes first. Equal texts have equal fingerprints; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("k"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"))
    terms = lexicon(distinct_texts(rows), idf_min=idf_min, idf_max=idf_max)
    led = with_next(with_signatures(rows, "text", terms, "signs"), 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    cut = F.expr("cast(n_chars div 4 as int)")
    led = led.withColumn("n_chars", F.length("text").cast("long")).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - cut), F.substring("next_text", F.lit(1), cut)))
    few = {c: F.col(c).isNull() for c in ("signs", "edited_signs", "next_signs")}
    out = with_signatures(led, "edited", terms, "edited_signs")
    out = with_all_signatures(out, "text", few["signs"] | few["edited_signs"] | few["next_signs"], "all_signs")
    out = with_all_signatures(out, "edited", few["signs"] | few["edited_signs"], "all_edited_signs")
    out = with_all_signatures(out, "next_text", few["signs"] | few["next_signs"], "all_next_signs")
    prints = {"fingerprint": ("signs", "text"), "edited_fingerprint": ("edited_signs", "edited"), "next_fingerprint": ("next_signs", "next_text")}
    out = out.withColumns({c: fingerprint(F.coalesce(F.col(signs), F.col(f"all_{signs}")), F.col(text)) for c, (signs, text) in prints.items()})

    def near(other: str) -> Column:
        """Both texts are signed in the same way."""
        narrow = ~few["signs"] & ~few[f"{other}_signs"]
        own, others = (F.when(narrow, F.col(c)).otherwise(F.col(f"all_{c}")) for c in ("signs", f"{other}_signs"))
        return likeness(own, others, F.col("fingerprint") == F.col(f"{other}_fingerprint"))

    return out.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        near("edited").alias("near_edited"), near("next").alias("near_next"))
