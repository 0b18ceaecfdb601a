"""Quality rules: a table of thresholds, compiled into one projection of built-in expressions.

A rule bounds a value, an SQL expression over measures of a text: its words and their code points, symbols, stop words,
lines, repeated lines, and words in repeated passages. A value that is null, as where it would divide by zero, breaks no
rule. Words are runs of characters other than space and U+0009 to U+000D; lines are what line feeds separate, if a word stands
in them.

Repeated passages are found by a 64-bit hash of each run of eight words, combined from hashes of one, two and four; two
different runs are taken for equal with a chance of about one in 10^19 for each pair of a text. Only texts in which a hash comes
twice are sorted by it. Nothing is shuffled, and each measure is linear in the text but for that sort.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"
RUN = 8

# Fixed values.
SYMBOLS = "#*$%&|<>"
BULLETS = ["-", "*", "•", "‣", "·", "–"]
STOP_WORDS = (
    "the of and to in is that it for was with as on be at by this are from or have an they which you not but his her had "
    "der die das und ist nicht von mit den dem ein eine zu auf für sich im auch als es an werden aus er hat dass sie nach bei "
    "le la les de des et un une du en que qui dans pour pas sur au il elle ce plus par ne se est avec son sont "
    "el los las y del por con para una su al lo como más pero sus sin o este ya entre "
    "il che di non per è della con sono gli nel "
    "os da do em um uma não com na no dos mais foi "
    "het een van dat op te zijn met voor niet aan er maar"
).split()


@dataclass(frozen=True)
class Rule:
    """``value`` has to be at least ``least`` and at most ``most``, where those are given."""

    name: str
    value: str
    least: float | None = None
    most: float | None = None

    def broken(self) -> str:
        """An SQL condition over the measures, which is never null."""
        sides = [f"{self.value} < {self.least!r}"] * (self.least is not None) + [f"{self.value} > {self.most!r}"] * (self.most is not None)
        return f"coalesce({' OR '.join(sides) or 'false'}, false)"


#: Texts that break one of these aren't judged further.
BASE = (
    Rule("few_words", "n_words", least=20),
    Rule("repeated_passages", "100 * n_repeat_words - 30 * n_words", most=0),
)
RULES = (
    Rule("word_length", "word_chars / nullif(n_words, 0)", least=2.0, most=14.0),
    Rule("symbols", "n_symbols / nullif(n_words, 0)", most=0.1),
    Rule("stop_words", "n_stop_words / nullif(n_words, 0)", least=0.02),
    Rule("repeated_lines", "n_dup_lines / nullif(n_lines, 0)", most=0.5),
    Rule("bullet_lines", "n_bullet_lines / nullif(n_lines, 0)", most=0.9),
    Rule("cut_lines", "n_cut_lines / nullif(n_lines, 0)", most=0.3),
)
MEASURES = ("n_words", "word_chars", "n_symbols", "n_stop_words", "n_lines", "n_dup_lines", "n_bullet_lines", "n_cut_lines", "n_repeat_words")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _shifted(a: Column, by: int) -> Column:
    return F.slice(a, by + 1, F.greatest(F.size(a), F.lit(1)))


def _runs(words: Column) -> Column:
    """A hash of each run of ``RUN`` words, in order."""
    doubled = lambda by: lambda a: F.zip_with(a, _shifted(a, by), lambda x, y: F.xxhash64(x, y))
    out, n = F.transform(words, lambda w: F.xxhash64(w)), 1
    while n < RUN:
        out, n = _let(out, doubled(n)), 2 * n
    return F.slice(out, 1, F.greatest(F.size(words) - (RUN - 1), F.lit(0)))


def _covered(runs: Column) -> Column:
    """How many words the runs that come twice or more cover."""
    at = F.sort_array(F.transform(runs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(s: Column) -> Column:
        as_next = F.zip_with(s, _shifted(s, 1), lambda a, b: a["h"].eqNullSafe(b["h"]))
        twice = _let(as_next, lambda e: F.zip_with(e, F.concat(F.array(F.lit(False)), e), lambda a, b: a | b))
        return F.sort_array(F.filter(F.zip_with(s, twice, lambda a, t: F.when(t, a["i"])), lambda i: i.isNotNull()))

    steps = _let(_let(at, places), lambda p: F.zip_with(p, _shifted(p, 1), lambda a, b: F.least(F.lit(RUN), F.coalesce(b - a, F.lit(RUN)))))
    return F.aggregate(steps, F.lit(0), lambda n, step: n + step)


def _repeat_words(words: Column) -> Column:
    return _let(_runs(words), lambda r: F.when(F.size(F.array_distinct(r)) == F.size(r), F.lit(0)).otherwise(_covered(r)))


def _lines(lines: Column) -> dict[str, Column]:
    bare = lambda line: F.trim(line, F.lit(SPACES))
    return {
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_bullet_lines": F.size(F.filter(lines, lambda x: F.substring(bare(x), 1, 1).isin(BULLETS))),
        "n_cut_lines": F.size(F.filter(lines, lambda x: bare(x).endswith("...") | bare(x).endswith("…"))),
    }


def measures(text: Column) -> Column:
    """A struct of ``MEASURES``, longs; a null text has no words."""
    text = F.coalesce(text, F.lit(""))
    without = lambda chars: F.length(F.regexp_replace(text, f"[{chars}]", ""))
    words = F.array_remove(F.split(text, f"[{SPACES}]+"), "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.trim(x, F.lit(SPACES)) != "")

    def of(w: Column, x: Column) -> Column:
        found = {
            "n_words": F.size(w),
            "word_chars": without(SPACES),
            "n_symbols": F.length(text) - without(SYMBOLS),
            "n_stop_words": F.size(F.filter(w, lambda word: F.lower(word).isin(STOP_WORDS))),
            "n_repeat_words": _repeat_words(w),
            **_lines(x),
        }
        return F.struct(*(found[m].cast("long").alias(m) for m in MEASURES))

    return _let(words, lambda w: _let(lines, lambda x: of(w, x)))


def with_quality(docs: DataFrame, rules: Sequence[Rule] = RULES, base: Sequence[Rule] = BASE, text_col: str = "text", name: str = "quality") -> DataFrame:
    """``docs`` with a struct column: the measures, ``base_failed``, ``broken`` (names of all rules broken, in their order)
    and ``kept``.

    Rows stay as they are, repeated ones too; an empty table stays empty. Null and wordless texts have zero measures, and
    fail the base by having few words. A column of ``docs`` called ``name`` is an error; choose another then.
    """
    if name in docs.columns:
        raise ValueError(f"the table already has a column {name}")
    measured = docs.withColumn(name, measures(F.col(text_col)))
    inner = [F.col(name)[m].alias(m) for m in MEASURES]
    broken = lambda these: [F.when(_over(name, r.broken()), F.lit(r.name)) for r in these]
    every = F.array_compact(F.array(*broken([*base, *rules]))) if [*base, *rules] else F.array().cast("array<string>")
    base_failed = F.lit(False)
    for r in base:
        base_failed = base_failed | _over(name, r.broken())
    return measured.withColumn(name, F.struct(*inner, base_failed.alias("base_failed"), every.alias("broken"), (F.size(every) == 0).alias("kept")))


def _over(struct: str, condition: str) -> Column:
    """An SQL condition on measures, as one on the fields of a struct column."""
    return F.expr(re.sub(rf"\b({'|'.join(MEASURES)})\b", rf"`{struct}`.\1", condition))


def kept(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that break no rule, with their columns."""
    spare = next(f"_{k}" for k in range(len(docs.columns) + 1) if f"_{k}" not in docs.columns)
    return with_quality(docs, rules, text_col=text_col, name=spare).where(F.col(spare)["kept"]).drop(spare)


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, broken."""
    found = with_quality(docs.select("doc_id", "text"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return found.select("doc_id", *(F.col("quality")[c].alias(c) for c in names), F.array_join(F.col("quality")["broken"], ",").alias("broken"))


def _quoted(texts: Sequence[str]) -> str:
    return ", ".join(f"'{t}'" for t in texts)


_BLANK = r"[\x20\x09-\x0D]"
_BARE = rf"regexp_replace(regexp_replace(l, '^{_BLANK}+', ''), '{_BLANK}+$', '')"
REPORT_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
  list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l FROM d),
win AS (SELECT r, i, count(*) OVER (PARTITION BY r, p) AS n FROM (
  SELECT r, i, array_to_string(list_slice(w, i, i + {RUN - 1}), ' ') AS p
  FROM (SELECT r, w, unnest(range(1, len(w) - {RUN - 2})) AS i FROM w))),
rep AS (SELECT r, sum(least({RUN}, coalesce(j - i, {RUN}))) AS n_repeat_words FROM (
  SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS j FROM win WHERE n > 1) GROUP BY r),
m AS (SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '{_BLANK}', '', 'g')) AS word_chars,
  length(t) - length(translate(t, '{SYMBOLS}', '')) AS n_symbols,
  len(list_filter(w, lambda x: lower(x) IN ({_quoted(STOP_WORDS)}))) AS n_stop_words,
  len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
  len(list_filter(l, lambda l: substr({_BARE}, 1, 1) IN ({_quoted(BULLETS)}))) AS n_bullet_lines,
  len(list_filter(l, lambda l: {_BARE} LIKE '%...' OR {_BARE} LIKE '%…')) AS n_cut_lines,
  CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN rep USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  {' OR '.join(r.broken() for r in BASE)} AS base_failed, NOT ({' OR '.join(r.broken() for r in (*BASE, *RULES))}) AS kept,
  concat_ws(',', {', '.join(f"CASE WHEN {r.broken()} THEN '{r.name}' END" for r in (*BASE, *RULES))}) AS broken
FROM m
"""
