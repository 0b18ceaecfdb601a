from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from edges import split
from pyspark.sql import functions as F

from tidings.llm import quality_rules
from tidings.llm.quality_rules import BASE, BULLETS, RULES, STOP_WORDS, SYMBOLS, Rule


def brute(text):
    text = text or ""
    words = split(text)
    lines = [x for x in text.split("\n") if split(x)]
    runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times = Counter(runs)
    repeated = {k for i, run in enumerate(runs) if times[run] > 1 for k in range(i, i + 8)}
    bare = [x.strip(quality_rules.SPACES) for x in lines]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in SYMBOLS for c in text),
        "n_stop_words": sum(w.lower() in STOP_WORDS for w in words), "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)),
        "n_bullet_lines": sum(x[0] in BULLETS for x in bare), "n_cut_lines": sum(x.endswith(("...", "…")) for x in bare),
        "n_repeat_words": len(repeated),
    }


def broken(m):
    def bad(value, rule):
        return (rule.least is not None and value < rule.least) or (rule.most is not None and value > rule.most)

    values = {
        "few_words": m["n_words"], "repeated_passages": 100 * m["n_repeat_words"] - 30 * m["n_words"],
        **({} if not m["n_words"] else {"word_length": m["word_chars"] / m["n_words"], "symbols": m["n_symbols"] / m["n_words"], "stop_words": m["n_stop_words"] / m["n_words"]}),
        **({} if not m["n_lines"] else {"repeated_lines": m["n_dup_lines"] / m["n_lines"], "bullet_lines": m["n_bullet_lines"] / m["n_lines"], "cut_lines": m["n_cut_lines"] / m["n_lines"]}),
    }
    return [r.name for r in (*BASE, *RULES) if r.name in values and bad(values[r.name], r)]


def texts():
    rng = np.random.default_rng(3)
    some = lambda n, k: " ".join(f"w{x}" for x in rng.integers(0, k, n))
    passage = some(9, 900)
    return [
        "a b c d e f g h " * 2, "a " * 9, "a " * 8, f"{some(40, 900)} {passage} {some(15, 900)} {passage}", some(300, 2), some(3000, 3),
        "- one\n* two\n- one\n  • three...\nfour…\n\n \n", "### *** $$$", "the of and\r\nthe of and\n", "\n".join(["the same line of it"] * 12), "x y 　 z\x1f\x85",
        " ".join(f"long{k} the" for k in range(40)), "… ...", "it" * 5000 + " the",
    ]


def test_measures_against_brute_force(spark, docs):
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts())], "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    for r in quality_rules.with_quality(rows).collect():
        want = brute(r["text"])
        q = r["quality"].asDict()
        assert {m: q[m] for m in want} == want, r["text"][:80]
        assert q["broken"] == broken(want)
        assert (q["base_failed"], q["kept"]) == (bool({"few_words", "repeated_passages"} & set(q["broken"])), not q["broken"])


def test_report_and_kept_agree_and_keep_columns(docs, none):
    report = quality_rules.report(docs)
    assert report.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "broken"]
    assert report.count() == docs.count()
    kept = quality_rules.kept(docs)
    assert kept.columns == docs.columns and kept.count() == report.where("kept").count()
    assert quality_rules.kept(none).count() == 0 and quality_rules.report(none).count() == 0


def test_columns_named_like_measures(spark):
    rows = spark.createDataFrame([("the of " * 20, 1, "x")], "text string, n_words int, quality_ string").withColumnRenamed("quality_", "n_lines")
    out = quality_rules.with_quality(rows).first()
    assert (out["n_words"], out["n_lines"], out["quality"]["n_words"]) == (1, "x", 40)
    assert quality_rules.kept(rows).columns == rows.columns
    with pytest.raises(ValueError):
        quality_rules.with_quality(rows.withColumn("quality", F.lit(1)))


def test_own_rules(spark):
    rows = spark.createDataFrame([("a b c",), (None,), ("# #",)], "text string")
    rules = [Rule("marks", "n_symbols / nullif(n_words, 0)", most=0.5), Rule("free", "n_words")]
    out = quality_rules.with_quality(rows, rules, base=[]).select("quality.broken", "quality.base_failed", "quality.kept").collect()
    assert [tuple(r) for r in out] == [([], False, True), ([], False, True), (["marks"], False, False)]
    assert quality_rules.with_quality(rows, [], base=[]).where("quality.kept").count() == 3


def test_one_projection_without_python_or_shuffle(spark):
    plan = quality_rules.report(spark.range(9).selectExpr("id AS doc_id", "repeat('a b ', 9) AS text"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
