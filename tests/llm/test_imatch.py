from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pytest

from tidings.llm import imatch


def terms(text):
    return {w for w in re.split(r"[\W_]+", text.lower()) if w}


def documents(spark, n=300):
    pool = [f"t{k}" for k in range(150)]
    texts = [" ".join(pool[(k * j * 7 + j * j) % (20 + k % 130)] for j in range(10 + k % 40)) for k in range(n)]
    texts[17], texts[230], texts[99], texts[100] = texts[3], texts[3], None, ""
    return spark.createDataFrame([((k * 37) % 1009, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(5)


def test_edited_texts_and_lengths(spark):
    rows = documents(spark)
    order = sorted((r["doc_id"], r["text"] or "") for r in rows.collect())
    got = {r["doc_id"]: r for r in imatch.report(rows).collect()}
    assert len(got) == len(order)
    for k, (d, t) in enumerate(order):
        following, cut = order[(k + 1) % len(order)][1], len(t) // 4
        edited = t[: len(t) - cut] + following[:cut]
        assert (got[d]["n_chars"], got[d]["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= got[d]["near_edited"] <= 1 and 0 <= got[d]["near_next"] <= 1
        assert (got[d]["fingerprint"] == got[d]["edited_fingerprint"]) <= (got[d]["near_edited"] == 1)


def test_lexicon_is_the_band(spark):
    rows = documents(spark)
    texts = [r["text"] or "" for r in rows.collect()]
    df = Counter(w for t in texts for w in terms(t))
    for low, high in ((0.5, 3.0), (2.3, 5.3)):
        want = {w for w, n in df.items() if n >= 2 and low <= math.log(len(texts) / n) <= high}
        hashes = {r["h"] for r in spark.createDataFrame([(w,) for w in want], "w string").selectExpr("xxhash64(w) AS h").collect()}
        assert set(imatch.lexicon(rows, idf_min=low, idf_max=high)) == hashes


def test_fingerprints_follow_the_terms_in_the_lexicon(spark):
    rows = documents(spark)
    band = (0.5, 3.0)
    lexicon = set(imatch.lexicon(rows, idf_min=band[0], idf_max=band[1]))
    got = {r["doc_id"]: r["fingerprint"] for r in imatch.report(rows, *band).collect()}
    code = {r["w"]: r["h"] for r in spark.createDataFrame([(f"t{k}",) for k in range(150)], "w string").selectExpr("w", "xxhash64(w) AS h").collect()}
    by_terms = {}
    for r in rows.collect():
        held = frozenset(code[w] for w in terms(r["text"] or "") if code[w] in lexicon)
        by_terms.setdefault(held or r["text"] or "", set()).add(got[r["doc_id"]])
    assert all(len(prints) == 1 for prints in by_terms.values())
    whole = {k: next(iter(v))[:8] for k, v in by_terms.items() if isinstance(k, frozenset)}
    assert len(set(whole.values())) == len(whole)  # the first signature is that of the whole lexicon


def test_likeness_falls_with_the_edit(spark):
    base = " ".join(f"t{k}" for k in range(60))
    fill = [" ".join(f"t{(k * 11 + j) % 60}" for j in range(6)) for k in range(60)]
    texts = [base, base + " t0", base.replace("t5 ", "u5 "), " ".join(f"u{k}" for k in range(60)), *fill, *[f"u{k} u5" for k in range(60)]]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lexicon = imatch.lexicon(rows, idf_min=0.0, idf_max=9.0)
    signs = {r["doc_id"]: r["signs"] for r in imatch.with_signatures(rows, "text", lexicon, "signs").collect()}
    like = lambda a, b: sum(x == y != 0 for x, y in zip(signs[a], signs[b])) / sum(bool(x or y) for x, y in zip(signs[a], signs[b]))
    assert like(0, 1) == 1 > like(0, 2) > like(0, 3)


@pytest.mark.parametrize("parts", [1, 2, 7, 400])
def test_successors_do_not_depend_on_the_buckets(spark, parts):
    ids = [5, 9, 9, -3, 1 << 60, 77, 12, 0]
    rows = spark.createDataFrame([(i, f"t{i}", [i]) for i in ids], "k long, text string, signs array<long>")
    got = sorted((r["k"], r["next_text"], r["next_signs"]) for r in imatch.with_next(rows, parts).collect())
    order = sorted(ids)
    assert got == sorted((i, f"t{j}", [j]) for i, j in zip(order, order[1:] + order[:1]))


def test_edge_documents(docs, none):
    got = imatch.report(docs).collect()
    assert len(got) == docs.count() and {r["n_chars"] for r in got if r["doc_id"] == 100} == {0}
    texts = {}
    ids = {r["doc_id"]: r["fingerprint"] for r in got}
    for r in docs.collect():
        texts.setdefault(r["text"] or "", set()).add(ids[r["doc_id"]])
    assert all(len(p) == 1 for p in texts.values())
    assert imatch.report(none).collect() == []


def test_no_python_in_the_plan(docs):
    plan = imatch.report(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def hot_rows(spark, hot, n=400):
    """Every third text is ``hot(k)``; the others share words in groups, so that these lie in the band."""
    fill = lambda k: " ".join(f"g{k % 40}w{j}" for j in range(30)) + f" own{k}"
    return spark.createDataFrame([(k, hot(k) if k % 3 == 0 else fill(k)) for k in range(n)], "doc_id long, text string")


def test_copies_do_not_push_their_terms_out(spark):
    text = " ".join(f"g{k % 40}w{j}" for k, j in zip(range(80), range(80)) if j < 30) + " " + " ".join(f"g7w{j}" for j in range(30))
    rows = hot_rows(spark, lambda k: text)
    got = [r for r in imatch.report(rows).collect() if r["doc_id"] % 3 == 0]
    assert len({r["fingerprint"] for r in got}) == 1 and len(got[0]["fingerprint"]) > 16
    assert len(imatch.lexicon(imatch.distinct_texts(rows))) > len(imatch.lexicon(rows)) > 0


def test_near_copies_in_a_large_group_are_alike(spark):
    base = [f"hot{j}" for j in range(100)]
    got = imatch.report(hot_rows(spark, lambda k: " ".join([*base[:50], f"edit{k}", *base[50:]]))).collect()
    near = {r["doc_id"]: r["near_edited"] for r in got if r["doc_id"] % 3 == 0}
    assert min(near.values()) > 0
    same = imatch.report(hot_rows(spark, lambda k: " ".join([*base[:50], f"edit{k}", *base[50:]])).where("doc_id % 3 = 0 OR doc_id < 9")).collect()
    assert min(r["near_next"] for r in same if r["doc_id"] % 3 == 0 and 9 <= r["doc_id"] < 399) > 0.4


def test_texts_of_a_rare_language_are_alike(spark):
    rare = " ".join(f"selten{j}" for j in range(100))
    rows = [(k, f"{rare} einmal{k}" if k < 2 else " ".join(f"g{k % 40}w{j}" for j in range(30))) for k in range(1200)]
    got = {r["doc_id"]: r for r in imatch.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got[0]["fingerprint"]) > 16 and got[0]["near_next"] > 0.5 and got[0]["near_edited"] > 0 and got[1]["near_next"] < 0.1
