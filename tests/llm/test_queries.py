"""The registered queries against their SQL, and the pipeline's stages against plain Python."""

from __future__ import annotations

import os
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from edges import split
from test_decontaminate import brute as benchmark_brute
from test_recompress import brute as passages_brute
from test_simhash import fingerprint, lowest
from test_whitening import brute as whitening_brute

import corpus_pipeline
from tidings.llm import queries

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    result = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in result.description]
    got = queries.QUERIES[name](spark, SF_DIR)
    assert Counter(tuple(r[c] for c in columns) for r in got.collect()) == Counter(result.fetchall()) and sorted(got.columns) == sorted(columns)


@pytest.mark.parametrize("name", [q for q in queries.QUERIES if q not in queries.ORACLES and q != "op12_whitening"])
def test_query_has_a_row_per_document(spark, name):
    ids = sorted(r["doc_id"] for r in queries.QUERIES[name](spark, SF_DIR).collect())
    assert ids == sorted(r["doc_id"] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id").collect())


def test_whitening_of_the_whole_table(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    got = queries.op12_whitening(spark, SF_DIR).collect()
    want = whitening_brute([(r["vec_id"], r["embedding"]) for r in rows])
    assert len(got) == len(want) == 8 * len(rows)
    for r in got:
        n, deviation, whitened, explained = want[r["vec_id"], r["component"]]
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert abs(r["whitened"]) == pytest.approx(abs(whitened), abs=1e-8) and r["explained"] == pytest.approx(explained, rel=1e-10)
        assert r["identity_error"] < 1e-9


def test_stages_against_plain_python(spark):
    rows = {r["doc_id"]: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    # All are letters in one of the languages.
    texts = {d: r["text"] for d, r in rows.items() if re.search(r"[^\W\d_]", r["text"])}
    groups = lowest([(d, fingerprint(t)) for d, t in texts.items()])
    texts = {d: texts[d] for d, _, c in groups if d == c}
    kept = {d: (n, w) for d, n, w in passages_brute(list(texts.items()), 50)}
    texts = {d: t if len(kept[d][1]) == kept[d][0] else " ".join(kept[d][1]) for d, t in texts.items() if kept[d][1] or not split(t)}
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    texts = {d: t for d, t in texts.items() if not benchmark_brute(t, items)[1]}

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.columns == columns
    got = {r["doc_id"]: r for r in docs.collect()}
    assert {d: r["text"] for d, r in got.items()} == texts
    assert all(r["n_chars"] == len(r["text"]) and (r["lang"], r["source"]) == (rows[d]["lang"], rows[d]["source"]) for d, r in got.items())
    assert len(texts) < len(rows)


def test_run_gives_the_ids_of_what_is_left(spark):
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    assert len({r["doc_id"] for r in got}) == len(got) > 0 and all(r["same_text"] for r in got)
    assert np.all([r["n_ids"] >= 0 for r in got])


def test_stages_on_awkward_rows(spark, docs, none):
    for name, stage in corpus_pipeline.STAGES:
        for table in (docs, none):
            out = stage(spark, table, SF_DIR)
            assert out.columns == docs.columns or name == "token_ids"
            assert out.count() <= table.count()
