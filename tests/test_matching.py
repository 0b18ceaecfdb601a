from __future__ import annotations

import math
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidings.functions import vectors
from tidings.operators import homonyms, master, matching, nearest


def unit(rng, n, dim):
    rows = rng.normal(size=(n, dim))
    return (rows / np.linalg.norm(rows, axis=1, keepdims=True)).astype(np.float32)


def brute_force(queries, index):
    cos = np.round(queries.astype(np.float64) @ index.T.astype(np.float64), 6)
    return cos.argmax(axis=1), cos.max(axis=1)


def frame(spark, rows, key, vec, schema="bigint"):
    return spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], f"{key} {schema}, {vec} array<float>")


@pytest.mark.parametrize("index_rows, query_rows", [(4096, 16384), (7, 11), (1, 1000)])
def test_best_in_cells_equals_brute_force_with_a_hot_cell(spark, index_rows, query_rows):
    rng = np.random.default_rng(1)
    index, queries = unit(rng, 60, 8), unit(rng, 90, 8)
    cell_of = lambda i: 0 if i % 3 == 0 else i % 7 + 1  # a third of all rows in one cell
    left = spark.createDataFrame([(cell_of(i), i, r.tolist()) for i, r in enumerate(queries)], "cell int, query_key int, query_vec array<float>")
    right = spark.createDataFrame([(cell_of(i), f"{i:03d}", r.tolist()) for i, r in enumerate(index)], "cell int, item_key string, item_vec array<float>")
    got = {r.query_key: (int(r.item_key), r.cos) for r in nearest.best_in_cells(left, right, index_rows, query_rows).collect()}
    assert len(got) == len(queries)
    for q in range(len(queries)):
        members = [i for i in range(len(index)) if cell_of(i) == cell_of(q)]
        best, cos = brute_force(queries[q : q + 1], index[members])
        assert got[q][0] == members[best[0]] and got[q][1] == pytest.approx(cos[0], abs=1e-6)


def _stored_turns(monkeypatch):
    """The tables that turns of a search store from now on, as lists of query keys."""
    turns, store = [], nearest.storage.materialize

    def kept(df, path=None, label="stage"):
        stored = store(df, path, label)
        if label == "turn-best":
            turns.append([r.query_key for r in stored.select("query_key").collect()])
        return stored

    monkeypatch.setattr(nearest.storage, "materialize", kept)
    return turns


@pytest.mark.parametrize("one_cell", [True, False])
def test_parts_of_a_large_cell_take_turns(spark, monkeypatch, one_cell):
    """Eight by eight tiles of one cell would copy each row eight times at once; each turn copies it about twice."""
    rng = np.random.default_rng(8)
    index, queries = unit(rng, 90, 8), unit(rng, 90, 8)
    cell_of = lambda i: 0 if i < 80 else i % 5 + 1
    cells = lambda q: [cell_of(q)] if one_cell else sorted({cell_of(q), 1})
    left = spark.createDataFrame([(c, q, r.tolist()) for q, r in enumerate(queries) for c in cells(q)], "cell int, query_key int, query_vec array<float>")
    right = spark.createDataFrame([(cell_of(i), f"{i:03d}", r.tolist()) for i, r in enumerate(index)], "cell int, item_key string, item_vec array<float>")
    turns = _stored_turns(monkeypatch)
    got = {r.query_key: (int(r.item_key), r.cos) for r in nearest.best_in_cells(left, right, 10, 10, one_cell=one_cell).collect()}
    assert len(got) == 90 and len(turns) >= 3
    in_first_cell = [q for turn in turns for q in turn if q < 80]
    assert max(sum(q < 80 for q in turn) for turn in turns) < 60
    if one_cell:
        assert sorted(in_first_cell) == list(range(80))
    for q in range(90):
        members = [i for i in range(90) if cell_of(i) in cells(q)]
        best, cos = brute_force(queries[q : q + 1], index[members])
        assert got[q][0] == members[best[0]] and got[q][1] == pytest.approx(cos[0], abs=1e-6)


@pytest.mark.parametrize("n_queries, n_items", [(10, 300), (300, 10), (200, 200), (400, 400)])
def test_turns_keep_the_copies_of_one_near_the_rows(rows, n_queries, n_items):
    """Twice the rows on both sides are four times the copies, in twice the turns."""
    part = lambda n: (-(-n // 10), n) if n > 10 else (None, None)
    large = rows("cell int, index_parts int, index_n bigint, query_parts int, query_n bigint", (0, *part(n_items), *part(n_queries)))
    turns = nearest._turns(large, 10, 10, n_queries + n_items)
    copies = n_queries * -(-n_items // 10) + n_items * -(-n_queries // 10)
    assert 1 <= turns <= -(-n_queries // 10)
    assert copies / turns <= 1.1 * nearest.TURN_COPIES * (n_queries + n_items)
    assert nearest._turns(large.limit(0), 10, 10, 0) == 1


def test_tie_goes_to_the_smallest_key_across_tiles(spark):
    same = [(0, f"{i:03d}", [1.0, 0.0]) for i in range(50)]
    left = spark.createDataFrame([(0, 1, [1.0, 0.0]), (0, 2, [0.0, 0.0])], "cell int, query_key int, query_vec array<float>")
    right = spark.createDataFrame(same, "cell int, item_key string, item_vec array<float>")
    got = {r.query_key: (r.item_key, r.cos) for r in nearest.best_in_cells(left, right, index_rows=4).collect()}
    assert got == {1: ("000", 1.0), 2: ("000", 0.0)}


def test_cells_without_index_rows_give_nothing(spark):
    left = spark.createDataFrame([(1, 1, [1.0])], "cell int, query_key int, query_vec array<float>")
    right = spark.createDataFrame([(2, "a", [1.0])], "cell int, item_key string, item_vec array<float>")
    assert nearest.best_in_cells(left, right).count() == 0
    assert nearest.nearest(left.drop("cell"), right.drop("cell").limit(0), threshold=0.9).count() == 0
    assert nearest.nearest(left.drop("cell").limit(0), right.drop("cell")).count() == 0


@pytest.mark.parametrize("threshold", [0.95, 0.9, 0.5, 0.1, -0.4])
@pytest.mark.parametrize("score", ["relevance", "cosine"])
def test_threshold_search_is_exact(spark, threshold, score):
    rng = np.random.default_rng(2)
    centres = unit(rng, 12, 6)
    near = lambda n: np.concatenate([c + 0.25 * rng.normal(size=(n, 6)) for c in centres])
    norm = lambda x: (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    index, queries = norm(near(20)), norm(near(6))
    found = nearest.nearest(
        frame(spark, queries, "query_key", "query_vec"), frame(spark, index, "item_key", "item_vec"), threshold, score, cell_rows=20
    )
    got = {r.query_key: (r.item_key, r.score) for r in found.collect()}
    best, cos = brute_force(queries, index)
    scores = 1 - math.sqrt(2) * (1 - cos) if score == "relevance" else cos
    want = {q: best[q] for q in range(len(queries)) if round(scores[q], 6) >= threshold}
    assert {q: i for q, (i, _) in got.items()} == want
    assert all(s == pytest.approx(scores[q], abs=1e-5) for q, (_, s) in got.items())


def test_far_cells_are_skipped(spark):
    """Two tight bundles at right angles: no query is sent to the other bundle's cell."""
    rng = np.random.default_rng(3)
    bundle = lambda axis, n: np.eye(4)[axis] + 0.01 * rng.normal(size=(n, 4))
    pivots = np.eye(4)[:2]
    queries = frame(spark, np.concatenate([bundle(0, 5), bundle(1, 5)]), "query_key", "query_vec")
    own = nearest._assign_cells(queries, "query_vec", pivots).withColumn("floor", F.lit(0.93))
    assert nearest._reachable_cells(own, pivots, [0, 1], np.zeros(2), np.full(2, 0.1)).count() == 0


@pytest.mark.parametrize("cell_rows", [10, 100000])
def test_near_copies_do_not_depend_on_the_cells(spark, cell_rows):
    """Scores that just round to the threshold are found whichever cell they are in."""
    rng = np.random.default_rng(4)
    index = unit(rng, 400, 8)
    moved = index + 5e-5 * rng.normal(size=index.shape)
    queries = (moved / np.linalg.norm(moved, axis=1, keepdims=True)).astype(np.float32)
    found = nearest.nearest(frame(spark, queries, "query_key", "query_vec"), frame(spark, index, "item_key", "item_vec"), 1.0, cell_rows=cell_rows)
    top = (queries.astype(float) / np.linalg.norm(queries.astype(float), axis=1, keepdims=True)) @ (index.astype(float) / np.linalg.norm(index.astype(float), axis=1, keepdims=True)).T
    assert {r.query_key for r in found.collect()} == set(np.flatnonzero(np.round(1 - math.sqrt(2) * (1 - top.max(axis=1)), 6) >= 1.0).tolist())


def test_clustered_vectors_visit_few_cells(spark):
    rng = np.random.default_rng(5)
    centres = unit(rng, 40, 256)
    near = lambda n: np.concatenate([c + 0.02 * rng.normal(size=(n, 256)) for c in centres])
    index, queries = near(25).astype(np.float32), near(5).astype(np.float32)
    rows, wanted = frame(spark, index, "item_key", "item_vec"), frame(spark, queries, "query_key", "query_vec")
    pivots = nearest._choose_pivots(rows, 10, 1024)
    assigned = nearest._assign_cells(rows, "item_vec", pivots)
    own = nearest._assign_cells(wanted, "query_vec", pivots).drop("angle")
    found = nearest.best_in_cells(own, assigned.drop("angle"), one_cell=True)
    visits = nearest.cells_to_visit(own, found, assigned, pivots, -1.0)
    assert len(pivots) == 100 and visits.count() < 0.2 * len(queries) * len(pivots)
    got = {r.query_key: r.item_key for r in nearest.nearest(wanted, rows, cell_rows=10).collect()}
    scaled = lambda x: x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    assert got == dict(enumerate(np.round(scaled(queries) @ scaled(index).T, 6).argmax(axis=1).tolist()))


def test_a_query_travels_once_per_group_of_cells(spark, monkeypatch):
    """Far-spread vectors rule out no cell: 29 cells of ten rows are one group, not 29 visits."""
    rng = np.random.default_rng(6)
    index, queries = unit(rng, 300, 32), unit(rng, 40, 32)
    visits, store = [], nearest.storage.materialize

    def kept(df, path=None, label="stage"):
        stored = store(df, path, label)
        if label == "query-cells":
            visits.append(stored.count())
        return stored

    monkeypatch.setattr(nearest.storage, "materialize", kept)
    found = nearest.nearest(frame(spark, queries, "query_key", "query_vec"), frame(spark, index, "item_key", "item_vec"), cell_rows=10)
    assert {r.query_key: r.item_key for r in found.collect()} == dict(enumerate(brute_force(queries, index)[0].tolist()))
    assert visits[0] <= len(queries)


def test_near_cells_share_a_group(spark):
    pivots = np.asarray([[1.0, 0.0], [0.0, 1.0], [0.99, 0.14], [0.14, 0.99], [-1.0, 0.0]])
    cells = spark.createDataFrame([(c,) for c, n in ((0, 3), (1, 3), (2, 3), (3, 3), (4, 9)) for _ in range(n)], "cell int")
    assert nearest._cell_groups(cells, pivots, 6).tolist() == [0, 1, 0, 1, 4]


def test_a_cell_is_searched_in_bounded_memory_and_as_in_double_precision():
    """Ties to six places, copies, rows that differ less than single precision shows, zero rows and rows that aren't numbers."""
    rng = np.random.default_rng(7)
    items, wanted = unit(rng, 8000, 16).astype(float), unit(rng, 1500, 16).astype(float)
    items[5::9] = items[5]
    items[7::11] = items[7] + 4e-7 * rng.normal(size=(len(items[7::11]), 16))
    wanted[:40], wanted[40:80], wanted[80], wanted[81] = items[5], items[7], 0.0, np.nan
    tracemalloc.start()
    best, cos, top = nearest._best_in_cell(wanted, items)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    for k in range(0, len(wanted), 500):
        part = wanted[k : k + 500] @ items.T
        first = np.round(part, 6).argmax(axis=1)
        assert (best[k : k + 500] == first).all()
        assert np.allclose(cos[k : k + 500], part[np.arange(len(part)), first], atol=1e-12, equal_nan=True)
        assert np.allclose(top[k : k + 500], part.max(axis=1), atol=1e-12, equal_nan=True)
    assert peak < 64 << 20


def test_products_with_many_items_are_not_held():
    rng = np.random.default_rng(8)
    items, wanted = unit(rng, 60000, 16).astype(float), unit(rng, 300, 16).astype(float)
    items[9::7000] = items[9]
    wanted[0] = items[9]
    tracemalloc.start()
    best, cos, top = nearest._best_in_cell(wanted, items)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    exact = wanted @ items.T
    assert (best == np.round(exact, 6).argmax(axis=1)).all() and best[0] == 9
    assert np.allclose(cos, exact[np.arange(300), best], atol=1e-12) and np.allclose(top, exact.max(axis=1), atol=1e-12)
    assert peak < 16 << 20  # the products of 256 queries in single precision alone would be 61 MB


def test_scores():
    assert vectors.cosine_for_relevance(0.9) == pytest.approx(0.92929, abs=1e-5)


def test_cosine_of_zero_vectors(rows):
    df = rows("a array<float>, b array<float>", ([1.0, 0.0], [0.0, 0.0]), ([1.0, 1.0], [2.0, 2.0]))
    assert [round(r.c, 9) for r in df.select(vectors.cosine(F.col("a"), F.col("b")).alias("c")).collect()] == [0.0, 1.0]


def test_bigram_encoder():
    out = vectors.bigram_encoder(["", "a", "aa", "한국"])
    assert out.shape == (4, vectors.BIGRAM_DIM) and np.allclose(np.linalg.norm(out, axis=1), 1)
    assert out[1][(31 * 32 + 97) % 256] == pytest.approx(1 / math.sqrt(2))


MASTER = [
    ("001", "알파전자", "M1", "electronics", "phones"),
    ("002", "(주)알파전자", "M2", "food", "noodles"),
    ("003", "Beta Motors", "M3", None, ""),
    ("004", "Gamma", "M4", "steel", "plates"),
]


@pytest.fixture
def companies(spark):
    return master.with_clean_name(spark.createDataFrame(
        MASTER, "cust_no string, cust_nm string, sglr_ases_modl_clas_cd string, std_inds_clas_nm string, primy_prod_nm string"
    ))


def test_explode(rows):
    df = rows("seq int, company_names array<string>", (1, ["a", None, "", "a"]), (2, []), (3, None))
    assert [(r.seq, r.target_company) for r in matching.explode_mentions(df).collect()] == [(1, "a"), (1, "a")]


def embedded(spark, table, key):
    """Name -> vector in the plane, by angle in degrees."""
    return spark.createDataFrame(
        [(k, [math.cos(math.radians(a)), math.sin(math.radians(a))], "e") for k, a in table.items()],
        f"{key} string, embedding array<float>, encoder_id string",
    )


def test_cascade(spark, companies):
    mentions = matching.with_clean_target(spark.createDataFrame(
        [(1, "알파전자"), (1, "Beta Motors Inc."), (2, "gamm"), (2, "gamx"), (3, "(주)"), (3, "zzzz")], "seq bigint, target_company string"
    ))
    directory = master.name_directory(companies)
    names = matching.unmatched_names(mentions, directory)
    assert sorted(r[0] for r in names.collect()) == ["gamm", "gamx", "zzzz"]  # '(주)' is empty and never searched
    # A relevance of 0.95 is 15 degrees, of 0.85 is 27 degrees.
    queries = embedded(spark, {"gamm": 15.0, "gamx": 27.0, "zzzz": 90.0}, "clean_target_company")
    index = embedded(spark, {"gamma": 0.0, "알파전자": 200.0, "betamotors": 250.0, "goneaway": 91.0}, "clean_cust_nm")
    hits = matching.vector_match(queries, index, directory, "e", threshold=0.9)
    got = {(r.seq, r.target_company): r for r in matching.cascade(mentions, directory, hits).collect()}
    assert set(got) == {(1, "알파전자"), (1, "Beta Motors Inc."), (2, "gamm")}
    exact, near = got[1, "알파전자"], got[2, "gamm"]
    assert (exact.mapping_method, exact.similarity_score, exact.n_candidates, exact.cust_no) == ("exact_normalized", 1.0, 2, "001")
    assert (near.mapping_method, near.matched_clean_name, near.n_candidates, near.cust_no) == ("vector_search", "gamma", 1, "004")
    assert near.similarity_score == pytest.approx(1 - math.sqrt(2) * (1 - math.cos(math.radians(15))), abs=1e-6)
    other = matching.vector_match(queries, index.withColumn("encoder_id", F.lit("old")), directory, "e", threshold=0.9)
    assert other.count() == 0  # vectors of two encoders are never compared


def test_homonyms_go_to_the_closest_context(spark, companies):
    mentions = matching.distinct_mentions(matching.with_clean_target(spark.createDataFrame(
        [(1, "알파전자"), (1, "알파전자"), (2, "알파전자"), (2, "Gamma"), (3, "알파전자")], "seq bigint, target_company string"
    )))
    none = spark.createDataFrame([], "clean_target_company string, matched_clean_name string, similarity_score double")
    named = matching.cascade(mentions, master.name_directory(companies), none)
    article_keys = spark.createDataFrame([(1, "x"), (2, "y")], "seq bigint, context_key string")
    company_keys = spark.createDataFrame(
        [("알파전자", "001", "p"), ("알파전자", "002", "q")], "clean_cust_nm string, cust_no string, context_key string"
    )
    contexts = spark.createDataFrame(
        [("x", [1.0, 0.1]), ("y", [0.1, 1.0]), ("p", [1.0, 0.0]), ("q", [0.0, 1.0])], "context_key string, embedding array<float>"
    )
    out = homonyms.resolve_homonyms(named, article_keys, company_keys, companies.select("cust_no", "cust_nm"), contexts)
    got = {(r.seq, r.target_company): (r.cust_no, r.cust_nm, round(r.homonym_score, 3)) for r in out.collect()}
    assert got == {
        (1, "알파전자"): ("001", "알파전자", 0.995),
        (2, "알파전자"): ("002", "(주)알파전자", 0.995),
        (2, "Gamma"): ("004", "Gamma", 0.0),
        (3, "알파전자"): ("001", "알파전자", 0.0),  # no context: the first company
    }
    assert out.count() == 4


def test_articles_are_joined_once(spark, companies, tmp_path):
    """With customer numbers that come twice, an article that comes twice, and a name without context."""
    named = spark.createDataFrame(
        [(1, "알파전자", "알파전자", 2, "001", "알파전자"), (1, "알파전자", "알파전자", 2, "001", "알파전자"), (2, "알파전자", "알파전자", 2, "001", "알파전자"),
         (3, "Gamma", "gamma", 1, "004", "Gamma"), (4, "알파전자", "알파전자", 2, "001", "알파전자"), (5, "beta", "beta", 2, "003", "Beta")],
        "seq bigint, target_company string, matched_clean_name string, n_candidates bigint, cust_no string, cust_nm string",
    )
    keys = str(tmp_path / "article-keys")
    spark.createDataFrame([(1, 7), (2, 8), (4, None), (5, 7)], "seq bigint, context_key bigint").write.parquet(keys)
    company_keys = spark.createDataFrame([("알파전자", "001", 7), ("알파전자", "002", 8), ("알파전자", "002", 8)], "clean_cust_nm string, cust_no string, context_key bigint")
    contexts = spark.createDataFrame([(7, [1.0, 0.0]), (8, [0.0, 1.0])], "context_key bigint, embedding array<float>")
    names = companies.select("cust_no", "cust_nm").union(companies.where("cust_no = '002'").select("cust_no", F.lit("again")))
    out = homonyms.resolve_homonyms(named, spark.read.parquet(keys), company_keys, names, contexts)
    assert not [f for f in out.inputFiles() if keys in f]
    assert sorted((r.seq, r.cust_no, r.cust_nm, r.homonym_score) for r in out.collect()) == [
        (1, "001", "알파전자", 1.0), (1, "001", "알파전자", 1.0), (2, "002", "(주)알파전자", 1.0), (2, "002", "again", 1.0),
        (3, "004", "Gamma", 0.0), (4, "001", "알파전자", 0.0), (5, "003", "Beta", 0.0),
    ]


def test_vectors_of_contexts_are_off_the_disk_when_mentions_travel(rows):
    """The search is stored, so that its shuffles are removed before the last join: no step of it is in the result's plan."""
    named = rows("seq bigint, target_company string, matched_clean_name string, n_candidates bigint, cust_no string, cust_nm string", (1, "a", "a", 2, "1", "a"))
    company_keys = rows("clean_cust_nm string, cust_no string, context_key bigint", ("a", "1", 7), ("a", "2", 8))
    vectors = rows("context_key bigint, embedding array<float>", (7, [1.0, 0.0]), (8, [0.0, 1.0]))
    names = rows("cust_no string, cust_nm string", ("1", "a"), ("2", "b"))
    out = homonyms.resolve_homonyms(named, rows("seq bigint, context_key bigint", (1, 8)), company_keys, names, vectors)
    assert [(r.cust_no, r.cust_nm, r.homonym_score) for r in out.collect()] == [("2", "b", 1.0)]
    assert "CoGroup" not in out._jdf.queryExecution().executedPlan().toString()


def test_short_vectors_come_in_larger_tiles(rows):
    tile = lambda *lengths: homonyms._tile_rows(rows("embedding array<float>", *[(None if n is None else [1.0] * n,) for n in lengths]))
    assert tile(None, 64, 64) == 2 * nearest.INDEX_ROWS and tile(2) == 4 * nearest.INDEX_ROWS
    assert tile(256) == tile(1024) == tile() == tile(None) == nearest.INDEX_ROWS


def test_contexts_fall_back_to_the_name(companies):
    got = {r.cust_no: r.context for r in homonyms.company_contexts(companies).collect()}
    assert got["001"] == "electronics phones" and got["003"] == "Beta Motors"


def test_one_row_per_customer(rows):
    df = rows(
        "seq int, cust_no string, target_company string, mapping_method string",
        (1, "c", "z", "exact_normalized"), (1, "c", "a", "vector_search"), (1, "d", "b", "vector_search"),
    )
    got = sorted((r.cust_no, r.target_company) for r in matching.one_per_customer(df).collect())
    assert got == [("c", "z"), ("d", "b")]


def test_essential_and_enrich(rows, companies):
    df = rows(
        "seq int, classification string, cust_no string, cust_nm string",
        (1, "essential", "001", "알파전자"), (2, "noise", "001", "알파전자"), (3, "essential", "", ""), (4, "essential", None, None),
        (5, "essential", "001", "other name"),
    )
    out = {r.seq: r.std_inds_clas_nm for r in matching.enrich(matching.essential(df), companies).collect()}
    assert out == {1: "electronics", 5: None}


def test_the_encoder_and_a_side_of_a_tile_need_little_memory_beside_their_result():
    texts = [chr(97 + k % 26) * 60_000 + "한" * (k % 3) for k in range(64)]
    tracemalloc.start()
    out = vectors.bigram_encoder(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6  # before, 3.8 million characters at once took several times that
    assert np.array_equal(out, np.concatenate([vectors.bigram_encoder([t]) for t in texts]))

    column = pa.chunked_array([pa.array(list(np.ones((20_000, 64), dtype=np.float32)), pa.list_(pa.float32()))])
    tracemalloc.start()
    rows = nearest._matrix(column, 20_000)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.5 * rows.nbytes and np.allclose(rows, 1 / 8)


def test_a_tile_holds_one_cell_in_double_precision_at_a_time():
    rng, n, cells, dim = np.random.default_rng(7), 400, 40, 256
    many, few = unit(rng, n * cells, dim), unit(rng, 3 * cells, dim)
    vecs = lambda rows: pa.ListArray.from_arrays(np.arange(0, rows.size + 1, dim, dtype=np.int32), rows.ravel())
    table = lambda key, vec, rows: pa.table({"cell": np.arange(len(rows)) % cells, key: np.arange(len(rows)), vec: vecs(rows)})
    queries, index = table("query_key", "query_vec", many), table("item_key", "item_vec", few)
    nearest._best_in_tile(queries, index)
    tracemalloc.start()
    found = nearest._best_in_tile(queries, index)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < many.size * 8 / 4  # Arrow's memory isn't traced; all queries in double precision would be four times that
    for key, item in zip(found["query_key"].to_pylist()[::97], found["item_key"].to_pylist()[::97]):
        own = np.arange(key % cells, len(few), cells)
        assert item == own[brute_force(many[key : key + 1], few[own])[0][0]]
