"""Digest trees, look-ups in the serving copy, approximate search."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidings import storage
from tidings.operators import approximate, digest_tree, nearest, serving


@pytest.fixture
def companies(spark):
    return spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"), F.concat(F.lit("name "), "id").alias("name"))


def compared(snapshot, table):
    changes = snapshot.compare(table)
    return changes, {r.key: r.change for r in changes.rows.collect()}


def test_each_change_touches_one_bucket(spark, companies, tmp_path):
    snapshot = digest_tree.KeyedSnapshot(spark, str(tmp_path), ["key"], ["name"])
    changes, rows = compared(snapshot, companies)
    assert set(rows.values()) == {"insert"} and len(rows) == 3000
    snapshot.save(companies, changes)
    assert compared(snapshot, companies.repartition(7))[0].buckets == []
    renamed = companies.withColumn("name", F.when(F.col("key") == "k5", "other").otherwise(F.col("name")))
    more = companies.unionByName(spark.createDataFrame([("new", None)], "key string, name string"))
    for table, want in ((renamed, {"k5": "update"}), (more, {"new": "insert"}), (companies.where("key <> 'k9'"), {"k9": "delete"})):
        changes, rows = compared(snapshot, table)
        assert rows == want and len(changes.buckets) == 1
    snapshot.save(renamed, compared(snapshot, renamed)[0])
    assert compared(snapshot, renamed)[1] == {} and compared(snapshot, companies)[1] == {"k5": "update"}
    # Only one group was written anew; the others are read where they were.
    assert len(storage.folder_names(spark, f"{tmp_path}/rows")) == 2
    assert len(storage.folder_names(spark, f"{tmp_path}/rows/{snapshot._newest()}")) == 1


def test_rows_of_other_groups_are_not_read(spark, companies, tmp_path):
    snapshot = digest_tree.KeyedSnapshot(spark, str(tmp_path), ["key"], ["name"])
    snapshot.save(companies, snapshot.compare(companies))
    changes = snapshot.compare(companies.where("key <> 'k9'"))
    stored = snapshot._stored_rows(snapshot.stored_digests(), changes.buckets, companies.withColumn("bucket", F.lit(1)).schema)
    assert len({f.rpartition("/")[0] for f in stored.inputFiles()}) == 1


def test_digests_tell_null_from_empty_and_values_from_their_neighbours(spark):
    def digest(a, b):
        rows = spark.createDataFrame([("k", a, b)], "key string, a string, b string")
        return digest_tree.digests(rows, ["key"], ["a", "b"]).first()[:]

    assert len({digest(*v) for v in ((None, ""), ("", None), ("", ""), ("x", "yz"), ("xy", "z"), ("-", None))}) == 6


def test_empty_versions(spark, companies, tmp_path):
    snapshot = digest_tree.KeyedSnapshot(spark, str(tmp_path), ["key"], ["name"])
    none = companies.limit(0)
    changes, rows = compared(snapshot, none)
    assert (changes.buckets, rows) == ([], {})
    snapshot.save(none, changes)
    few = companies.limit(3)
    snapshot.save(few, compared(snapshot, few)[0])
    assert set(compared(snapshot, none)[1].values()) == {"delete"}


def test_stored_digests(spark, companies, tmp_path):
    path = str(tmp_path / "d")
    assert digest_tree.load(spark, path) is None
    for table in (companies, companies.limit(10)):
        now = digest_tree.digests(table, ["key"], ["name"])
        digest_tree.store(now, path)
        assert digest_tree.changed_buckets(now, digest_tree.load(spark, path)) == []
    assert len(digest_tree.changed_buckets(digest_tree.digests(companies, ["key"], ["name"]), digest_tree.load(spark, path))) > 1000


def scanned_rows(df):
    """Rows that the scans of an executed plan put out."""
    df.collect()
    found = []

    def walk(node):
        kind = node.getClass().getSimpleName()
        node = node.executedPlan() if kind == "AdaptiveSparkPlanExec" else node
        if kind == "FileSourceScanExec":
            found.append(node.metrics().get("numOutputRows").get().value())
        for k in range(node.children().size()):
            walk(node.children().apply(k))

    walk(df._jdf.queryExecution().executedPlan())
    return sum(found)


def test_lookups_skip_most_row_groups(spark, tmp_path):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    small = {"parquet.block.size": 200 * 1024, "parquet.page.row.count.limit": 100, "parquet.block.size.row.check.min": 100}
    rows = spark.range(60000).select(
        F.col("id").alias("news_mppg_id"), F.pmod(F.xxhash64("id"), F.lit(1 << 40)).alias("seq"), F.lpad((F.col("id") % 997).cast("string"), 6, "0").alias("etct_cust_no"),
        F.lit("RISK").alias("news_clas"), F.lit("1").alias("doc_sentiment"), F.lit("2026.01.01").alias("basc_dt"), F.md5(F.col("id").cast("string")).alias("news_tite"))
    try:
        for k, v in small.items():
            conf.setInt(k, v)
        serving.export_serving(rows, str(tmp_path / "s"))
    finally:
        for k in small:
            conf.unset(k)
    article = str(rows.where("news_mppg_id = 31234").first().seq)
    by_article = serving.lookup(spark, str(tmp_path / "s"), seq=article)
    assert [r.news_mppg_id for r in by_article.collect()] == ["31234"]
    assert scanned_rows(by_article) < 60000 / 4
    by_customer = serving.lookup(spark, str(tmp_path / "s"), etct_cust_no=["000123", "no such"])
    assert by_customer.count() == 61 and scanned_rows(by_customer) < 60000 / 4
    assert serving.lookup(spark, str(tmp_path / "s"), seq="none", etct_cust_no="000123").count() == 0


def vectors(spark, rows, key, vector):
    return storage.materialize(spark.createDataFrame([(k, v.tolist()) for k, v in rows], f"{key} long, {vector} array<float>"))


def test_approximate_search_finds_most_and_nothing_wrong(spark):
    rng = np.random.default_rng(4)
    items = rng.standard_normal((3000, 48))
    items[1000:2000] = items[0] + 0.01 * rng.standard_normal((1000, 48))  # a third lies together
    asked = items[::3] + 0.3 * rng.standard_normal((1000, 48))
    index, queries = vectors(spark, enumerate(items), "item_key", "item_vec"), vectors(spark, enumerate(asked), "query_key", "query_vec")
    exact = nearest.nearest(queries, index)
    found = approximate.nearest_approximate(queries, index)
    told = approximate.recall(found, exact).first()
    assert told.n == found.count() == 1000 and told.found >= 900
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    cosines = unit(asked) @ unit(items).T
    for r in found.collect():
        assert r.cos == pytest.approx(cosines[r.query_key, r.item_key], abs=1e-5)
    near = approximate.nearest_approximate(queries, index, threshold=0.9)
    assert near.count() == found.where("round(score, 6) >= 0.9").count()


def test_queries_without_a_common_code_are_searched_exactly(spark):
    index = vectors(spark, [(1, np.array([1.0, 0.0]))], "item_key", "item_vec")
    queries = vectors(spark, [(7, np.array([-1.0, 0.01])), (8, np.array([1.0, 0.0]))], "query_key", "query_vec")
    settings = {"tables": 2, "bits": 12, "probes": 0}
    assert {r.query_key for r in approximate.nearest_approximate(queries, index, **settings).collect()} == {7, 8}
    assert {r.query_key for r in approximate.nearest_approximate(queries, index, exact_for_rest=False, **settings).collect()} == {8}
    assert approximate.nearest_approximate(queries, index.limit(0)).count() == 0
    assert approximate.nearest_approximate(queries.limit(0), index).count() == 0


def test_probes_turn_the_least_certain_bits(spark):
    unit = np.random.default_rng(0).standard_normal((50, 16))
    found = approximate.codes(unit, 3, 8, 2, 1).reshape(50, 3, 3)
    assert (found >> 8 == np.arange(3)[None, :, None]).all()
    turned = found[:, :, :1] ^ found[:, :, 1:]
    assert (np.bitwise_count(turned.astype(np.uint32)) == 1).all() and (turned[:, :, 0] != turned[:, :, 1]).all()


def test_tiles_are_bounded_when_many_queries_share_small_cells(spark, monkeypatch):
    queries = spark.range(100_000).select((F.col("id") % 50).cast("int").alias("cell"), F.col("id").alias("query_key"), F.array(F.lit(1.0), (F.col("id") % 7).cast("double")).alias("query_vec"))
    index = spark.range(200).select((F.col("id") % 50).cast("int").alias("cell"), F.col("id").alias("item_key"), F.array(F.lit(1.0), (F.col("id") % 5).cast("double")).alias("item_vec"))

    def sizes(left, right):
        n = pa.array([float(left.num_rows)] * left.num_rows)
        return pa.table({"query_key": left["query_key"], "item_key": left["query_key"], "cos": n, "top": n})

    monkeypatch.setattr(nearest, "_best_in_tile", sizes)
    monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", 2)
    out = nearest.best_in_cells(queries, index, one_cell=True).agg(F.count("*").alias("n"), F.max("cos").alias("most")).first()
    assert out.n == 100_000 and out.most <= nearest.QUERY_ROWS
