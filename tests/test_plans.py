"""Plans of the registered queries: what must not be in any of them, and what must be in some."""

from __future__ import annotations

import os
import re
import time

import pytest
from pyspark.sql import functions as F

from checks.queries import QUERIES
from tidings import storage
from tidings.functions import text
from tidings.operators import dedup, load, matching, serving
from tidings.schema import TARGET_SCHEMA

SF_DIR = "/root/testdata/sf0.001"
# Stages of a whole run are also the stages of these, which repeat runs.
REPEATED = {"resume_run", "serving_after_failed_publish", "dry_run_preview", "daily_run_serving", "stream_target"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executed(spark, run):
    """The plans of all that ``run`` executes, intermediate tables included."""
    store = spark._jsparkSession.sharedState().statusStore()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    before = {e.executionId() for e in _items(store.executionsList())}
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return [e.physicalPlanDescription() for e in _items(store.executionsList()) if e.executionId() not in before]


def _items(seq):
    return [seq.apply(k) for k in range(seq.size())]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", [q for q in QUERIES if q not in REPEATED])
def test_no_product_joins_and_no_one_task_windows(spark, name):
    plans = executed(spark, lambda: QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save())
    assert plans
    for plan in plans:
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
        tree = [m for line in plan.splitlines() if (m := re.search(r"(\w+)[^()]*\((\d+)\)(, Statistics.*)?$", line)) and not line.startswith("(")]
        alone = set(re.findall(r"^\((\d+)\) Exchange\nInput.*\nArguments: SinglePartition", plan, re.M))
        # What comes together in one task is a row per task or per written partition, or a limited number.
        for k, node in enumerate(tree):
            if node[2] in alone:
                below = next(m[1] for m in tree[k + 1 :] if m[1] not in ("Project", "Filter", "AQEShuffleRead", "ShuffleQueryStage", "Sort"))
                assert re.search("Aggregate|Limit", below), (below, plan)


def test_aggregates_combine_before_the_shuffle(spark):
    df = spark.range(10).select(F.lit("k").alias("k"), "id")
    assert "partial_count" in plan_of(dedup.key_counts(df, ["k"]))


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in files.splitlines() if re.search(r"/shuffle_[^/]*$", f)}


def test_a_stored_table_leaves_no_shuffle_files(spark):
    """Nor does one that is stored again; the session's own setting stays, also when a write fails."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, own = _shuffle_files(spark), spark.conf.get(setting)
    df = spark.range(0, 10000, 1, 4).groupBy((F.col("id") % 1000).alias("k")).count()
    for _ in range(2):
        assert sum(r["count"] for r in storage.materialize(df).collect()) == 10000
    deadline = time.monotonic() + 20  # files are removed in the background
    while _shuffle_files(spark) - before and time.monotonic() < deadline:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    with pytest.raises(Exception, match="no such"):
        storage.materialize(spark.range(1).select(F.raise_error(F.lit("no such"))))
    assert spark.conf.get(setting) == own


def test_only_the_wanted_columns_and_days_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "RISK", "1", "2026.01.01"), (2, "RISK", "1", "2026.01.02")],
                                 "seq bigint, news_clas string, doc_sentiment string, basc_dt string")
    load.append_with_ids(spark, rows, path)
    target = storage.read_or_empty(spark, path, TARGET_SCHEMA)
    plan = plan_of(serving.serving_filter(target.where("basc_dt = '2026.01.02'")).select("seq"))
    assert "ReadSchema: struct<seq:bigint,news_clas:string,doc_sentiment:string>" in plan
    assert "PartitionFilters: [isnotnull(basc_dt" in plan


def test_mentions_are_joined_once(spark):
    mentions = text.with_normalized_name(spark.createDataFrame([(1, "a")], "seq bigint, target_company string"),
                                         "target_company", "clean_target_company")
    directory = spark.createDataFrame([("a", 1, "1", "a")], "clean_cust_nm string, n_candidates bigint, cust_no string, cust_nm string")
    hits = spark.createDataFrame([], "clean_target_company string, matched_clean_name string, similarity_score double")
    plan = matching.cascade(mentions, directory, hits)._jdf.queryExecution().optimizedPlan().toString()
    joins_above_mentions = [line for line in plan.splitlines() if "Join Inner" in line and not line.startswith(" ")]
    assert len(joins_above_mentions) <= 1
