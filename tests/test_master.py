from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidings.operators import dedup, master
from tidings.schema import NAME_VECTOR_SCHEMA

HISTORY = "cust_no string, cust_nm string, sglr_ases_modl_clas_cd_nm string, std_inds_clas_nm string, primy_prod_nm string, lst_ases_dt string"


def test_latest_record(rows):
    df = rows(
        HISTORY,
        ("1", "old", "M", "i", "p", "20250101"), ("1", "new", "M", "i", "p", "20260101"),
        ("2", "b", "M", "i", "p", "20260101"), ("2", "a", "M", "i", "p", "20260101"),
        ("3", "undated", "M", "i", "p", "N/A"), (None, "nobody", "M", "i", "p", "20260101"),
        ("", "empty", "M", "i", "p", " 20260101 "),
    )
    got = {r.cust_no: (r.cust_nm, r.lst_ases_dt) for r in master.latest_per_customer(df).collect()}
    assert got == {"1": ("new", "20260101"), "2": ("a", "20260101"), "": ("empty", "20260101")}
    assert master.company_columns(df).columns == [
        "cust_no", "cust_nm", "sglr_ases_modl_clas_cd", "std_inds_clas_nm", "primy_prod_nm",
    ]


def test_rank_filter_runs_before_the_shuffle(rows):
    df = rows(HISTORY, ("1", "a", "M", "i", "p", "20250101"))
    plan = master.latest_per_customer(df)._jdf.queryExecution().executedPlan().toString()
    below_exchange = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below_exchange and "Partial" in below_exchange


def test_a_date_is_parsed_once(rows):
    df = rows(HISTORY, ("1", "a", "M", "i", "p", "N/A"), ("1", "b", "M", "i", "p", None), ("2", "a", "M", "i", "p", "N/A"), ("2", "c", "M", "i", "p", "7"))
    newest = master.latest_per_customer(df)
    assert [(r.cust_no, r.cust_nm, r.lst_ases_dt) for r in newest.collect()] == [("2", "c", "7")]
    assert newest._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") == 1


def test_directory_keeps_the_first_of_a_shared_name(rows):
    df = rows("cust_no string, cust_nm string", ("2", "A Inc."), ("1", "a"), ("3", "B"), (None, "B"))
    got = {r.clean_cust_nm: (r.n_candidates, r.cust_no, r.cust_nm) for r in master.name_directory(master.with_clean_name(df)).collect()}
    assert got == {"에이": (2, "1", "a"), "비": (1, "3", "B")}


def test_fingerprint_depends_on_the_set_only(rows):
    key = lambda *nos: master.fingerprint(rows("cust_no string", *[(n,) for n in nos])).first().fingerprint
    assert key("1", "2", "3") == key("3", "1", "2")
    assert key("1", "2") != key("1", "3") and key("1", "2").startswith("2:")
    assert key("1", "1") != key("2", "2")
    assert master.fingerprint(rows("cust_no string", ("1",)).limit(0)).first().fingerprint == "0:0:0"


def test_only_new_names_are_embedded_and_old_vectors_survive_a_failure(spark, rows):
    companies = master.with_clean_name(rows("cust_no string, cust_nm string", ("1", "ABCD"), ("2", "EFGH"), ("3", "EFGH Inc.")))
    stored = spark.createDataFrame([("abcd", [1.0], "e")], NAME_VECTOR_SCHEMA)
    saved = []
    save = lambda df: saved.extend(df.collect())
    assert master.refresh_name_vectors(companies, stored, lambda t: [[2.0]] * len(t), "e", save)
    assert [(r.clean_cust_nm, r.encoder_id) for r in saved] == [("efgh", "e")]

    def broken(texts):
        raise ConnectionError("down")

    assert not master.refresh_name_vectors(companies, stored, broken, "e", save)
    with pytest.raises(Exception, match="down"):
        master.refresh_name_vectors(companies, stored, broken, "another", save)
    with pytest.raises(Exception, match="down"):
        master.refresh_name_vectors(companies, stored, broken, "e", save, on_failure="raise")

    def unwritable(df):
        raise PermissionError("no space")

    with pytest.raises(PermissionError):  # not the encoder's failure
        master.refresh_name_vectors(companies, stored, lambda t: [[2.0]] * len(t), "e", unwritable)


def test_duplicate_flags_include_null_keys_and_hot_keys(spark):
    hot = spark.range(3000).select(F.lit(1).alias("k"), "id")
    rest = spark.range(6000).select((F.col("id") + 10).cast("int").alias("k"), "id")
    nulls = spark.createDataFrame([(None, 1), (None, 2)], "k int, id bigint")
    flagged = dedup.flag_duplicates(hot.unionByName(rest).unionByName(nulls), ["k"])
    got = {(r.k if r.k in (1, None) else "rest", r.is_duplicate): r.n for r in flagged.groupBy(
        F.when(F.col("k") < 10, F.col("k")).when(F.col("k").isNull(), None).otherwise(-1).alias("k"), "is_duplicate"
    ).agg(F.count("*").alias("n")).collect()}
    assert got == {(1, True): 3000, ("rest", False): 6000, (None, True): 2}


def test_keep_first_is_by_order(rows):
    df = rows("k int, o int", (1, 2), (1, 1), (2, 5))
    assert sorted(tuple(r) for r in dedup.keep_first(df, ["k"], ["o"]).collect()) == [(1, 1), (2, 5)]
    assert [tuple(r) for r in dedup.duplicate_keys(df, ["k"]).collect()] == [(1, 2)]
