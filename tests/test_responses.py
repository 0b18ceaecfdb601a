from __future__ import annotations

import json

import pyarrow as pa
import pytest

from tidings.functions import responses
from tidings.operators import inference

FENCE = "`" * 3


def body(**fields):
    return json.dumps({"results": {"id": 1, "classification": "essential", "category": "RISK", "summary": "s", **fields}})


GOOD = body(company_names=["A", "B"])

CASES = [
    (GOOD, "ok", ["A", "B"], "RISK"),
    (f"{FENCE}json\n{GOOD}\n{FENCE}", "ok", ["A", "B"], "RISK"),
    (GOOD[:-1], "repaired", ["A", "B"], "RISK"),
    (GOOD[:-2], "repaired", ["A", "B"], "RISK"),
    ('{"results":{"company_names":["A"', "failed", [], None),
    ("{'results':{}}", "failed", [], None),
    ('{"results":null}', "ok", [], None),
    ('{"results":[1]}', "ok", [], None),
    ("{}", "ok", [], None),
    ("[1, 2]", "ok", [], None),
    ("not json", "failed", [], None),
    (body(company_names=None), "ok", [], "RISK"),
    (body(company_names="['A', 'B']"), "ok", ["A", "B"], "RISK"),
    (body(company_names="A"), "ok", [], "RISK"),
    (body(company_names=["A", None, 5]), "ok", ["A", None, "5"], "RISK"),
    ("Failure: API calling: timeout", "call_error", [], None),
    ("", "call_error", [], None),
    (None, "call_error", [], None),
]


def test_responses(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, raw_content string")
    got = {r.i: r for r in responses.parse_responses(df).collect()}
    for i, (raw, status, names, category) in enumerate(CASES):
        r = got[i]
        assert (r.parse_status, r.company_names, r.category) == (status, names, category), raw
        if status == "call_error":
            assert r.llm_error == (raw if raw is not None else "None")
        else:
            assert r.llm_error is None


def test_one_failed_call_spoils_only_its_row(spark):
    def reply(prompt):
        if "bad" in prompt:
            raise ValueError("broken")
        return '{"results":{"company_names":["A"],"classification":"essential","category":"RISK","summary":"s"}}'

    schema = "seq bigint, site_name string, basc_dt string, title string, content string, doc_sentiment string"
    df = spark.createDataFrame(
        [(1, "s", "20260105", "good", "c", None), (2, "s", "20260105", "bad", "c", None), (1, "s", "20260105", "good", "c", None)],
        schema,
    )
    out = inference.extract_articles(df, reply, concurrency=2).orderBy("seq").collect()
    assert [r.seq for r in out] == [1, 1, 2]  # a repeated number does not multiply rows
    assert out[0].company_names == ["A"] and out[0].reference == "[s]. good. 2026.01.05"
    assert out[2].llm_error == "Failure: API calling: broken" and out[2].parse_status == "call_error"


def test_unknown_slot_falls_back_to_the_default_prompt(spark):
    df = spark.createDataFrame([(1, "d", "t", "c")], "seq bigint, basc_dt string, title string, content string")
    assert df.select(inference.article_prompt("{nothing}").alias("p")).first().p.startswith("Which companies")


def test_calls_are_spread_and_bounded(spark):
    from pyspark import TaskContext

    prompts = spark.range(60).selectExpr("concat('p', id) AS prompt").coalesce(1)
    lock_free = spark.sparkContext.accumulator(0)

    def call(prompt):
        import threading
        import time

        lock_free.add(1)
        time.sleep(0.02)
        here = sum(t.name.startswith("ThreadPoolExecutor") for t in threading.enumerate())
        return f"{TaskContext.get().partitionId() if TaskContext.get() else -1} {here}"

    out = inference.complete(prompts, "prompt", call, concurrency=8, tasks=4)
    assert out.rdd.getNumPartitions() == 4
    most = max(int(r.raw_content.split()[1]) for r in out.collect())
    assert most <= 2 and lock_free.value == 60  # eight calls over four tasks
    assert inference.complete(prompts, "prompt", call, concurrency=3, tasks=100).rdd.getNumPartitions() == 3


def test_many_short_names_are_embedded_in_all_tasks(spark):
    from pyspark import TaskContext

    names = spark.range(80000).selectExpr("concat('n', id) AS t").coalesce(1)
    encode = lambda texts: [[float(TaskContext.get().partitionId())]] * len(texts)
    rows = inference.embed(names, "t", encode, "e", tasks=16).select("embedding").collect()
    sizes = [sum(r.embedding[0] == k for r in rows) for k in range(16)]
    assert sum(sizes) == 80000 and min(sizes) > 4000


def test_windows_of_a_long_text_all_count(rows):
    encode = lambda texts: [[float(len(t)), float(t.count("x"))] for t in texts]
    df = rows("t string", ("x" * 10 + "y" * 5,), ("",), (None,))
    got = [list(r.embedding) for r in inference.embed(df, "t", encode, "e", window_chars=10, tasks=1).collect()]
    assert sorted(got) == [[0.0, 0.0], [0.0, 0.0], [pytest.approx((10 * 10 + 5 * 5) / 15), pytest.approx(100 / 15)]]


@pytest.mark.parametrize("batch_size", [1, 2, 64])
def test_embedding_batches(spark, batch_size):
    def encode(texts):
        assert len(texts) <= batch_size
        return [[float(len(t)), 1.0] for t in texts]

    df = spark.createDataFrame([(i, "x" * i if i else None) for i in range(5)], "i int, t string").coalesce(1)
    out = inference.embed(df, "t", encode, "len", batch_size=batch_size).orderBy("i").collect()
    assert [r.embedding for r in out] == [[float(i), 1.0] for i in range(5)]
    assert {r.encoder_id for r in out} == {"len"}


def test_a_batch_becomes_strings_by_and_by():
    batch = pa.array([None if k % 7 == 0 else str(k) for k in range(1000)])
    (whole, parts), = inference._slices(iter([batch]), 256)
    parts = iter(parts)
    first = next(parts)
    assert whole is batch and len(first) == 256 and first[:2] == [None, "1"]
    assert first + [t for part in parts for t in part] == batch.to_pylist()
    assert [list(parts) for _, parts in inference._slices(iter([batch[:0]]), 256)] == [[]]


def test_answers_stay_with_their_prompts_over_many_slices(spark):
    import threading

    def call(prompt):
        if prompt is None:
            return None
        if prompt.endswith("9"):
            raise TimeoutError(prompt)
        return f"{prompt} {threading.get_ident()}"

    prompts = spark.range(3000).selectExpr("id", "if(id % 10 = 4, null, cast(id as string)) AS prompt")
    out = inference.complete(prompts, "prompt", call, concurrency=6, tasks=2).collect()
    assert len(out) == 3000
    for r in out:
        if r.id % 10 == 4:
            assert r.prompt is None and r.raw_content is None
        elif r.id % 10 == 9:
            assert r.raw_content == f"Failure: API calling: {r.id}"
        else:
            assert r.raw_content.startswith(f"{r.id} ")


def test_vectors_of_no_rows_and_of_differing_length(spark):
    encode = lambda texts: [[float(len(t))] * 3 for t in texts]
    assert inference.embed(spark.createDataFrame([], "t string"), "t", encode, "e", tasks=2).collect() == []
    df = spark.range(700).selectExpr("id", "repeat('x', cast(id % 5 as int)) AS t")
    got = inference.embed(df, "t", encode, "e", tasks=1).collect()
    assert len(got) == 700 and all(list(r.embedding) == [float(r.id % 5)] * 3 for r in got)
