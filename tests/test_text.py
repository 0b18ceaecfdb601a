from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidings.functions import text

NAMES = [
    ("(주)LG전자", "엘지전자"), ("LG", "엘지"), ("SK", "에스케이"),
    ("Samsung Electronics Co., Ltd.", "samsungelectronics"), ("㈜한화", "㈜한화"), ("KT&G", "kt&g"),
    ("주식회사 OO", "오오"), ("(주)", ""), (None, ""), ("ABCD", "abcd"), ("3M", "3엠"),
]


def values(df, column):
    return [r[column] for r in df.collect()]


def test_company_names(rows):
    df = rows("name string", *[(n,) for n, _ in NAMES])
    assert values(df.select(text.normalize_company_name("name").alias("c")), "c") == [c for _, c in NAMES]
    assert values(text.with_normalized_name(df, "name", "c"), "c") == [c for _, c in NAMES]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="가나다라마바사아자차카타파하", max_size=8), min_size=1, max_size=20))
def test_hangul_names_stay_as_they_are(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "name string")
    assert values(df.select(text.normalize_company_name("name").alias("c")), "c") == names


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("20260105", "2026.01.05"), ("2026.01.05", "2026.01.05"), ("2026.1.5", "2026.01.05"),
        ("2026-01-05", "2026-01-05"), ("20261305", "20261305"), ("2026111", "2026111"), ("", ""), (None, None),
    ],
)
def test_dates(rows, raw, expected):
    assert rows("d string", (raw,)).select(text.normalize_date("d").alias("o")).first().o == expected


@pytest.mark.parametrize(
    "raw, number, whole",
    [
        ("12", 12.0, 12), (" 12 ", 12.0, 12), ("1.9", 1.9, 1), ("-1.9", -1.9, -1), ("1e3", 1000.0, 1000),
        ("12d", None, None), ("x", None, None), ("", None, None), (None, None, None),
        ("9007199254740993", 9007199254740992.0, 9007199254740993),
    ],
)
def test_numbers(rows, raw, number, whole):
    r = rows("s string", (raw,)).select(text.to_number("s").alias("n"), text.to_long("s").alias("l")).first()
    assert (r.n, r.l) == (number, whole)


def test_same_number(rows):
    df = rows("a string, b string", ("1", "1.0"), ("9007199254740993", "9007199254740992"), ("x", "x"), ("2", None))
    assert values(df.select(text.same_number("a", "b").alias("o")), "o") == [True, False, None, None]


def test_long_keys_are_exact(rows):
    df = rows("a string, b string", ("1000000000000000001", "1000000000000000002"), ("1000000000000000001", " +01000000000000000001 "),
              ("9" * 30, "9" * 29 + "8"), ("9" * 30, "9" * 30), ("0", "-0"), ("-7", "7"), ("007", "7.0"))
    assert values(df.select(text.same_number("a", "b").alias("o")), "o") == [False, True, False, True, True, False, True]
    assert values(df.select(text.to_long("a").alias("o")), "o")[:3] == [1000000000000000001, 1000000000000000001, None]


def test_each_letter_is_read_as_written(rows):
    readings = ["에이", "비", "씨", "디", "이", "에프", "지", "에이치", "아이", "제이", "케이", "엘", "엠", "엔", "오", "피", "큐", "알", "에스",
                "티", "유", "브이", "더블유", "엑스", "와이", "제트"]
    df = rows("s string", *((f"{chr(65 + k)}가",) for k in range(26)), ("(주)가",), ("주식회사 가",), ("가 Inc.",), ("가 Co., Ltd.",))
    assert values(df.select(text.normalize_company_name("s").alias("o")), "o") == [r + "가" for r in readings] + ["가"] * 4


def test_blank_and_strip(rows):
    df = rows("s string", (None,), ("",), ("  ",), ("　\t\n",), (" a ",))
    assert values(df.select(text.is_blank("s").alias("o")), "o") == [True, True, True, True, False]
    assert values(df.select(text.strip("s").alias("o")), "o") == [None, "", "", "", "a"]


def test_reference_and_newlines(rows):
    df = rows("site string, title string, d string", ("s", "t", "2026.01.05"), (None, None, None))
    assert values(df.select(text.reference_text("title", "d", "site").alias("o")), "o") == [
        "[s]. t. 2026.01.05", "[None]. None. None",
    ]
    assert values(df.select(text.reference_text("title", "d").alias("o")), "o") == ["t. 2026.01.05", "None. None"]
    flat = rows("s string", ("a\r\nb\nc",), (None,)).select(text.flatten_newlines("s").alias("o"))
    assert values(flat, "o") == ["a  b c", None]


def test_contexts(rows):
    long = "x" * 700
    df = rows("title string, content string", ("t", long))
    assert df.select(text.article_context("title", "content").alias("o")).first().o == "t " + long
    companies = rows("i string, p string, n string", ("a", "b", "n"), (None, "b", "n"), ("", "", "n"), (None, None, "n"))
    assert values(companies.select(text.company_context("i", "p", "n").alias("o")), "o") == ["a b", "b", "n", "n"]


def test_prompt_template(rows):
    df = rows("seq bigint, t string", (7, "x"), (8, None))
    out = df.select(text.render_prompt("{{id}} {Id}: {title}\n", Id="seq", title="t").alias("o"))
    assert values(out, "o") == ["{id} 7: x\n", "{id} 8: None\n"]
    with pytest.raises(KeyError):
        text.render_prompt("{other}", Id=F.lit(1))
