from __future__ import annotations

import pytest

from tidings import storage
from tidings.operators.state import load_cursor
from tidings.plans import daily
from tidings.schema import TARGET_COLUMNS, TARGET_SCHEMA
from tidings.sources.delimited import FIELD_SEP
from tidings.streaming import incremental

NEWS_HEAD = ["seq", "p_seq", "channel", "site_name", "basc_dt", "title", "content", "doc_sentiment", "part_basc_dt"]
COMPANY_HEAD = ["cust_no", "cust_nm", "sglr_ases_modl_clas_cd_nm", "std_inds_clas_nm", "primy_prod_nm", "lst_ases_dt"]

COMPANIES = [
    ("001", "알파전자", "M1", "electronics", "phones", "20250101"),
    ("001", "알파전자", "M1", "electronics", "phones and chips", "20260101"),
    ("002", "(주)알파전자", "M2", "food", "noodles", "20260101"),
    ("003", "Beta Motors", "M3", "cars", "trucks", "20260101"),
]


def news(*rows):
    return [(str(n), str(n), "NEWS", "site", day, title, content, "1", day) for n, day, title, content in rows]


DAY_ONE = news(
    (1, "20260105", "알파전자", "electronics phones and chips are selling"),
    (2, "20260105", "알파전자", "food noodles are cooking"),
    (3, "20260105", "Beta Motors Inc.,Beta Motors", "cars"),
    (4, "20260106", "Beta Motorz", "cars again"),
    (5, "20260106", "nobody knows it", "x"),
    (6, "20260106", "noise", "x"),
    (7, "20260106", "fail", "x"),
)


def put(path, head, rows):
    path.write_text("||".join(FIELD_SEP.join(r) for r in [head, *rows]), encoding="utf-8")


@pytest.fixture
def setting(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def reply(prompt):
        import json

        calls.add(1)
        title = prompt.split("Title: ")[1].split("\n")[0]
        if title == "fail":
            raise TimeoutError("slow")
        kind = "noise" if title == "noise" else "essential"
        names = ["알파전자"] if kind == "noise" else title.split(",")
        return json.dumps({"results": {"company_names": names, "classification": kind, "category": "RISK", "summary": "s"}})

    put(tmp_path / "news.csv", NEWS_HEAD, DAY_ONE)
    put(tmp_path / "company.csv", COMPANY_HEAD, COMPANIES)
    layout = daily.Layout(str(tmp_path / "out"))

    models = daily.Models(reply)

    def run(run_dt="20260106", **kwargs):
        return daily.run_daily(
            spark, layout, str(tmp_path / "news.csv"), str(tmp_path / "company.csv"), models, run_dt,
            **{"remove_input": False, "threshold": 0.6, **kwargs},
        )

    run.models = models
    return run, layout, calls, tmp_path


def loaded(spark, layout):
    return sorted(
        (r.news_mppg_id, r.seq, r.etct_cust_no, r.primy_prod_nm)
        for r in storage.read_or_empty(spark, layout.target, TARGET_SCHEMA).collect()
    )


EXPECTED = [(1, 1, "001", "phones and chips"), (2, 2, "002", "noodles"), (3, 3, "003", "trucks"), (4, 4, "003", "trucks")]


def test_run_resume_and_next_day(spark, setting):
    run, layout, calls, folder = setting
    summary = run()
    assert loaded(spark, layout) == EXPECTED
    assert (summary.loaded, summary.extracted, summary.mapped, summary.appended) == (7, 6, 4, 4)
    assert load_cursor(spark, layout.state) == (7, "20260106")
    made = calls.value
    assert made >= 7

    # The same run again finds its stages: nothing is asked or loaded twice.
    assert run().appended == 0
    assert calls.value == made and loaded(spark, layout) == EXPECTED

    # The next day's file repeats old articles and brings one new one.
    put(folder / "news.csv", NEWS_HEAD, DAY_ONE + news((9, "20260107", "Beta Motors", "cars")))
    assert run("20260107", remove_input=True).appended == 1
    assert loaded(spark, layout) == [*EXPECTED, (5, 9, "003", "trucks")]
    assert calls.value == made + 1
    assert not (folder / "news.csv").exists() and not (folder / "company.csv").exists()
    serving = spark.read.parquet(layout.serving)
    assert sorted(int(r.news_mppg_id) for r in serving.collect()) == [1, 2, 3, 4, 5]
    assert set(serving.columns) == set(TARGET_COLUMNS)

    # No new article: an early end that changes nothing.
    put(folder / "news.csv", NEWS_HEAD, DAY_ONE)
    put(folder / "company.csv", COMPANY_HEAD, COMPANIES)
    assert run("20260108").loaded == 0
    assert load_cursor(spark, layout.state) == (9, "20260107")

    # The file comes late on the same day.
    put(folder / "news.csv", NEWS_HEAD, news((10, "20260108", "Beta Motors", "cars")))
    assert run("20260108").appended == 1

    # Repeating an old day changes nothing.
    assert run("20260106").appended == 0
    assert load_cursor(spark, layout.state) == (10, "20260108")


def test_stream_and_batch_load_the_same(spark, setting):
    run, layout, _, folder = setting
    run()
    feed = folder / "feed"
    feed.mkdir()
    put(feed / "1.csv", NEWS_HEAD, DAY_ONE[:3])
    put(feed / "2.csv", NEWS_HEAD, DAY_ONE[2:])  # files overlap in article 3
    other = daily.Layout(str(folder / "streamed"))

    def take(run_dt):
        return incremental.run_daily_stream(
            spark, other, str(feed), NEWS_HEAD, str(folder / "company.csv"), run.models, run_dt,
            max_files_per_trigger=1, threshold=0.6, remove_input=False,
        )

    first = take("20260106")
    assert (first.appended, first.bad_records, first.late) == (4, 0, 0)
    assert loaded(spark, other) == loaded(spark, layout)
    put(feed / "3.csv", NEWS_HEAD, DAY_ONE + news((9, "20260107", "Beta Motors", "cars")))
    second = take("20260107")
    assert (second.appended, second.bad_records, second.late) == (1, 0, len(DAY_ONE))
    assert take("20260108").loaded == 0


def test_crash_between_append_and_cursor_loads_nothing_twice(spark, setting, monkeypatch):
    run, layout, _, _ = setting

    def crash(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(daily, "save_cursor", crash)
        with pytest.raises(RuntimeError, match="lost"):
            run()
    assert load_cursor(spark, layout.state) == (0, "20260101")
    assert run("20260107").appended == 0
    assert loaded(spark, layout) == EXPECTED and load_cursor(spark, layout.state) == (7, "20260106")


def served(spark, layout):
    return sorted(int(r.seq) for r in spark.read.parquet(layout.serving).collect())


@pytest.mark.parametrize("empty", [False, True])
def test_a_later_run_publishes_what_a_failed_one_left_out(spark, setting, monkeypatch, empty):
    run, layout, _, folder = setting
    run()
    put(folder / "news.csv", NEWS_HEAD, news((8, "20260107", "Beta Motors", "cars")))

    def crash(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(daily, "export_serving", crash)
        with pytest.raises(RuntimeError, match="lost"):
            run("20260107")
    assert served(spark, layout) == [1, 2, 3, 4]
    put(folder / "news.csv", NEWS_HEAD, DAY_ONE if empty else news((9, "20260108", "Beta Motors", "cars")))
    assert run("20260108").loaded == (0 if empty else 1)
    assert served(spark, layout) == [1, 2, 3, 4, 8] + [9] * (not empty)
    assert run("20260109").served == 0


def test_input_that_no_run_has_read_stays(spark, setting):
    run, layout, _, folder = setting
    run(remove_input=True)
    assert not (folder / "news.csv").exists()
    # A second file on a day whose stages are stored: not read, so not deleted, and loaded by the next run.
    put(folder / "news.csv", NEWS_HEAD, news((20, "20260106", "Beta Motors", "cars")))
    put(folder / "company.csv", COMPANY_HEAD, COMPANIES)
    assert run(remove_input=True).appended == 0
    assert (folder / "news.csv").exists() and (folder / "company.csv").exists()
    assert run("20260107", remove_input=True).appended == 1
    assert not (folder / "news.csv").exists() and served(spark, layout)[-1] == 20


def test_counts_and_settings_of_a_run(spark, setting):
    run, layout, _, folder = setting
    text = (folder / "news.csv").read_text(encoding="utf-8")
    (folder / "news.csv").write_text(text + "||cut off||9", encoding="utf-8")
    summary = run()
    assert (summary.bad_records, summary.late, summary.refreshed) == (2, 0, True)
    assert (summary.considered, summary.served) == (4, 4)
    assert run().bad_records is None
    with pytest.raises(ValueError, match="threshold"):
        run(threshold=0.7)
    put(folder / "news.csv", NEWS_HEAD, DAY_ONE + news((9, "20260107", "Beta Motors", "cars")))
    assert run("20260107", threshold=0.7).late == 7


def test_dry_run_previews_and_changes_nothing(spark, setting):
    run, layout, _, folder = setting
    summary = run(dry_run=True, remove_input=True)
    preview = summary.preview.collect()
    assert [(r.seq, r.etct_cust_no) for r in preview] == [(1, "001"), (2, "002"), (3, "003"), (4, "003")]
    assert summary.preview.columns == daily.PREVIEW_COLUMNS and summary.appended == 0
    assert not (folder / "out").exists() and (folder / "news.csv").exists()


def test_names_are_looked_for_only_where_digests_changed(spark, setting, monkeypatch):
    run, layout, _, folder = setting
    asked = []
    real = daily.refresh_name_vectors

    def seen(names, *args, **kwargs):
        asked.append(sorted(r.clean_cust_nm for r in names.collect()))
        return real(names, *args, **kwargs)

    monkeypatch.setattr(daily, "refresh_name_vectors", seen)
    assert run().refreshed and len(asked) == 1 and len(asked[0]) == 2
    put(folder / "news.csv", NEWS_HEAD, news((10, "20260107", "Beta Motors", "cars")))
    assert run("20260107").refreshed and len(asked) == 1  # equal roots
    put(folder / "company.csv", COMPANY_HEAD, [*COMPANIES, ("004", "Gamma Ships", "M1", "ships", "tugs", "20260101")])
    put(folder / "news.csv", NEWS_HEAD, news((11, "20260108", "Gamma Ships", "tugs")))
    assert run("20260108").appended == 1
    assert asked[1:] == [["gammaships"]]
