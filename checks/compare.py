"""Run queries in Spark and their SQL in DuckDB, and compare the rows.

``python -m checks.compare [sf_dir] [query ...]``
"""

from __future__ import annotations

import os
import sys
import tempfile
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from .oracles import ORACLES
from .queries import QUERIES
from .views import TABLES


def session(cpus: int = 8) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidings")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", os.environ.get("SCRATCH_DIR") or tempfile.mkdtemp(prefix="tidings-"))
        .getOrCreate()
    )


def _value(v):
    return float(v) if type(v).__name__ in ("Decimal", "float") else v


def expected(sf_dir: str, name: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    result = con.execute(ORACLES[name])
    return [d[0] for d in result.description], result.fetchall()


def differences(spark: SparkSession, sf_dir: str, name: str, times: dict[str, float] | None = None) -> list[str]:
    """What is wrong with a query; an empty list when rows and columns agree."""
    times = {} if times is None else times
    clock = time.monotonic()
    df = QUERIES[name](spark, sf_dir)
    got_rows = df.collect()
    times["spark"] = time.monotonic() - clock
    names, want_rows = expected(sf_dir, name)
    times["sql"] = time.monotonic() - clock - times["spark"]
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} instead of {sorted(names)}"]
    order = [names.index(c) for c in df.columns]
    got = Counter(tuple(_value(v) for v in r) for r in got_rows)
    want = Counter(tuple(_value(r[i]) for i in order) for r in want_rows)
    out = []
    if got != want:
        out.append(f"{sum(got.values())} rows, expected {sum(want.values())}")
        out += [f"  extra   {str(r)[:300]}" for r in list((got - want))[:3]]
        out += [f"  missing {str(r)[:300]}" for r in list((want - got))[:3]]
    elif not want:
        out.append("no rows to compare")
    return out


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in argv[1:] or QUERIES:
        times: dict[str, float] = {}
        try:
            wrong = differences(spark, sf_dir, name, times) if name in ORACLES else ["no SQL"]
        except Exception as error:  # report and go on with the next query
            wrong = [f"{type(error).__name__}: {str(error)[:1500]}"]
        failed += bool(wrong)
        print(f"{'FAIL' if wrong else 'ok  '} {name} {' '.join(f'{k} {v:.1f}s' for k, v in times.items())}", *wrong, sep="\n" if wrong else " ", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]) > 0)
