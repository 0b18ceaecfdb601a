"""Time the headline queries and print one JSON line.

The first query runs once untimed, so that starting the JVM's code generation is not counted.

Settings: ``BENCH_SF_DIR``, ``BENCH_CPUS`` and, to choose queries, ``BENCH_QUERIES`` (comma separated).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.compare import session  # noqa: E402
from checks.queries import QUERIES  # noqa: E402

HEADLINE = [
    "company_mentions", "incremental_news", "delimited_scan", "stream_incremental", "latest_per_key",
    "normalize_name", "llm_response_parse", "batch_inference", "embed_texts", "exact_name_match",
    "vector_top1", "vector_threshold", "cascade_match", "homonym_resolve", "duplicate_flag",
    "dedup_keep_first", "serving_export", "append_with_ids", "row_chunks", "daily_run",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    names = os.environ.get("BENCH_QUERIES")
    spark = session(int(os.environ.get("BENCH_CPUS", "8")))
    spark.sparkContext.setLogLevel("ERROR")
    chosen = names.split(",") if names else HEADLINE
    QUERIES[chosen[0]](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in chosen:
        start = time.monotonic()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.monotonic() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
