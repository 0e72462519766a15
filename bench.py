"""Benchmark the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

First the forum tables are derived from the base tables and stored once
(``ingest_sec``, the dump-conversion step). Each query is then executed with
the ``noop`` sink (full execution, no transfer to the driver), three times;
the fastest run counts, after one untimed warm-up pass over the whole list.
``value`` is the sum over the queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from forumlens.plans.registry import queries  # noqa: E402
from forumlens.session import get_session  # noqa: E402
from forumlens.sources.adapters import ForumData  # noqa: E402

HEADLINE = [
    "q1_top_authors", "q2_positive_answers", "q3_top_question_per_year", "q4_accepted_gap",
    "q5_author_comments", "q6_rare_badge_users", "q7_old_votes_conditional",
    "t4_series_wide", "t5_topics_series",
]


def run_once(spark, fn, sf_dir) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(2 * cpus, 8),
                        app_name="forumlens-bench")
    qs = queries()
    t0 = time.perf_counter()
    ForumData(spark, sf_dir).materialize_all()
    ingest = round(time.perf_counter() - t0, 3)
    for name in HEADLINE:  # warm-up: JIT, file listings, Python imports
        run_once(spark, qs[name], sf_dir)
    times = {}
    for name in HEADLINE:
        times[name] = round(min(run_once(spark, qs[name], sf_dir) for _ in range(3)), 3)
    sf = os.path.basename(sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": sf[2:] if sf.startswith("sf") else sf,
        "cpus": cpus, "ingest_sec": ingest, "stat": "best of 3 after warm-up, noop sink",
    }))
    spark.stop()


if __name__ == "__main__":
    main()
