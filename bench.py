"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is executed in full with the no-op sink (every row produced, nothing collected); after
one untimed warm-up run of the whole set, each is timed $BENCH_REPEATS times (default 3) and the
median is reported. ``full_job`` runs the whole session job
(filtered sessions and their actions materialised once, five results written to the no-op sink).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from visitlens.plans import queries as Q  # noqa: E402
from visitlens.plans.job import SessionJob, SessionPlans, run  # noqa: E402
from visitlens.session import build_session  # noqa: E402
from visitlens.sinks import ResultSink  # noqa: E402

HEADLINE = [
    "action_scan",
    "session_aggregate",
    "session_filter_all",
    "session_aggr_stat",
    "session_detail",
    "random_extract",
    "random_extract_detail",
    "category_counts",
    "top10_category",
    "top10_session",
    "top10_session_detail",
    "label_counts",
    "word_count",
]


class NoopSink(ResultSink):
    def write(self, df, name):
        df.write.format("noop").mode("overwrite").save()


def full_job(spark, data_dir):
    job = SessionJob(Q.PARAMS["main"], task_id=Q.TASK_ID, sample_total=Q.SAMPLE_TOTAL, seed=Q.SEED)
    run(SessionPlans.from_test_tables(spark, data_dir, job, materialize_mode="persist"), NoopSink())


def main() -> None:
    data_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(
        "visitlens-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=2 * cpus,
        conf={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")},
    )

    def run_query(name):
        if name == "full_job":
            full_job(spark, data_dir)
        else:
            Q.QUERIES[name](spark, data_dir).write.format("noop").mode("overwrite").save()

    names = HEADLINE + ["full_job"]
    errors = {}
    for name in names:  # warm-up: JIT, file listing, codegen caches
        try:
            run_query(name)
        except Exception as exc:  # a failing query is reported, not allowed to hide the others
            errors[name] = f"{type(exc).__name__}: {str(exc)[:300]}"
    names = [n for n in names if n not in errors]
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    samples = {name: [] for name in names}
    for _ in range(repeats):
        for name in names:
            spark.catalog.clearCache()  # nothing is served from an earlier run
            t0 = time.perf_counter()
            run_query(name)
            samples[name].append(time.perf_counter() - t0)
    timings = {name: round(statistics.median(v), 3) for name, v in samples.items()}
    match = re.search(r"sf([0-9.]+)", data_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(match.group(1)) if match else None,
                "cpus": cpus,
                "repeats": repeats,
                "errors": errors,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
