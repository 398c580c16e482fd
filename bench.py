"""Time the jobs on one data directory and print one JSON line.

BENCH_SF_DIR   data directory (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_RUNS     timed runs per job after one warm-up; the median counts (default 3)
BENCH_ONLY     comma-separated job names, or ``all`` for every job (default: HEADLINE)
BENCH_SCRATCH  folder for intermediate tables (default: a new one in the system's temporary folder)

A job runs to the end: its result is written to Spark's ``noop`` sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from quern.plans import JOBS
from quern.session import build_session
from quern.sources.staging import scratch


# At least one job of every family.
HEADLINE = """
genre_stats_top3 title_stats genre_above_average release_lag_hist user_rating_scatter tags_per_user ratings_by_month
word_top10 html_word_top10 words_by_entity_sentiment vocabulary doc_term_counts
nb_theta nb_classify nb_per_entity
pearson_with_target lag_matrix acf40 seasonal_parts spectrum39 numeric_histograms
ols_stats trend_by_country regression_metrics fold_lines
macro_metrics roc_curve f_by_threshold
stratified_folds plain_folds head_split md5_shuffle monte_carlo_pi
csv_roundtrip word_count_stream
""".split()


def chosen() -> list[str]:
    only = os.environ.get("BENCH_ONLY", "")
    if only == "all":
        return list(JOBS)
    return [n for n in only.split(",") if n] or HEADLINE


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = chosen()
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        conf={
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="bench-"),
        },
    )
    seconds = {}
    for name in names:
        times = []
        for turn in range(runs + 1):
            with scratch(spark):
                start = time.perf_counter()
                JOBS[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                if turn or not runs:
                    times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
