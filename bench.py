"""Benchmark: the daily job and the headline queries, one JSON line on stdout.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS
(timed runs per query after one warm-up, default 3; the median counts), BENCH_ONLY (names,
comma separated, or `all`; by default the headline queries).
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from roadpulse.plans import bindings, jobs
from roadpulse.plans.queries import QUERIES
from roadpulse.session import local_session
from roadpulse.sinks.keyed import BATCH
from pyspark.sql import functions as F

RUN = "ejecucion_20240131_000000"
# The nine result tables, and one or two queries of every other family of operators.
HEADLINE = """peak_hours alerts_by_city alerts_by_type quarantine_false accidents_by_city
alerts_by_street accidents_by_street_city longest_jams jams_by_city dedup_alerts dedup_jams
clean_funnel unnest_feed dup_file_summary repeated_instances insert_if_absent top10_alert_streets
surrogate_key tagged_lookup request_outcomes request_summary ttl_first_seen_by_type assign_cell
sample_zipf arrival_times normalize_cities feed_lenient index_counts lookup_jams result_documents
ingest_accounting sample_normal""".split()


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def timed(action, runs: int) -> float:
    action()
    return round(statistics.median(seconds(action) for _ in range(runs)), 4)


def daily_job(spark, sf_dir: str, runs: int) -> float:
    """Stored documents -> staged -> clean -> alert cube -> nine result tables, all written."""
    base = tempfile.mkdtemp(prefix="roadpulse-bench-")
    for kind, rows in (("alertas", bindings.alert_documents(spark, sf_dir).withColumn("pos", F.col("seq"))),
                       ("atascos", bindings.jam_documents(spark, sf_dir).withColumn("pos", F.lit(0)))):
        rows.withColumns({"file": F.lit("f"), "cell": F.lit(0), BATCH: F.lit(0)}).write.partitionBy(
            BATCH).parquet(f"{base}/store/{kind}")

    def job() -> None:
        jobs.clean(spark, f"{base}/store", f"{base}/clean", RUN)
        jobs.rank(spark, f"{base}/clean", f"{base}/results", RUN)

    return timed(job, runs)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [name for name in os.environ.get("BENCH_ONLY", "").split(",") if name]
    names = list(QUERIES) if only == ["all"] else only or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    headline = daily_job(spark, sf_dir, runs)
    times = {}
    for name in names:
        # building is part of the run: some operators materialise on the way
        times[name] = timed(
            lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save(), runs)
    print(json.dumps({
        "metric": "daily job: clean, then nine result tables (median of warm runs)",
        "value": round(headline, 4), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
