"""Benchmark: headline rule runs over ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints one JSON line:
{"metric": "queue_run_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Queries (warm JVM; wall time, each includes the append of its results to a parquet sink):
  queue_run_seq       queue 1 (20 rules: joins, windows, rollups, 11 failing rules), one rule at a time
  queue_run_par8      the same queue with 8 rules submitted concurrently
  generated_queue     queue 3: one rule per region over all line items, one result row per
                      supplier, all rules concurrent
  per_customer_rule   one rule whose summary has one row per customer (join + GROUP BY)
``value`` is the flagship: ``queue_run_par8``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from rulecheck import ParquetSink, RunConfig, run_queue  # noqa: E402
from rulecheck.session import checkpoint_root  # noqa: E402
from rulecheck.sources.tables import register_parquet_tables  # noqa: E402
from rulecheck.testing import corpus as C  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("rulecheck-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(max(8, 2 * cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="rulecheck-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    register_parquet_tables(spark, sf_dir, C.TABLES)
    catalog = C.test_catalog(spark)
    sink_root = f"{checkpoint_root(spark)}/rulecheck-bench-results"

    def config(queue: int, parallel: int) -> RunConfig:
        return RunConfig(queue, C.DOMAIN, C.FIC_MIS_DATE, C.AS_OF_DT, None, max_parallel_rules=parallel)

    sc = spark.sparkContext

    def timed(name: str, cat, queue: int, parallel: int) -> tuple[float, dict]:
        group = f"bench-{name}"
        sc.setJobGroup(group, name)
        try:
            start = time.perf_counter()
            run = run_queue(spark, cat, config(queue, parallel), ParquetSink(f"{sink_root}/{name}"))
            secs = time.perf_counter() - start
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
            sc.setLocalProperty("spark.job.description", None)
        executed = sorted((o.end - o.start).total_seconds() for o in run.outcomes if o.succeeded)
        stats = dict(run.tally)
        stats["jobs"] = len(sc.statusTracker().getJobIdsForGroup(group))
        stats["rule_sec_median"] = round(executed[len(executed) // 2], 3) if executed else None
        return secs, stats

    # warm-up (not timed): one concurrent pass over queue 1, the generated queue
    # and the per-customer rule, so JIT compilation and parquet footer reads are not charged to the
    # first timed query
    run_queue(spark, catalog, config(C.QUEUE, 8))
    run_queue(spark, catalog, config(C.REGION_QUEUE, 8))
    run_queue(spark, catalog.where(F.col("DQ_CHK_ID") == "C26"), config(4, 1))

    queries: dict[str, float] = {}
    tallies: dict[str, dict] = {}
    for name, cat, queue, parallel in (
        ("queue_run_seq", catalog, C.QUEUE, 1),
        ("queue_run_par8", catalog, C.QUEUE, 8),
        ("generated_queue", catalog, C.REGION_QUEUE, 8),
        ("per_customer_rule", catalog.where(F.col("DQ_CHK_ID") == "C26"), 4, 1),
    ):
        secs, tally = timed(name, cat, queue, parallel)
        queries[name] = round(secs, 3)
        tallies[name] = tally

    sf_match = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "queue_run_sec",
                "value": queries["queue_run_par8"],
                "unit": "sec",
                "queries": queries,
                "sf": float(sf_match.group(1)) if sf_match else sf_dir,
                "cpus": cpus,
                "rules": {k: v["RULES_TOTAL"] for k, v in tallies.items()},
                "result_rows": {k: v["RESULT_ROWS"] for k, v in tallies.items()},
                "spark_jobs": {k: v["jobs"] for k, v in tallies.items()},
                "succeeded_rule_sec_median": {k: v["rule_sec_median"] for k, v in tallies.items()},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
