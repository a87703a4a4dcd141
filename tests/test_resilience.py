"""Task loss during a rule's job: retried attempts must give exactly one copy of
the rule's rows (the staged write commits only successful attempts)."""

from __future__ import annotations

import json
import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent(
    """
    import json, sys, tempfile
    sys.path.insert(0, %(repo)r)
    from pyspark import TaskContext
    from pyspark.sql import SparkSession, functions as F
    from pyspark.sql.types import LongType
    from rulecheck import RunConfig, ParquetSink, run_queue
    from rulecheck.session import checkpoint_root
    from rulecheck.sources.tables import register_parquet_tables

    # local[2,3]: two threads, every task may be attempted three times
    spark = (SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="rulecheck-resilience-")).getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    register_parquet_tables(spark, "/root/testdata/sf0.001", ["region", "orders"])

    def lose_first_attempt(x):
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("simulated executor loss")
        return x

    spark.udf.register("lose_first_attempt", lose_first_attempt, LongType())
    sql = ("SELECT r_name AS SOR, COUNT(*) AS TOTAL_COUNT, 0 AS TOTAL_DOLLAR_AMOUNT, "
           "SUM(lose_first_attempt(CAST(r_regionkey AS BIGINT))) AS FAIL_COUNT, 0 AS FAIL_DOLLAR_AMOUNT "
           "FROM $ds.region GROUP BY r_name")
    catalog = spark.createDataFrame(
        [(1, "FLAKY", 1, "Y", "FMR", "global_temp", "S", sql)],
        "DQ_ID bigint, DQ_CHK_ID string, DQ_QUEUE_ID bigint, DQ_LRI string, DQ_DMN string, "
        "DQ_SCHEMA string, DQ_SOR string, DQ_SQL string")
    sink = ParquetSink(checkpoint_root(spark) + "/resilience-results")
    run = run_queue(spark, catalog, RunConfig(1, "FMR", "2024-01-15", "2000-12-31", "r1"), sink)
    rows = sorted((r.SOR, r.TOTAL_COUNT, r.FAIL_COUNT, r.EXECUTION_STATUS) for r in sink.read(spark).collect())
    print("RESULT " + json.dumps({"tally": run.tally, "rows": rows}))
    """
)


def test_rule_survives_lost_task_attempts():
    proc = subprocess.run(
        [sys.executable, "-c", SCRIPT % {"repo": REPO}],
        capture_output=True,
        text=True,
        timeout=600,
    )
    line = [ln for ln in proc.stdout.splitlines() if ln.startswith("RESULT ")]
    assert line, proc.stderr[-3000:]
    out = json.loads(line[0][len("RESULT "):])
    assert out["tally"] == {"RULES_TOTAL": 1, "RULES_SUCCEEDED": 1, "RULES_FAILED": 0, "RESULT_ROWS": 5}
    assert out["rows"] == sorted(
        [[name, 1, key, "SUCCESS"] for key, name in enumerate(["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"])]
    )
