"""Run one queue as a job: read the catalog, run its rules, append the results.

    spark-submit ... -m rulecheck --catalog TABLE_OR_PARQUET --results TABLE_OR_PATH \\
        --queue 1 --domain FMR --fic-mis-date 2024-01-31 --as-of-dt 2024-01-31

With ``--jdbc KEY=VALUE`` options (url, driver, ...) catalog and results name
tables of that database; they are plain reader and writer options of Spark.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from rulecheck import JdbcSink, ParquetSink, RunConfig, TableSink, run_queue
from rulecheck.sources.catalog import read_catalog_jdbc


def main(argv: list[str] | None = None) -> dict[str, int]:
    p = argparse.ArgumentParser(prog="rulecheck")
    for name in ("catalog", "results", "domain", "fic-mis-date", "as-of-dt"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--queue", type=int, required=True)
    p.add_argument("--execution-id")
    p.add_argument("--parallel", type=int, default=1)
    p.add_argument("--jdbc", action="append", default=[], metavar="KEY=VALUE")
    a = p.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    options = dict(x.split("=", 1) for x in a.jdbc)
    if options:
        url = options.pop("url")
        catalog, sink = read_catalog_jdbc(spark, url, a.catalog, options), JdbcSink(url, a.results, options)
    else:
        catalog = spark.read.parquet(a.catalog) if "/" in a.catalog else spark.table(a.catalog)
        sink = ParquetSink(a.results) if "/" in a.results else TableSink(a.results)
    config = RunConfig(a.queue, a.domain, a.fic_mis_date, a.as_of_dt, a.execution_id, max_parallel_rules=a.parallel)
    run = run_queue(spark, catalog, config, sink)
    print(run.execution_id, run.tally)
    return run.tally


if __name__ == "__main__":
    main()
