"""Write the formatted physical plans of a run's parts to docs/PLANS.md.

Usage: python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from rulecheck import RunConfig, run_queue  # noqa: E402
from rulecheck.operators.normalise import normalise_summary  # noqa: E402
from rulecheck.session import checkpoint_root, ensure_checkpoint_dir, non_ansi  # noqa: E402
from rulecheck.sources.catalog import collect_rules, prepared_rules, project_catalog, select_rules  # noqa: E402
from rulecheck.sources.tables import register_parquet_tables  # noqa: E402
from rulecheck.testing import corpus as C  # noqa: E402


def formatted(df) -> str:
    """The final adaptive plan: the frame is executed first (all frames here are
    small), so AQE's runtime decisions and the codegen stages are shown."""
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue().strip()


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "16").getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    spark.conf.set("spark.sql.maxMetadataStringLength", "400")
    ensure_checkpoint_dir(spark)
    register_parquet_tables(spark, sf_dir, C.TABLES)
    catalog = C.test_catalog(spark)
    stored_path = f"{checkpoint_root(spark)}/rulecheck-plans-catalog"
    catalog.write.mode("overwrite").parquet(stored_path)
    stored = spark.read.parquet(stored_path)

    sections = []
    sections.append(
        (
            "Catalog selection on a stored catalog (queue, active flag and domain pushed into the parquet scan; only the used columns read)",
            formatted(project_catalog(select_rules(stored, C.QUEUE, C.DOMAIN))),
        )
    )
    rules = {r.chk_id: r for r in collect_rules(prepared_rules(catalog, C.QUEUE, C.DOMAIN, C.FIC_MIS_DATE, C.AS_OF_DT))}
    region = collect_rules(prepared_rules(catalog, C.REGION_QUEUE, C.DOMAIN, C.FIC_MIS_DATE, C.AS_OF_DT))[0]
    for title, rule in (
        ("Rule C03 (join + GROUP BY) with the normaliser on top: what its staged write executes", rules["C03"]),
        ("Rule C02 (window over duplicate keys) with the normaliser", rules["C02"]),
        ("A region rule: one summary row per supplier of the region, one pass over lineitem", region),
    ):
        with non_ansi(spark):
            sections.append((title, formatted(normalise_summary(spark.sql(rule.rendered_sql)))))
    run = run_queue(
        spark,
        catalog.where(F.col("DQ_CHK_ID").isin("C01", "C03", "C13")),
        RunConfig(C.QUEUE, C.DOMAIN, C.FIC_MIS_DATE, C.AS_OF_DT, "plans"),
    )
    sections.append(
        (
            "Run assembly: one scan of the staged rows, percentages in one projection, per-rule stamps joined from the stored outcomes, failure rows unioned",
            formatted(run.results),
        )
    )

    out = [
        "# Physical plans",
        "",
        f"Generated by `python tools/explain_plans.py {sf_dir}` (Spark {spark.version}, local[8]); "
        "final adaptive plans after execution (`[codegen id : n]` marks whole-stage-codegen stages).",
        "",
    ]
    for title, plan in sections:
        out += [f"## {title}", "", "```", plan, "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
