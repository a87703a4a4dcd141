"""

Every query registers the driver's parquet tables (``sf_dir``) as
``global_temp`` views and works on them: rules run over the whole tables, and
the rule catalog holds one row per supplier derived by Spark from ``supplier``
(queue 6, read, selected, rendered and ordered, never run) and one rule per
region (queue 3), next to the hand-written rules.

Results that are not written to a sink are lazy: they read the rows that the
run staged below the checkpoint folder, which therefore stay.

Run-level queries return the comparable part of the results table: the 19
result columns without the three timestamps (the ``execution_times`` query
covers those under a deterministic clock) and with ``ERROR_MESSAGE`` given as
``ERROR_TEXT``: the engine's error class (``[PARSE_SYNTAX_ERROR]`` ...) for
errors raised by Spark, the full text for the engine's own messages.
"""

from __future__ import annotations

import importlib.util
import logging
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rulecheck.operators.execute import RunContext, execute_rule
from rulecheck.operators.normalise import uppercase_columns
from rulecheck.plans.run import RunConfig, RunResult, assemble_results, run_queue, tally_frame, union_results
from rulecheck.schema import RESULT_COLUMNS, TIME_COLUMNS
from rulecheck.session import checkpoint_root, ensure_checkpoint_dir, new_staging_dir, non_ansi
from rulecheck.sinks.results import ParquetSink
from rulecheck.functions.measures import measure_to_long, sor_label
from rulecheck.functions.render import render_placeholders, unresolved_placeholders
from rulecheck.sources.catalog import collect_rules, count_rules, number_rules, prepared_rules, project_catalog, select_rules
from rulecheck.sources.tables import register_parquet_tables
from rulecheck.testing import corpus as C
from rulecheck.testing import oracle as O

FLAGSHIP_SF_DIR = "/root/testdata/sf0.001"


# ---------------------------------------------------------------------------
# helpers
# ---------------------------------------------------------------------------
def _prepare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Register the tables and return the test catalog (corpus, region and supplier rows)."""
    ensure_checkpoint_dir(spark)
    register_parquet_tables(spark, sf_dir, C.TABLES)
    return C.test_catalog(spark)


def _config(queue: int = C.QUEUE, domain: str = C.DOMAIN, execution_id: str | None = C.EXECUTION_ID) -> RunConfig:
    return RunConfig(queue, domain, C.FIC_MIS_DATE, C.AS_OF_DT, execution_id, C.TickingClock())


def _run(
    spark: SparkSession,
    sf_dir: str,
    chk_ids: list[str] | None = None,
    queue: int = C.QUEUE,
    domain: str = C.DOMAIN,
    execution_id: str | None = C.EXECUTION_ID,
    sink=None,
) -> RunResult:
    catalog = _prepare(spark, sf_dir)
    if chk_ids:
        catalog = catalog.where(F.col("DQ_CHK_ID").isin(chk_ids))
    return run_queue(spark, catalog, _config(queue, domain, execution_id), sink)


def _error_text() -> F.Column:
    """The class of an error raised by Spark, the whole text of the engine's own messages."""
    msg = F.col("ERROR_MESSAGE")
    cls = F.regexp_extract(msg, r"^\s*(\[[A-Z0-9_.]+\])", 1)
    return F.when(cls != F.lit(""), cls).otherwise(msg)


def _times_as_text() -> dict[str, F.Column]:
    return {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in TIME_COLUMNS}


def comparable(results: DataFrame, with_times: bool = False) -> DataFrame:
    """Result columns as compared with the oracle (see module docstring)."""
    keep = [c for c in RESULT_COLUMNS if c not in TIME_COLUMNS and c != "ERROR_MESSAGE"]
    cols = [F.col(c) for c in keep] + [_error_text().alias("ERROR_TEXT")]
    if with_times:
        cols += _times_as_text().values()
    return results.select(*cols)


def _run_rules(chk_ids: list[str] | None, queue: int = C.QUEUE) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(_run(spark, sf_dir, chk_ids, queue).results)

    return query


def _rules_oracle(chk_ids: list[str]) -> str:
    return O.with_catalog(O.rules_rows_sql(chk_ids))


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_root(spark)}/rulecheck-scratch/{name}-{uuid.uuid4().hex[:12]}"


def _stored_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The test catalog as a stored table, so selections reach its scan."""
    path = _scratch(spark, "catalog")
    _prepare(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def _selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active rules of queues 1 and 6 (domain FMR): selected on the stored values, then projected."""
    stored = _stored_catalog(spark, sf_dir)
    parts = [project_catalog(select_rules(stored, queue, C.DOMAIN)) for queue in (C.QUEUE, C.SUPPLIER_QUEUE)]
    return parts[0].unionByName(parts[1])


# ---------------------------------------------------------------------------
# sources / sinks
# ---------------------------------------------------------------------------
def q_rule_catalog_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog as a stored table, read back with the queue selection
    pushed into the scan."""
    return project_catalog(select_rules(_stored_catalog(spark, sf_dir), C.SUPPLIER_QUEUE, C.DOMAIN))


def q_target_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule text naming two catalog tables (``$ds.lineitem`` JOIN ``$ds.orders``)."""
    return comparable(_run(spark, sf_dir, ["C03"]).results)


def q_results_sink_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queue-1 run appended to a results table partitioned by business date,
    read back (the staged rows are gone by then)."""
    sink = ParquetSink(_scratch(spark, "results"), partition_by=("RUN_FIC_MIS_DATE",))
    run = _run(spark, sf_dir, sink=sink)
    assert run.written and run.staging_dir is None
    return comparable(sink.read(spark))


def q_typed_result_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed 19-column result frame of the queue-1 run (times as text under the test clock)."""
    return comparable(_run(spark, sf_dir).results, with_times=True)


# ---------------------------------------------------------------------------
# filters / checks
# ---------------------------------------------------------------------------
def q_rule_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Active rules of queue 1 and of the supplier rows (domain FMR)."""
    return _selected(spark, sf_dir)


def q_empty_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suppliers' queue has no active row in domain EIDF, which only their
    balances tell; the run is empty."""
    return comparable(run_queue(spark, _stored_catalog(spark, sf_dir), _config(C.SUPPLIER_QUEUE, "EIDF")).results)


def q_summary_contract_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lower-case names and extra columns pass; missing columns fail the rule."""
    return comparable(_run(spark, sf_dir, ["C01", "C10", "C11"]).results)


def q_summary_zero_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty summary fails; a global aggregate over no rows does not."""
    return comparable(_run(spark, sf_dir, ["C07", "C08"]).results)


# ---------------------------------------------------------------------------
# projections
# ---------------------------------------------------------------------------
def q_catalog_wildcard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every catalog column (``SELECT *``), all rules."""
    return _prepare(spark, sf_dir).select("*")


def q_summary_uppercase_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A summary with lower-case names, upper-cased as a run does first."""
    catalog = _prepare(spark, sf_dir).where(F.col("DQ_CHK_ID") == "C01")
    rule = collect_rules(prepared_rules(catalog, C.QUEUE, C.DOMAIN, C.FIC_MIS_DATE, C.AS_OF_DT))[0]
    with non_ansi(spark):
        summary = uppercase_columns(spark.sql(rule.rendered_sql))
    return summary.select(
        F.col("SOR").cast("string").alias("SOR"),
        F.col("TOTAL_COUNT").cast("bigint").alias("TOTAL_COUNT"),
        F.col("TOTAL_DOLLAR_AMOUNT").cast("decimal(38,2)").alias("TOTAL_DOLLAR_AMOUNT"),
        F.col("FAIL_COUNT").cast("bigint").alias("FAIL_COUNT"),
        F.col("FAIL_DOLLAR_AMOUNT").cast("decimal(38,2)").alias("FAIL_DOLLAR_AMOUNT"),
    )


def q_run_metadata_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule keys and run parameters stamped on every result row of the queue-1 run."""
    res = _run(spark, sf_dir).results
    return res.select("DQ_ID", "DQ_CHK_ID", "DQ_QUEUE_ID", "EXECUTION_ID", "RUN_FIC_MIS_DATE", "RUN_AS_OF_DT", "RUN_DMN", "SOR")


def q_result_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 19 columns of every rule of queue 1, the engine's own messages whole, Spark's
    by their class and times as text under the test clock; ``LAYOUT`` is the row type,
    column by column in place."""
    results = _run(spark, sf_dir).results
    held = results.select("*", F.expr("typeof(struct(*))").alias("LAYOUT"))
    shown = _times_as_text() | {"ERROR_MESSAGE": _error_text().alias("ERROR_MESSAGE")}
    return held.select(*[shown.get(c, F.col(c)) for c in held.columns])


def q_result_union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of all rules of queue 1 and of a queue in which a summary holds equal rows,
    another rule repeats its text and one fails; all rows come out. ``N_SAME`` counts the
    rows of a rule with one label."""
    runs = [_run(spark, sf_dir, queue=queue).results for queue in (C.QUEUE, C.UNION_QUEUE)]
    rows = comparable(union_results(runs, spark))
    same = Window.partitionBy(*[c for c in rows.columns if c in ("DQ_ID", "SOR")])
    return rows.withColumn("N_SAME", F.count(F.lit(1)).over(same))


# ---------------------------------------------------------------------------
# scalar functions
# ---------------------------------------------------------------------------
def q_placeholder_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rendered text of every catalog rule."""
    catalog = _prepare(spark, sf_dir)
    rendered = render_placeholders("DQ_SQL", "DQ_SCHEMA", "DQ_SOR", C.FIC_MIS_DATE, C.AS_OF_DT)
    return catalog.select(F.col("DQ_ID").cast("bigint").alias("DQ_ID"), "DQ_CHK_ID", rendered.alias("RENDERED_SQL"))


def q_placeholder_unresolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Placeholders left after rendering, per catalog rule."""
    catalog = _prepare(spark, sf_dir)
    rendered = render_placeholders("DQ_SQL", "DQ_SCHEMA", "DQ_SOR", C.FIC_MIS_DATE, C.AS_OF_DT)
    found = unresolved_placeholders(rendered)
    return catalog.select(
        F.col("DQ_ID").cast("bigint").alias("DQ_ID"),
        "DQ_CHK_ID",
        F.array_join(found, ",").alias("UNRESOLVED"),
        F.size(found).cast("bigint").alias("N_UNRESOLVED"),
    )


def q_measure_to_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measure coercion over customer values: doubles and decimals truncate
    toward zero (negative balances), integer text parses, booleans count."""
    _prepare(spark, sf_dir)
    cust = spark.table("global_temp.customer")
    bal_dec = F.col("c_acctbal").cast("decimal(18,2)")
    key_txt = F.col("c_custkey").cast("string")
    neg = F.col("c_acctbal") < 0
    schema = cust.select(bal_dec.alias("d"), key_txt.alias("s"), neg.alias("b")).schema
    return cust.select(
        "c_custkey",
        measure_to_long(F.col("c_acctbal"), cust.schema["c_acctbal"].dataType, "c_acctbal").alias("ACCTBAL_FROM_DOUBLE"),
        measure_to_long(bal_dec, schema["d"].dataType, "d").alias("ACCTBAL_FROM_DECIMAL"),
        measure_to_long(key_txt, schema["s"].dataType, "s").alias("CUSTKEY_FROM_TEXT"),
        measure_to_long(neg, schema["b"].dataType, "b").alias("NEGATIVE_FLAG"),
    )


def q_sor_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label text of every type a summary may hold: a ROLLUP's null labels and the
    number 0, and per customer and order floats, doubles over the whole range of
    exponents, timestamps with and without a fraction, and empty values."""
    _prepare(spark, sf_dir)
    cube = spark.sql(
        "SELECT c_mktsegment AS seg, c_nationkey AS nation, COUNT(*) AS n "
        "FROM global_temp.customer GROUP BY ROLLUP(c_mktsegment, c_nationkey)"
    )
    values = spark.sql(
        "SELECT c_custkey AS k, CAST(c_acctbal AS FLOAT) AS f, c_acctbal < 0 AS b, "
        "CAST(concat(CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS STRING), 'e', CAST(c_custkey % 31 - 15 AS STRING)) AS DOUBLE) AS d, "
        "timestamp_micros(1700000000000000 + c_custkey * 250000) AS t, CAST('' AS BINARY) AS e, slice(array(1), 1, 0) AS a "
        "FROM global_temp.customer"
    )

    def label(df: DataFrame, name: str):
        return sor_label(F.col(name), df.schema[name].dataType)

    rolled = cube.select(
        F.lit(None).cast("bigint").alias("CUSTOMER"), label(cube, "seg").alias("LABEL_1"), label(cube, "nation").alias("LABEL_2"),
        F.lit("").alias("LABEL_3"), F.lit("").alias("LABEL_4"), F.lit("").alias("LABEL_5"), F.col("n").cast("bigint").alias("N"),
    )
    typed = values.select(
        F.col("k").alias("CUSTOMER"), label(values, "f").alias("LABEL_1"), label(values, "d").alias("LABEL_2"), label(values, "b").alias("LABEL_3"),
        label(values, "t").alias("LABEL_4"), F.concat(label(values, "e"), label(values, "a")).alias("LABEL_5"), F.lit(0).cast("bigint").alias("N"),
    )
    return rolled.unionByName(typed)


def q_fail_count_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact half-even count percentages of a per-customer summary."""
    res = _run(spark, sf_dir, ["C26"], queue=4).results
    return res.select("SOR", "TOTAL_COUNT", "FAIL_COUNT", "FAIL_COUNT_PERCENTAGE")


def q_fail_dollar_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dollar percentages on amounts truncated to whole units."""
    res = _run(spark, sf_dir, ["C26"], queue=4).results
    return res.select("SOR", "TOTAL_DOLLAR_AMOUNT", "FAIL_DOLLAR_AMOUNT", "FAIL_DOLLAR_PERCENTAGE")


def q_error_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error text cut at 4000 characters (the engine's own message, and a
    runtime error raised inside the rule's job)."""
    res = _run(spark, sf_dir, ["C29", "C30"], queue=5).results
    return res.select(
        "DQ_ID",
        "ERROR_MESSAGE",
        F.length("ERROR_MESSAGE").cast("bigint").alias("MESSAGE_LENGTH"),
    )


def q_execution_id_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without an execution id, one random UUID stamps every row of the run."""
    res = _run(spark, sf_dir, execution_id=None).results
    uuid_re = r"^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
    return res.agg(
        F.count_distinct("EXECUTION_ID").cast("bigint").alias("N_EXECUTION_IDS"),
        F.min(F.col("EXECUTION_ID").rlike(uuid_re)).alias("IS_UUID4"),
        F.count(F.lit(1)).cast("bigint").alias("RESULT_ROWS"),
    )


def q_execution_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start before the rule, end after its rows, created = end (ticking test clock)."""
    res = _run(spark, sf_dir).results
    return res.select("DQ_ID", "SOR", *[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in TIME_COLUMNS])


def q_rule_key_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of every catalog rule as longs / text (null check id -> 'None')."""
    return project_catalog(_prepare(spark, sf_dir)).select("DQ_ID", "DQ_CHK_ID", "DQ_QUEUE_ID")


# ---------------------------------------------------------------------------
# aggregations
# ---------------------------------------------------------------------------
def q_rule_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of selected rules per queue (queues 1 and 6, domain FMR)."""
    return count_rules(_selected(spark, sf_dir))


def q_run_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules succeeded / failed / total and result rows of the queue-1 run."""
    return tally_frame(spark, _run(spark, sf_dir).outcomes)


def q_result_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows about to be written by the queue-1 run, as the run itself counted them."""
    run = _run(spark, sf_dir)
    return spark.createDataFrame([(run.tally["RESULT_ROWS"],)], "RESULT_ROWS bigint")


# ---------------------------------------------------------------------------
# order / set / dataflow
# ---------------------------------------------------------------------------
def q_rule_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Execution order within each queue (DQ_ID, then DQ_CHK_ID), as a run numbers its rules."""
    return number_rules(_selected(spark, sf_dir)).select("DQ_QUEUE_ID", "DQ_ID", "DQ_CHK_ID", (F.col("RULE_SEQ") + 1).alias("EXEC_ORDER"))


def q_rule_execute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rule executed on its own (no queue run around it)."""
    catalog = _prepare(spark, sf_dir).where(F.col("DQ_CHK_ID") == "C02")
    rule = collect_rules(prepared_rules(catalog, C.QUEUE, C.DOMAIN, C.FIC_MIS_DATE, C.AS_OF_DT))[0]
    ctx = RunContext(
        C.EXECUTION_ID, C.FIC_MIS_DATE, C.AS_OF_DT, C.DOMAIN, new_staging_dir(spark, C.EXECUTION_ID), C.TickingClock()
    )
    outcome = execute_rule(spark, rule, ctx)
    return comparable(assemble_results(spark, [outcome], ctx))


def q_rule_queue_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O32 (flagship): the whole queue-1 run."""
    return comparable(_run(spark, sf_dir).results)


def q_rule_queue_run_generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O32 over the region-derived queue: one rule per region, one result row per supplier."""
    catalog = _prepare(spark, sf_dir)
    config = RunConfig(C.REGION_QUEUE, C.DOMAIN, C.FIC_MIS_DATE, C.AS_OF_DT, C.EXECUTION_ID, C.TickingClock(), 4)
    return comparable(run_queue(spark, catalog, config).results)


# ---------------------------------------------------------------------------
# contract
# ---------------------------------------------------------------------------
_QUEUE1 = O.queue_chk_ids(C.QUEUE)

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "rule_catalog_scan": q_rule_catalog_scan,
    "target_table_scan": q_target_table_scan,
    "results_sink_append": q_results_sink_append,
    "typed_result_frame": q_typed_result_frame,
    "rule_select": q_rule_select,
    "empty_queue": q_empty_queue,
    "summary_contract_check": q_summary_contract_check,
    "summary_zero_rows": q_summary_zero_rows,
    "catalog_wildcard": q_catalog_wildcard,
    "summary_uppercase_columns": q_summary_uppercase_columns,
    "run_metadata_stamp": q_run_metadata_stamp,
    "result_projection": q_result_projection,
    "placeholder_render": q_placeholder_render,
    "placeholder_unresolved": q_placeholder_unresolved,
    "measure_to_long": q_measure_to_long,
    "sor_default": q_sor_default,
    "fail_count_pct": q_fail_count_pct,
    "fail_dollar_pct": q_fail_dollar_pct,
    "error_truncate": q_error_truncate,
    "execution_id_default": q_execution_id_default,
    "execution_times": q_execution_times,
    "rule_key_coercion": q_rule_key_coercion,
    "rule_summary_global": _run_rules(["C02", "C04", "C05", "C06"]),
    "rule_summary_by_sor": _run_rules(["C01", "C03", "C09"]),
    "rule_count": q_rule_count,
    "run_tally": q_run_tally,
    "result_row_count": q_result_row_count,
    "rule_order": q_rule_order,
    "result_union_all": q_result_union_all,
    "rule_execute": q_rule_execute,
    "rule_failure_row": _run_rules(["C12", "C13", "C14", "C15", "C16", "C17", "C18", "C19", "C20"]),
    "rule_queue_run": q_rule_queue_run,
    "rule_queue_run_generated": q_rule_queue_run_generated,
    "pass_through_joins_windows_sets": _run_rules(["C26", "C27", "C28", "C31"], queue=4),
}


def _oracles() -> dict[str, str]:
    render = O.rendered_expr()
    both = f"SELECT * FROM {O.selected(C.QUEUE)} UNION ALL SELECT * FROM {O.selected(C.SUPPLIER_QUEUE)}"
    projected = (
        "SELECT CAST(DQ_ID AS BIGINT) AS DQ_ID, COALESCE(DQ_CHK_ID, 'None') AS DQ_CHK_ID, "
        "CAST(DQ_QUEUE_ID AS BIGINT) AS DQ_QUEUE_ID, DQ_LRI, DQ_DMN, DQ_SCHEMA, DQ_SOR, DQ_SQL"
    )
    queue1_rows = O.rules_rows_sql(_QUEUE1)
    times = f"SELECT DQ_ID, {O.ticking_times_sql('DQ_ID')} FROM (SELECT CAST(DQ_ID AS BIGINT) AS DQ_ID FROM {O.selected(C.QUEUE)}) k"
    return {
        "rule_catalog_scan": O.with_catalog(f"{projected} FROM {O.selected(C.SUPPLIER_QUEUE)} c"),
        "target_table_scan": _rules_oracle(["C03"]),
        "results_sink_append": O.with_catalog(queue1_rows),
        "typed_result_frame": O.with_catalog(
            "SELECT r.*, t.EXECUTION_START_DT, t.EXECUTION_END_DT, t.EXECUTION_END_DT AS CREATED_DT "
            f"FROM ({queue1_rows}) r JOIN ({times}) t ON r.DQ_ID = t.DQ_ID"
        ),
        "rule_select": O.with_catalog(f"{projected} FROM ({both}) c"),
        "empty_queue": O.with_catalog(
            f"SELECT r.* FROM ({O.rules_rows_sql(['C01'])}) r WHERE EXISTS "
            f"(SELECT 1 FROM {O.selected(C.SUPPLIER_QUEUE, 'EIDF')} s)"
        ),
        "summary_contract_check": _rules_oracle(["C01", "C10", "C11"]),
        "summary_zero_rows": _rules_oracle(["C07", "C08"]),
        "catalog_wildcard": O.with_catalog("SELECT * FROM catalog"),
        "summary_uppercase_columns": (
            "SELECT CAST(SOR AS VARCHAR) AS SOR, CAST(TOTAL_COUNT AS BIGINT) AS TOTAL_COUNT, "
            "CAST(TOTAL_DOLLAR_AMOUNT AS DECIMAL(38,2)) AS TOTAL_DOLLAR_AMOUNT, CAST(FAIL_COUNT AS BIGINT) AS FAIL_COUNT, "
            "CAST(FAIL_DOLLAR_AMOUNT AS DECIMAL(38,2)) AS FAIL_DOLLAR_AMOUNT "
            f"FROM ({O.duck_rule_text(C.BY_CHK['C01'])}) s"
        ),
        "run_metadata_stamp": O.with_catalog(
            "SELECT DQ_ID, DQ_CHK_ID, DQ_QUEUE_ID, EXECUTION_ID, RUN_FIC_MIS_DATE, RUN_AS_OF_DT, RUN_DMN, SOR "
            f"FROM ({queue1_rows}) r"
        ),
        "result_projection": O.with_catalog(
            f"SELECT r.* EXCLUDE (ERROR_TEXT), r.ERROR_TEXT AS ERROR_MESSAGE, t.EXECUTION_START_DT, t.EXECUTION_END_DT, t.EXECUTION_END_DT AS CREATED_DT, '{O.LAYOUT}' AS LAYOUT "
            f"FROM ({queue1_rows}) r JOIN ({times}) t ON r.DQ_ID = t.DQ_ID"
        ),
        "placeholder_render": O.with_catalog(
            f"SELECT CAST(DQ_ID AS BIGINT) AS DQ_ID, DQ_CHK_ID, {render} AS RENDERED_SQL FROM catalog"
        ),
        "placeholder_unresolved": O.with_catalog(
            f"SELECT CAST(DQ_ID AS BIGINT) AS DQ_ID, DQ_CHK_ID, "
            f"array_to_string({O.unresolved_expr(render)}, ',') AS UNRESOLVED, "
            f"CAST(len({O.unresolved_expr(render)}) AS BIGINT) AS N_UNRESOLVED FROM catalog"
        ),
        "measure_to_long": (
            "SELECT c_custkey, CAST(trunc(c_acctbal) AS BIGINT) AS ACCTBAL_FROM_DOUBLE, "
            "CAST(trunc(CAST(c_acctbal AS DECIMAL(18,2))) AS BIGINT) AS ACCTBAL_FROM_DECIMAL, "
            "CAST(CAST(c_custkey AS VARCHAR) AS BIGINT) AS CUSTKEY_FROM_TEXT, "
            "CAST(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS BIGINT) AS NEGATIVE_FLAG FROM customer"
        ),
        "sor_default": (
            "SELECT CAST(NULL AS BIGINT) AS CUSTOMER, CASE WHEN seg IS NULL OR seg = '' THEN 'NA' ELSE seg END AS LABEL_1, "
            "CASE WHEN nation IS NULL OR nation = 0 THEN 'NA' ELSE CAST(nation AS VARCHAR) END AS LABEL_2, '' AS LABEL_3, '' AS LABEL_4, '' AS LABEL_5, "
            "CAST(n AS BIGINT) AS N FROM (SELECT c_mktsegment AS seg, c_nationkey AS nation, COUNT(*) AS n "
            "FROM customer GROUP BY ROLLUP(c_mktsegment, c_nationkey)) t UNION ALL "
            "SELECT c_custkey, CASE WHEN c_acctbal = 0 THEN 'NA' ELSE CAST(CAST(CAST(c_acctbal AS FLOAT) AS DOUBLE) AS VARCHAR) END, "
            "CASE WHEN c_acctbal = 0 THEN 'NA' ELSE CAST(CAST(CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS VARCHAR) || 'e' || CAST(c_custkey % 31 - 15 AS VARCHAR) AS DOUBLE) AS VARCHAR) END, "
            "CASE WHEN c_acctbal < 0 THEN 'True' ELSE 'NA' END, "
            "strftime(make_timestamp(1700000000000000 + c_custkey * 250000), '%Y-%m-%d %H:%M:%S') || "
            "CASE WHEN c_custkey % 4 = 0 THEN '' ELSE strftime(make_timestamp(1700000000000000 + c_custkey * 250000), '.%f') END, "
            "'NANA', CAST(0 AS BIGINT) FROM customer"
        ),
        "fail_count_pct": O.with_catalog(
            f"SELECT SOR, TOTAL_COUNT, FAIL_COUNT, FAIL_COUNT_PERCENTAGE FROM ({O.rules_rows_sql(['C26'])}) r"
        ),
        "fail_dollar_pct": O.with_catalog(
            "SELECT SOR, TOTAL_DOLLAR_AMOUNT, FAIL_DOLLAR_AMOUNT, FAIL_DOLLAR_PERCENTAGE "
            f"FROM ({O.rules_rows_sql(['C26'])}) r"
        ),
        "error_truncate": O.with_catalog(
            "SELECT DQ_ID, ERROR_MESSAGE, CAST(length(ERROR_MESSAGE) AS BIGINT) AS MESSAGE_LENGTH FROM ("
            f"SELECT CAST(DQ_ID AS BIGINT) AS DQ_ID, {O.unresolved_message_expr(render)} AS ERROR_MESSAGE "
            "FROM catalog WHERE DQ_CHK_ID = 'C29' UNION ALL "
            "SELECT CAST(30 AS BIGINT), left('[USER_RAISED_EXCEPTION] lineitem rows: ' || "
            "CAST((SELECT COUNT(*) FROM lineitem) AS VARCHAR) || ' ' || repeat('x', 5000), 4000)) m"
        ),
        "execution_id_default": O.with_catalog(
            "SELECT CAST(1 AS BIGINT) AS N_EXECUTION_IDS, true AS IS_UUID4, CAST(COUNT(*) AS BIGINT) AS RESULT_ROWS "
            f"FROM ({queue1_rows}) r"
        ),
        "execution_times": O.with_catalog(
            "SELECT r.DQ_ID, r.SOR, t.EXECUTION_START_DT, t.EXECUTION_END_DT, t.EXECUTION_END_DT AS CREATED_DT "
            f"FROM ({queue1_rows}) r JOIN ({times}) t ON r.DQ_ID = t.DQ_ID"
        ),
        "rule_key_coercion": O.with_catalog(
            "SELECT CAST(DQ_ID AS BIGINT) AS DQ_ID, COALESCE(DQ_CHK_ID, 'None') AS DQ_CHK_ID, "
            "CAST(DQ_QUEUE_ID AS BIGINT) AS DQ_QUEUE_ID FROM catalog"
        ),
        "rule_summary_global": _rules_oracle(["C02", "C04", "C05", "C06"]),
        "rule_summary_by_sor": _rules_oracle(["C01", "C03", "C09"]),
        "rule_count": O.with_catalog(
            "SELECT CAST(DQ_QUEUE_ID AS BIGINT) AS DQ_QUEUE_ID, CAST(COUNT(*) AS BIGINT) AS RULE_COUNT "
            f"FROM ({both}) s GROUP BY DQ_QUEUE_ID"
        ),
        "run_tally": O.with_catalog(
            "SELECT CAST(COUNT(DISTINCT DQ_ID) AS BIGINT) AS RULES_TOTAL, "
            "CAST(COUNT(DISTINCT CASE WHEN EXECUTION_STATUS = 'SUCCESS' THEN DQ_ID END) AS BIGINT) AS RULES_SUCCEEDED, "
            "CAST(COUNT(DISTINCT CASE WHEN EXECUTION_STATUS = 'FAILED' THEN DQ_ID END) AS BIGINT) AS RULES_FAILED, "
            f"CAST(COUNT(*) AS BIGINT) AS RESULT_ROWS FROM ({queue1_rows}) r"
        ),
        "result_row_count": O.with_catalog(f"SELECT CAST(COUNT(*) AS BIGINT) AS RESULT_ROWS FROM ({queue1_rows}) r"),
        "rule_order": O.with_catalog(
            "SELECT CAST(DQ_QUEUE_ID AS BIGINT) AS DQ_QUEUE_ID, CAST(DQ_ID AS BIGINT) AS DQ_ID, "
            "COALESCE(DQ_CHK_ID, 'None') AS DQ_CHK_ID, CAST(row_number() OVER (PARTITION BY DQ_QUEUE_ID "
            "ORDER BY DQ_ID, COALESCE(DQ_CHK_ID, 'None')) AS BIGINT) AS EXEC_ORDER "
            f"FROM ({both}) s"
        ),
        "result_union_all": O.with_catalog(
            "SELECT r.*, CAST(COUNT(*) OVER (PARTITION BY DQ_ID, SOR) AS BIGINT) AS N_SAME "
            f"FROM ({O.rules_rows_sql(_QUEUE1 + O.queue_chk_ids(C.UNION_QUEUE))}) r"
        ),
        "rule_execute": _rules_oracle(["C02"]),
        "rule_failure_row": _rules_oracle(["C12", "C13", "C14", "C15", "C16", "C17", "C18", "C19", "C20"]),
        "rule_queue_run": O.with_catalog(queue1_rows),
        "rule_queue_run_generated": O.with_catalog(O.region_rows_sql()),
        "pass_through_joins_windows_sets": _rules_oracle(["C26", "C27", "C28", "C31"]),
    }


def _llm() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries and SQL of the training-data operators, where that subpackage is installed."""
    try:
        from rulecheck.llm.queries import ORACLES, QUERIES
    except ImportError as missing:  # the subpackage, or a library that only it needs
        logging.getLogger(__name__).warning("no training-data queries: %s", missing)
        return {}, {}

    found, sql = dict(QUERIES), dict(ORACLES)
    if importlib.util.find_spec("corpus_pipeline") is not None:
        import corpus_pipeline

        found["pipeline"] = corpus_pipeline.run
        if corpus_pipeline.ORACLE_SQL is not None:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the queue-1 run over the sf0.001 tables, as the 19-column results table."""
    sf_dir = os.environ.get("RULECHECK_FLAGSHIP_DIR", FLAGSHIP_SF_DIR)
    catalog = _prepare(spark, sf_dir)
    return run_queue(spark, catalog, _config()).results


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """
    pass-through corpus). Each callable takes (spark, sf_dir)."""
    return _QUERIES | _llm()[0]


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the keys of ``queries()`` that SQL can express: all of the rule engine
    the training-data operators."""
    return _oracles() | _llm()[1]
