"""Rule execution, failure isolation and whole runs."""

from __future__ import annotations

import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rulecheck import RunConfig, run_queue
from rulecheck.operators.execute import RunContext, execute_rule
from rulecheck.operators.normalise import SummaryContractError, normalise_summary, with_percentages
from rulecheck.plans.run import assemble_results
from rulecheck.schema import RESULT_SCHEMA
from rulecheck.session import new_staging_dir
from rulecheck.sources.catalog import Rule, collect_rules, prepared_rules
from rulecheck.testing import corpus as C


def config(**kw):
    base = dict(
        queue_id=C.QUEUE,
        domain=C.DOMAIN,
        fic_mis_date=C.FIC_MIS_DATE,
        as_of_dt=C.AS_OF_DT,
        execution_id=C.EXECUTION_ID,
        clock=C.TickingClock(),
    )
    base.update(kw)
    return RunConfig(**base)


def one_rule(spark, sql, seq=0):
    ctx = RunContext("x", C.FIC_MIS_DATE, C.AS_OF_DT, C.DOMAIN, new_staging_dir(spark, "x"), C.TickingClock())
    rule = Rule(seq, 1, "T", 1, sql, tuple(re.findall(r"\$[a-zA-Z_]+", sql)))
    outcome = execute_rule(spark, rule, ctx)
    return outcome, ctx


def test_contract_missing_sorted_and_first_wins(spark):
    with pytest.raises(SummaryContractError, match=r"\['FAIL_COUNT', 'FAIL_DOLLAR_AMOUNT', 'TOTAL_DOLLAR_AMOUNT'\]"):
        normalise_summary(spark.sql("SELECT 1 AS sor, 2 AS Total_Count"))
    df = spark.sql(
        "SELECT 'a' AS sor, 7 AS total_count, 9 AS TOTAL_COUNT, 0 AS total_dollar_amount, "
        "1 AS fail_count, 0 AS fail_dollar_amount, 'extra' AS x"
    )
    row = with_percentages(normalise_summary(df)).first()
    assert (row.SOR, row.TOTAL_COUNT, row.FAIL_COUNT_PERCENTAGE) == ("a", 7, Decimal("14.29"))


def test_queue_run_isolates_failures(spark, catalog):
    run = run_queue(spark, catalog, config())
    assert run.tally == {"RULES_TOTAL": 20, "RULES_SUCCEEDED": 9, "RULES_FAILED": 11, "RESULT_ROWS": 31}
    by_chk = {o.rule.chk_id: o for o in run.outcomes}
    for chk, rule in C.BY_CHK.items():
        if chk not in by_chk:
            continue
        outcome = by_chk[chk]
        if rule.error is None:
            assert outcome.succeeded, (chk, outcome.error)
        else:
            assert not outcome.succeeded, chk
            expected = rule.error.strip("'").replace("''", "'")
            if rule.error == C.UNRESOLVED:
                assert outcome.error.startswith("Unresolved placeholders in SQL: ['$")
            elif expected.startswith("["):
                assert expected in outcome.error, (chk, outcome.error)
            else:
                assert outcome.error == expected, (chk, outcome.error)
    rows = run.results.collect()
    assert len(rows) == 31
    assert run.results.schema == RESULT_SCHEMA or [f.name for f in run.results.schema] == RESULT_SCHEMA.names
    failed = [r for r in rows if r.EXECUTION_STATUS == "FAILED"]
    assert {(r.SOR, r.TOTAL_COUNT, r.FAIL_COUNT_PERCENTAGE) for r in failed} == {("NA", 0, Decimal("0.00"))}
    assert all(r.EXECUTION_END_DT == r.CREATED_DT and r.EXECUTION_START_DT < r.EXECUTION_END_DT for r in rows)


def test_not_selected_rows(spark, catalog):
    rules = collect_rules(prepared_rules(catalog, C.QUEUE, C.DOMAIN, C.FIC_MIS_DATE, C.AS_OF_DT))
    chks = [r.chk_id for r in rules]
    assert chks == [f"C{i:02d}" for i in range(1, 21)]
    assert [r.seq for r in rules] == list(range(20))


def test_ansi_scope_restored_and_rule_text_non_ansi(spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    outcome, ctx = one_rule(
        spark,
        "SELECT 'X' AS SOR, 1/0 AS TOTAL_COUNT, CAST('abc' AS INT) AS TOTAL_DOLLAR_AMOUNT, "
        "0 AS FAIL_COUNT, 0 AS FAIL_DOLLAR_AMOUNT",
    )
    assert spark.conf.get("spark.sql.ansi.enabled") == before
    assert outcome.succeeded, outcome.error
    row = assemble_results(spark, [outcome], ctx).first()
    assert (row.TOTAL_COUNT, row.TOTAL_DOLLAR_AMOUNT) == (0, 0)


def test_runtime_error_inside_rule_is_caught(spark):
    outcome, _ = one_rule(spark, C._C16.replace("$ds.", "global_temp."))
    assert not outcome.succeeded and "[USER_RAISED_EXCEPTION] boom" in outcome.error


def test_all_or_nothing_and_no_partial_rows(spark, tables):
    outcome, ctx = one_rule(spark, C._C18.replace("$ds.", "global_temp."))
    assert not outcome.succeeded
    res = assemble_results(spark, [outcome], ctx).collect()
    assert len(res) == 1 and res[0].EXECUTION_STATUS == "FAILED"


def test_percent_overflow_fails_only_that_rule(spark, catalog):
    run = run_queue(spark, catalog.where(F.col("DQ_CHK_ID").isin("C19", "C10")), config())
    status = {o.rule.chk_id: o.status for o in run.outcomes}
    assert status == {"C10": "SUCCESS", "C19": "FAILED"}


def test_empty_queue(spark, catalog):
    run = run_queue(spark, catalog, config(queue_id=77))
    assert run.rules == [] and run.results.count() == 0 and not run.written


def test_null_dq_id_aborts_before_rules(spark):
    df = spark.createDataFrame(
        [(None, "A", 1, "Y", "FMR", None, None, "SELECT 1")],
        "DQ_ID bigint, DQ_CHK_ID string, DQ_QUEUE_ID bigint, DQ_LRI string, DQ_DMN string, "
        "DQ_SCHEMA string, DQ_SOR string, DQ_SQL string",
    )
    with pytest.raises(ValueError, match="without an integer DQ_ID"):
        run_queue(spark, df, config())


def test_catalog_without_optional_columns(spark):
    df = spark.createDataFrame(
        [(3, None, 1, "Y", "FMR", "SELECT '$vdo' AS SOR, 1 AS TOTAL_COUNT, 0 AS TOTAL_DOLLAR_AMOUNT, 0 AS FAIL_COUNT, 0 AS FAIL_DOLLAR_AMOUNT")],
        "DQ_ID bigint, DQ_CHK_ID string, DQ_QUEUE_ID bigint, DQ_LRI string, DQ_DMN string, DQ_SQL string",
    )
    run = run_queue(spark, df, config())
    row = run.results.first()
    assert (row.DQ_CHK_ID, row.SOR, row.EXECUTION_STATUS) == ("None", "NA", "SUCCESS")


def test_execution_id_default_is_one_uuid(spark, catalog):
    run = run_queue(spark, catalog.where(F.col("DQ_CHK_ID").isin("C01", "C13")), config(execution_id=None))
    ids = {r.EXECUTION_ID for r in run.results.collect()}
    assert len(ids) == 1 and re.fullmatch(r"[0-9a-f-]{36}", ids.pop())


def test_parallel_equals_sequential(spark, catalog):
    cols = [c for c in RESULT_SCHEMA.names if c not in ("EXECUTION_START_DT", "EXECUTION_END_DT", "CREATED_DT")]
    seq = run_queue(spark, catalog, config()).results.select(cols).collect()
    par = run_queue(spark, catalog, config(max_parallel_rules=4)).results.select(cols).collect()
    key = lambda r: (r.DQ_ID, r.SOR)
    assert sorted(seq, key=key) == sorted(par, key=key)


def test_region_queue_has_one_rule_per_region(spark, catalog):
    rules = collect_rules(prepared_rules(catalog, C.REGION_QUEUE, C.DOMAIN, C.FIC_MIS_DATE, C.AS_OF_DT))
    assert len(rules) == spark.table("global_temp.region").count()


def test_result_plan_has_no_forced_join(spark, catalog):
    run = run_queue(spark, catalog.where(F.col("DQ_CHK_ID").isin("C01", "C13")), config())
    logical = run.results._jdf.queryExecution().logical().toString()
    assert "strategy=broadcast" not in logical and "ResolvedHint" not in logical
    # both sides are stored, so Spark joins by their real sizes
    assert run.results._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 2


def test_cleanup_removes_staged_rows(spark, catalog):
    import os
    from urllib.parse import urlparse

    run = run_queue(spark, catalog.where(F.col("DQ_CHK_ID").isin("C01")), config())
    local = urlparse(run.staging_dir).path
    assert os.path.isdir(local)
    assert run.cleanup(spark)
    assert not os.path.exists(local)


def test_parallel_rules_inherit_job_group(spark, catalog):
    sc = spark.sparkContext
    sc.setJobGroup("dq-run-group", "rule run", interruptOnCancel=False)
    try:
        run = run_queue(spark, catalog.where(F.col("DQ_CHK_ID").isin("C01", "C05", "C06")), config(max_parallel_rules=3))
        jobs = sc.statusTracker().getJobIdsForGroup("dq-run-group")
        assert run.tally["RULES_SUCCEEDED"] == 3
        assert len(jobs) >= 4  # catalog collect + one write per rule
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        sc.setLocalProperty("spark.job.description", None)


def test_domain_must_be_known():
    with pytest.raises(ValueError, match="not one of"):
        config(domain="fmr")
    assert config(domain="XYZ", allowed_domains=()).domain == "XYZ"


def test_rules_are_numbered_in_order_across_ranges(spark):
    from rulecheck.sources.catalog import ID_RANGE, number_rules

    ids = [7, 7, None, 3, ID_RANGE, ID_RANGE - 1, 5 * ID_RANGE + 2, -4]
    rows = [(d, f"K{i}", queue) for queue in (1, 2) for i, d in enumerate(ids)]
    df = spark.createDataFrame(rows, "DQ_ID bigint, DQ_CHK_ID string, DQ_QUEUE_ID bigint")
    got = [(r.DQ_QUEUE_ID, r.DQ_CHK_ID) for r in number_rules(df).orderBy("DQ_QUEUE_ID", "RULE_SEQ").collect()]
    # a null id counts as 0 for its range and comes first in it
    want = ["K7", "K2", "K3", "K0", "K1", "K5", "K4", "K6"]
    assert got == [(q, k) for q in (1, 2) for k in want]


def test_no_window_over_a_whole_queue(spark, catalog):
    from rulecheck.sources.catalog import number_rules, project_catalog

    plan = number_rules(project_catalog(catalog))._jdf.queryExecution().executedPlan().toString()
    windows = [ln for ln in plan.split("\n") if "Window [" in ln and "row_number" in ln]
    assert windows and all("__range" in ln for ln in windows)


def test_comments_and_trailing_semicolon(spark, tables):
    ok = (
        "-- completeness of regions\n"
        "SELECT 'R' AS SOR, COUNT(*) AS TOTAL_COUNT, 0 AS TOTAL_DOLLAR_AMOUNT, /* none */ 0 AS FAIL_COUNT,\n"
        "  0 AS FAIL_DOLLAR_AMOUNT FROM global_temp.region;"
    )
    outcome, _ = one_rule(spark, ok)
    assert outcome.succeeded, outcome.error
    two = "SELECT 1 AS SOR; SELECT 2 AS SOR"
    outcome, _ = one_rule(spark, two)
    assert not outcome.succeeded and "PARSE_SYNTAX_ERROR" in outcome.error


def test_missing_catalog_column_aborts_run(spark):
    df = spark.createDataFrame(
        [(1, "A", 1, "Y", "FMR")], "DQ_ID bigint, DQ_CHK_ID string, DQ_QUEUE_ID bigint, DQ_LRI string, DQ_DMN string"
    )
    with pytest.raises(ValueError, match=r"missing columns: \['DQ_SQL'\]"):
        run_queue(spark, df, config())


def test_decimal_keys_truncate_like_int(spark):
    sql = "SELECT 'A' AS SOR, 1 AS TOTAL_COUNT, 0 AS TOTAL_DOLLAR_AMOUNT, 0 AS FAIL_COUNT, 0 AS FAIL_DOLLAR_AMOUNT"
    df = spark.createDataFrame(
        [(Decimal("7.9"), 7, Decimal("1"), "Y", "FMR", sql)],
        "DQ_ID decimal(10,1), DQ_CHK_ID int, DQ_QUEUE_ID decimal(38,0), DQ_LRI string, DQ_DMN string, DQ_SQL string",
    )
    row = run_queue(spark, df, config()).results.first()
    assert (row.DQ_ID, row.DQ_CHK_ID, row.DQ_QUEUE_ID, row.EXECUTION_STATUS) == (7, "7", 1, "SUCCESS")


def test_cancelled_run_writes_nothing_and_starts_no_further_rule(spark, tables):
    import threading
    import uuid

    from rulecheck import ParquetSink
    from rulecheck.operators.execute import RunCancelled
    from rulecheck.session import checkpoint_root

    slow = (
        "SELECT 'X' AS SOR, COUNT(*) AS TOTAL_COUNT, 0 AS TOTAL_DOLLAR_AMOUNT, 0 AS FAIL_COUNT, 0 AS FAIL_DOLLAR_AMOUNT "
        "FROM range(0, 4000000000, 1, 4) a WHERE sha2(CAST(id AS STRING), 512) = 'x'"
    )
    df = spark.createDataFrame(
        [(i, f"R{i}", 1, "Y", "FMR", slow) for i in range(3)],
        "DQ_ID bigint, DQ_CHK_ID string, DQ_QUEUE_ID bigint, DQ_LRI string, DQ_DMN string, DQ_SQL string",
    )
    sc, group, seen = spark.sparkContext, f"cancel-{uuid.uuid4().hex}", {}
    target = f"{checkpoint_root(spark)}/cancelled-{uuid.uuid4().hex}"

    def cancel_when_running():
        stop = threading.Event()
        for _ in range(600):
            jobs = [sc.statusTracker().getJobInfo(j) for j in sc.statusTracker().getJobIdsForGroup(group)]
            if any(j and j.status == "RUNNING" and seen.setdefault("started", True) for j in jobs) and seen.get("rules"):
                stop.wait(0.5)
                sc.cancelJobGroup(group)
                return
            stop.wait(0.05)

    clock = C.TickingClock()

    def counting():
        seen["rules"] = seen.get("rules", 0) + 1
        return clock()

    watcher = threading.Thread(target=cancel_when_running)
    sc.setJobGroup(group, "to be cancelled", interruptOnCancel=False)
    try:
        watcher.start()
        with pytest.raises(RunCancelled):
            run_queue(spark, df, config(clock=counting), ParquetSink(target))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        sc.setLocalProperty("spark.job.description", None)
        watcher.join()
    assert seen["rules"] == 1  # the first rule's start, nothing after it
    path = sc._jvm.org.apache.hadoop.fs.Path(target)
    assert not path.getFileSystem(sc._jsc.hadoopConfiguration()).exists(path)


def test_runs_on_one_session_overlap(spark, tables):
    import threading
    from datetime import datetime

    text = (
        "SELECT 'X' AS SOR, COUNT(*) AS TOTAL_COUNT, 0 AS TOTAL_DOLLAR_AMOUNT, 1/0 AS FAIL_COUNT, 0 AS FAIL_DOLLAR_AMOUNT "
        "FROM range(0, 6000000, 1, 1) WHERE sha2(CAST(id AS STRING), 256) = 'x'"
    )
    df = spark.createDataFrame(
        [(1, "R", 1, "Y", "FMR", text)], "DQ_ID bigint, DQ_CHK_ID string, DQ_QUEUE_ID bigint, DQ_LRI string, DQ_DMN string, DQ_SQL string"
    )
    before, runs = spark.conf.get("spark.sql.ansi.enabled"), []
    threads = [threading.Thread(target=lambda: runs.append(run_queue(spark, df, config(clock=datetime.now)))) for _ in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    a, b = (r.outcomes[0] for r in runs)
    assert a.succeeded and b.succeeded, (a.error, b.error)  # 1/0 is null: both were analysed without ANSI mode
    assert a.start < b.end and b.start < a.end
    assert spark.conf.get("spark.sql.ansi.enabled") == before


def test_whole_error_text_is_kept_outside_the_results_table(spark, catalog):
    run = run_queue(spark, catalog.where(F.col("DQ_CHK_ID").isin("C29", "C30")), config(queue_id=5))
    assert all(len(o.error) > 4000 for o in run.outcomes)
    assert {len(r.ERROR_MESSAGE) for r in run.results.collect()} == {4000}


def test_checkpoint_folder_must_be_named_on_a_cluster():
    from rulecheck.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="No checkpoint directory"):
        ensure_checkpoint_dir(Session())


def test_a_run_reads_the_catalog_once(spark, catalog, tmp_path):
    """One scan in the plan; places are those of the numbering in Spark."""
    from rulecheck.sources.catalog import number_rules, project_catalog, select_rules

    path = str(tmp_path / "catalog")
    catalog.write.parquet(path)
    stored = spark.read.parquet(path)
    prepared = prepared_rules(stored, C.QUEUE, C.DOMAIN, C.FIC_MIS_DATE, C.AS_OF_DT)
    plan = prepared._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    rules = collect_rules(prepared)
    numbered = number_rules(project_catalog(select_rules(stored, C.QUEUE, C.DOMAIN))).collect()
    assert [(r.seq, r.dq_id, r.chk_id) for r in rules] == sorted((r.RULE_SEQ, r.DQ_ID, r.DQ_CHK_ID) for r in numbered)
