"""A whole run over one queue: select -> order -> execute each rule -> one
result frame -> one append.

Only the rule list (metadata) is collected. Each rule's summary rows are
staged by its own job (see :mod:`rulecheck.operators.execute`); the run's
result frame is then one scan over the staged folders of the successful rules,
with the exact percentages computed in one projection for all of them, stamped
with per-rule keys and times by a join against the outcome table (one row per
rule, staged next to the rows, so Spark knows its size), plus one row per failed
rule.
"""

from __future__ import annotations

import logging
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from rulecheck.operators.execute import RuleOutcome, RunCancelled, RunContext, execute_rule, failure_values, rows_dir
from rulecheck.operators.normalise import with_percentages
from rulecheck.schema import (
    DOMAINS,
    OUTCOME_SCHEMA,
    RESULT_COLUMNS,
    RESULT_SCHEMA,
    STAGED_SCHEMA,
    STATUS_FAILED,
    STATUS_SUCCESS,
)
from rulecheck.session import delete_folder, new_staging_dir
from rulecheck.sinks.results import append_results
from rulecheck.sources.catalog import Rule, collect_rules, prepared_rules

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class RunConfig:
    queue_id: int
    domain: str
    fic_mis_date: str
    as_of_dt: str
    execution_id: str | None = None
    clock: Callable[[], datetime] = datetime.now
    # Rules submitted concurrently (Spark runs their jobs side by side).
    max_parallel_rules: int = 1
    allowed_domains: tuple[str, ...] = DOMAINS

    def __post_init__(self) -> None:
        if self.allowed_domains and self.domain not in self.allowed_domains:
            raise ValueError(f"Domain {self.domain!r} is not one of {list(self.allowed_domains)}")


@dataclass
class RunResult:
    execution_id: str
    rules: list[Rule]
    outcomes: list[RuleOutcome]
    results: DataFrame
    staging_dir: str | None
    written: bool = False

    def cleanup(self, spark: SparkSession) -> bool:
        """Delete the run's staged rule output, which ``results`` reads. A run with a
        sink does this itself after the append; without one, call it when the
        results are no longer needed."""
        folder, self.staging_dir = self.staging_dir, None
        return bool(folder) and delete_folder(spark, folder)

    @property
    def tally(self) -> dict[str, int]:
        succeeded = sum(1 for o in self.outcomes if o.succeeded)
        return {
            "RULES_TOTAL": len(self.outcomes),
            "RULES_SUCCEEDED": succeeded,
            "RULES_FAILED": len(self.outcomes) - succeeded,
            "RESULT_ROWS": sum(o.rows for o in self.outcomes),
        }


def resolve_execution_id(execution_id: str | None) -> str:
    """The given id when non-empty, else one random UUID for the whole run."""
    return execution_id or str(uuid.uuid4())


def empty_results(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RESULT_SCHEMA)


def execute_rules(spark: SparkSession, rules: list[Rule], ctx: RunContext, max_parallel: int = 1) -> list[RuleOutcome]:
    """Execute rules in their order; with ``max_parallel > 1`` their jobs are submitted
    from threads that inherit the caller's job group, tags and other local properties,
    and share the cluster. Outcomes keep rule order. A cancelled run starts no
    further rule and raises."""
    sc = spark.sparkContext
    stop = threading.Event()
    # Under FAIR scheduling, a pool per rule thread lets small rules get
    # executors while a large one runs (pools named here are created on use).
    own_pools = max_parallel > 1 and sc.getLocalProperty("spark.scheduler.pool") is None and sc.getConf().get("spark.scheduler.mode", "FIFO") == "FAIR"

    def run_one(rule: Rule) -> RuleOutcome:
        if stop.is_set():
            raise RunCancelled(f"not started: rule {rule.dq_id}")
        if own_pools:
            sc.setLocalProperty("spark.scheduler.pool", f"rulecheck-{threading.current_thread().name}")
        try:
            return execute_rule(spark, rule, ctx)
        except RunCancelled:
            stop.set()
            raise

    if max_parallel <= 1:
        return [run_one(rule) for rule in rules]
    with ThreadPoolExecutor(max_workers=max_parallel, thread_name_prefix="rule") as pool:
        started = [pool.submit(inheritable_thread_target(spark)(run_one), rule) for rule in rules]
        return [future.result() for future in started]


def outcome_frame(spark: SparkSession, outcomes: list[RuleOutcome]) -> DataFrame:
    """One row per executed rule (metadata: status, row count, times)."""
    rows = [
        (o.rule.seq, o.rule.dq_id, o.rule.chk_id, o.rule.queue_id, o.status, o.error, o.rows, o.start, o.end)
        for o in outcomes
    ]
    return spark.createDataFrame(rows, OUTCOME_SCHEMA)


def _run_stamps(ctx: RunContext) -> dict[str, F.Column]:
    return {
        "EXECUTION_ID": F.lit(ctx.execution_id),
        "RUN_FIC_MIS_DATE": F.lit(ctx.fic_mis_date),
        "RUN_AS_OF_DT": F.lit(ctx.as_of_dt),
        "RUN_DMN": F.lit(ctx.domain),
    }


def staged_results(spark: SparkSession, outcomes: list[RuleOutcome], ctx: RunContext) -> DataFrame | None:
    """Result rows of the successful rules: one scan over the run's staged rows,
    keys and times joined from the outcome table, which also leaves out what a failed
    rule may have staged. The outcome table is staged too, so its real size decides
    how Spark joins; a rule with very many rows is split like any skewed key."""
    ok = [o for o in outcomes if o.status == STATUS_SUCCESS]
    if not ok:
        return None
    schema = StructType(STAGED_SCHEMA.fields + [StructField("RULE_SEQ", IntegerType(), False)])
    staged = with_percentages(spark.read.schema(schema).parquet(rows_dir(ctx)))
    path = f"{ctx.staging_dir}/outcomes"
    outcome_frame(spark, ok).drop("ERROR_MESSAGE", "EXECUTION_STATUS", "RESULT_ROWS").write.mode("overwrite").parquet(path)
    joined = staged.join(spark.read.parquet(path), on="RULE_SEQ", how="inner")
    stamps = _run_stamps(ctx)
    cols = []
    for name in RESULT_COLUMNS:
        if name in stamps:
            cols.append(stamps[name].alias(name))
        elif name == "EXECUTION_STATUS":
            cols.append(F.lit(STATUS_SUCCESS).alias(name))
        elif name == "ERROR_MESSAGE":
            cols.append(F.lit(None).cast("string").alias(name))
        elif name == "CREATED_DT":
            cols.append(F.col("EXECUTION_END_DT").alias(name))
        else:
            cols.append(F.col(name))
    return joined.select(*cols)


def failure_results(spark: SparkSession, outcomes: list[RuleOutcome], ctx: RunContext) -> DataFrame | None:
    """One row per failed rule (at most one row per rule of the catalog)."""
    failed = [failure_values(o, ctx) for o in outcomes if o.status == STATUS_FAILED]
    if not failed:
        return None
    return spark.createDataFrame(failed, RESULT_SCHEMA)


def union_results(frames: list[DataFrame | None], spark: SparkSession) -> DataFrame:
    """All rows of all rules, duplicates kept."""
    present = [f for f in frames if f is not None]
    if not present:
        return empty_results(spark)
    return reduce(lambda a, b: a.unionByName(b), present)


def assemble_results(spark: SparkSession, outcomes: list[RuleOutcome], ctx: RunContext) -> DataFrame:
    return union_results([staged_results(spark, outcomes, ctx), failure_results(spark, outcomes, ctx)], spark)


def tally_frame(spark: SparkSession, outcomes: list[RuleOutcome]) -> DataFrame:
    """Rules succeeded / failed / total and result rows, as a one-row frame."""
    o = outcome_frame(spark, outcomes)
    return o.agg(
        F.count(F.lit(1)).cast("bigint").alias("RULES_TOTAL"),
        F.count_if(F.col("EXECUTION_STATUS") == STATUS_SUCCESS).cast("bigint").alias("RULES_SUCCEEDED"),
        F.count_if(F.col("EXECUTION_STATUS") == STATUS_FAILED).cast("bigint").alias("RULES_FAILED"),
        F.coalesce(F.sum("RESULT_ROWS"), F.lit(0)).cast("bigint").alias("RESULT_ROWS"),
    )


def run_queue(
    spark: SparkSession,
    catalog: DataFrame,
    config: RunConfig,
    sink=None,
) -> RunResult:
    """Run every active rule of ``config.queue_id`` / ``config.domain``.

    Rule failures never stop the run; each gives one FAILED row. An empty
    queue gives an empty result and writes nothing. Errors that make the run
    itself impossible (unreadable catalog, a rule without an integer id, a
    failed write, cancelled jobs, a stopped context) raise, and nothing is
    appended.

    Without a sink, ``results`` is lazy and reads the run's staged rows, which
    stay until :meth:`RunResult.cleanup`. With a sink, the staged rows are deleted
    after the append and ``results`` reads this run's rows from the sink.
    """
    execution_id = resolve_execution_id(config.execution_id)
    rules = collect_rules(
        prepared_rules(catalog, config.queue_id, config.domain, config.fic_mis_date, config.as_of_dt)
    )
    logger.info("run %s has %d rule(s): queue %s, domain %s", execution_id, len(rules), config.queue_id, config.domain)
    if not rules:
        logger.warning("queue %s holds nothing to run for domain %s", config.queue_id, config.domain)
        return RunResult(execution_id, [], [], empty_results(spark), None)

    ctx = RunContext(
        execution_id=execution_id,
        fic_mis_date=config.fic_mis_date,
        as_of_dt=config.as_of_dt,
        domain=config.domain,
        staging_dir=new_staging_dir(spark, execution_id),
        clock=config.clock,
    )
    outcomes = execute_rules(spark, rules, ctx, config.max_parallel_rules)
    results = assemble_results(spark, outcomes, ctx)
    run = RunResult(execution_id, rules, outcomes, results, ctx.staging_dir)
    tally = run.tally
    logger.info("run %s ended, rules by outcome: %s", execution_id, tally)
    if sink is not None:
        run.written = append_results(results, sink, tally["RESULT_ROWS"])
        if run.written:
            run.results = sink.read(spark).where(F.col("EXECUTION_ID") == execution_id)
            run.cleanup(spark)
    return run
