"""Run one rule: render -> ``spark.sql`` -> contract check -> normalise -> stage.

All-or-nothing per rule: any error on the way (placeholders, parsing,
analysis, missing columns, a runtime error in the rule's job, a value that is
not an integer, a percentage that does not fit) gives exactly one FAILED
outcome and no staged rows, and leaves every other rule alone.

The rule's summary never goes through the driver. Its normalised rows are
written as parquet under the run's staging folder (inside the cluster's
checkpoint directory). That single write is the rule's only job: it runs the
rule's plan once, surfaces runtime errors inside this function, and cuts the
lineage, so losing an executor later cannot re-run the rule. The row count
comes from an ``Observation`` on the same job, not from a second job.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from decimal import Decimal

from py4j.protocol import Py4JError
from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from rulecheck.functions.measures import truncate_error
from rulecheck.functions.render import unresolved_message
from rulecheck.operators.normalise import normalise_summary
from rulecheck.schema import (
    DEFAULT_SOR,
    ERROR_MESSAGE_LIMIT,
    SQL_EXCERPT_LIMIT,
    STATUS_FAILED,
    STATUS_SUCCESS,
    ZERO_ROWS_MESSAGE,
)
from rulecheck.session import non_ansi
from rulecheck.sources.catalog import Rule

logger = logging.getLogger(__name__)


class RunCancelled(RuntimeError):
    """The run's jobs were cancelled, or its Spark context was stopped: no rule's failure."""


def is_cancelled(spark: SparkSession, exc: BaseException) -> bool:
    """True when Spark itself ended the job on request (by its error condition, along
    the causes; a rule's own error text can say anything) or the context is gone."""
    jsc = spark.sparkContext._jsc
    if jsc is None or jsc.sc().isStopped():
        return True
    cause = getattr(exc, "_origin", None) or getattr(exc, "java_exception", None)
    while cause is not None:
        condition = getattr(cause, "getCondition", None)
        try:
            if condition is not None and condition() == "SPARK_JOB_CANCELLED":
                return True
        except Py4JError:  # not one of Spark's own exceptions: it names no condition
            pass
        cause = cause.getCause()
    return False


@dataclass(frozen=True)
class RunContext:
    """Run parameters shared by every rule of one run."""

    execution_id: str
    fic_mis_date: str
    as_of_dt: str
    domain: str
    staging_dir: str
    clock: Callable[[], datetime] = datetime.now


@dataclass(frozen=True)
class RuleOutcome:
    rule: Rule
    status: str
    rows: int
    error: str | None
    start: datetime
    end: datetime
    stage_path: str | None

    @property
    def succeeded(self) -> bool:
        return self.status == STATUS_SUCCESS


def stage_path(ctx: RunContext, rule: Rule) -> str:
    return f"{rows_dir(ctx)}/RULE_SEQ={rule.seq}"


def rows_dir(ctx: RunContext) -> str:
    """Staged rows of all rules of a run, partitioned by ``RULE_SEQ``."""
    return f"{ctx.staging_dir}/rows"


def execute_rule(spark: SparkSession, rule: Rule, ctx: RunContext) -> RuleOutcome:
    """Execute one rule and stage its normalised rows.

    The rule text is analysed with ANSI mode off (the semantics it was written
    for). Raises :class:`RunCancelled` when the job was cancelled from outside.
    """
    start = ctx.clock()
    sc = spark.sparkContext
    caller_description = sc.getLocalProperty("spark.job.description")
    sc.setJobDescription(f"rule DQ_ID={rule.dq_id} DQ_CHK_ID={rule.chk_id}")
    try:
        if rule.rendered_sql is None:  # the catalog holds no text
            raise ValueError("DQ_SQL is null")
        if rule.unresolved:
            raise ValueError(unresolved_message(list(rule.unresolved), rule.rendered_sql))
        with non_ansi(spark):
            staged = normalise_summary(spark.sql(rule.rendered_sql))
        observation = Observation(f"rule_{rule.seq}_{uuid.uuid4().hex[:8]}")
        path = stage_path(ctx, rule)
        staged.observe(observation, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
        rows = int(observation.get["rows"])
        if rows == 0:
            raise ValueError(ZERO_ROWS_MESSAGE)
        end = ctx.clock()
        logger.info("rule %s staged %d row(s) in %s", rule.dq_id, rows, end - start)
        return RuleOutcome(rule, STATUS_SUCCESS, rows, None, start, end, path)
    except Exception as exc:  # any other failure is this rule's, never the run's
        if is_cancelled(spark, exc):
            raise RunCancelled(f"cancelled during rule {rule.dq_id}") from exc
        end = ctx.clock()
        logger.error("rule %s gives a failure row: %s", rule.dq_id, exc)
        return RuleOutcome(rule, STATUS_FAILED, 1, str(exc), start, end, None)
    finally:
        if sc._jsc is not None:
            sc.setLocalProperty("spark.job.description", caller_description)


def stored_error(outcome: RuleOutcome) -> str | None:
    """Error text as the results table words it: a short excerpt of unresolved rule text."""
    r = outcome.rule
    if r.rendered_sql is not None and r.unresolved:
        return unresolved_message(list(r.unresolved), r.rendered_sql, SQL_EXCERPT_LIMIT)
    return outcome.error


def failure_values(outcome: RuleOutcome, ctx: RunContext) -> tuple:
    """The one result row of a failed rule, in result-column order; only here is its
    error text cut to the column's size (the outcome and the log keep all of it)."""
    r = outcome.rule
    zero_pct = Decimal("0.00")
    return (
        r.dq_id,
        r.chk_id,
        r.queue_id,
        ctx.execution_id,
        ctx.fic_mis_date,
        ctx.as_of_dt,
        ctx.domain,
        DEFAULT_SOR,
        0,
        0,
        0,
        0,
        zero_pct,
        zero_pct,
        STATUS_FAILED,
        truncate_error(stored_error(outcome), ERROR_MESSAGE_LIMIT),
        outcome.start,
        outcome.end,
        outcome.end,
    )
