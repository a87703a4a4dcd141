"""rulecheck: a Spark-native data-quality rule engine.

Rules are SQL texts in a catalog table. A run selects a queue's active rules,
fills their placeholders, runs each one with Spark SQL over tables of any size,
turns each summary into typed result rows with Column expressions and appends
all rows of the run to a results table.
"""

from rulecheck.plans.run import RunConfig, RunResult, run_queue
from rulecheck.schema import RESULT_SCHEMA, SUMMARY_COLUMNS
from rulecheck.sinks.results import JdbcSink, ParquetSink, TableSink

__all__ = [
    "RESULT_SCHEMA",
    "SUMMARY_COLUMNS",
    "JdbcSink",
    "ParquetSink",
    "RunConfig",
    "RunResult",
    "TableSink",
    "run_queue",
]
