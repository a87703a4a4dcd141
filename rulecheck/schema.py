"""Fixed names, types and limits of the rule catalog, the rule summary and the
results table.

Everything in the "fixed values" block must stay equal to the behaviour this
engine reproduces: column names and types of the results table, the five
summary names, the placeholder tokens in their replacement order, the pattern
that detects an unresolved placeholder and the message limits.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# --- fixed values -----------------------------------------------------------
# Results table, in this column order.
RESULT_SCHEMA = StructType(
    [
        StructField("DQ_ID", LongType(), False),
        StructField("DQ_CHK_ID", StringType(), False),
        StructField("DQ_QUEUE_ID", LongType(), False),
        StructField("EXECUTION_ID", StringType(), False),
        StructField("RUN_FIC_MIS_DATE", StringType(), True),
        StructField("RUN_AS_OF_DT", StringType(), True),
        StructField("RUN_DMN", StringType(), True),
        StructField("SOR", StringType(), False),
        StructField("TOTAL_COUNT", LongType(), True),
        StructField("TOTAL_DOLLAR_AMOUNT", LongType(), True),
        StructField("FAIL_COUNT", LongType(), True),
        StructField("FAIL_DOLLAR_AMOUNT", LongType(), True),
        StructField("FAIL_COUNT_PERCENTAGE", DecimalType(5, 2), True),
        StructField("FAIL_DOLLAR_PERCENTAGE", DecimalType(5, 2), True),
        StructField("EXECUTION_STATUS", StringType(), True),
        StructField("ERROR_MESSAGE", StringType(), True),
        StructField("EXECUTION_START_DT", TimestampType(), True),
        StructField("EXECUTION_END_DT", TimestampType(), True),
        StructField("CREATED_DT", TimestampType(), True),
    ]
)

# Columns every rule summary must have (matched case-insensitively).
SUMMARY_COLUMNS = ("SOR", "TOTAL_COUNT", "TOTAL_DOLLAR_AMOUNT", "FAIL_COUNT", "FAIL_DOLLAR_AMOUNT")

# Catalog columns that are read; DQ_SCHEMA and DQ_SOR may be absent.
CATALOG_COLUMNS = ("DQ_ID", "DQ_CHK_ID", "DQ_QUEUE_ID", "DQ_LRI", "DQ_DMN", "DQ_SCHEMA", "DQ_SOR", "DQ_SQL")
OPTIONAL_CATALOG_COLUMNS = ("DQ_SCHEMA", "DQ_SOR")
ACTIVE_FLAG = "Y"
DOMAINS = ("FMR", "EIDF")

# Placeholder tokens, replaced literally and case-sensitively in this order:
# $ds -> rule schema, $vdo -> rule source label, $misdate -> business date,
# $asofdt -> as-of date.
PLACEHOLDER_TOKENS = ("$ds", "$vdo", "$misdate", "$asofdt")
UNRESOLVED_PATTERN = r"\$[a-zA-Z_]+"

STATUS_SUCCESS = "SUCCESS"
STATUS_FAILED = "FAILED"
DEFAULT_SOR = "NA"
ERROR_MESSAGE_LIMIT = 4000
SQL_EXCERPT_LIMIT = 500
ZERO_ROWS_MESSAGE = "DQ SQL returned zero rows."
UNRESOLVED_MESSAGE = "Unresolved placeholders in SQL: {unresolved}. Final SQL: {sql}"
MISSING_COLUMNS_MESSAGE = "Result is missing required columns: {missing}. Got: {got}"

# JDBC: rows fetched per round trip when reading the catalog; rows per INSERT
# batch and transaction isolation when appending results.
CATALOG_FETCH_SIZE = 10000
JDBC_BATCH_SIZE = 1000
JDBC_ISOLATION_LEVEL = "NONE"
# --- end of fixed values ----------------------------------------------------

MEASURE_COLUMNS = SUMMARY_COLUMNS[1:]
PERCENT_TYPE = DecimalType(5, 2)
# Largest value of DECIMAL(5,2), in hundredths.
PERCENT_LIMIT_HUNDREDTHS = 99999

# What a rule's summary is staged as: label and the four integer measures
# (percentages are derived from these when a run's rows are assembled).
STAGED_SCHEMA = StructType([RESULT_SCHEMA[name] for name in ("SOR",) + MEASURE_COLUMNS])

# Per-rule outcome kept for a run: one row per executed rule.
OUTCOME_SCHEMA = StructType(
    [
        StructField("RULE_SEQ", IntegerType(), False),
        StructField("DQ_ID", LongType(), False),
        StructField("DQ_CHK_ID", StringType(), False),
        StructField("DQ_QUEUE_ID", LongType(), False),
        StructField("EXECUTION_STATUS", StringType(), False),
        StructField("ERROR_MESSAGE", StringType(), True),
        StructField("RESULT_ROWS", LongType(), False),
        StructField("EXECUTION_START_DT", TimestampType(), True),
        StructField("EXECUTION_END_DT", TimestampType(), True),
    ]
)

RESULT_COLUMNS = tuple(f.name for f in RESULT_SCHEMA.fields)
TIME_COLUMNS = ("EXECUTION_START_DT", "EXECUTION_END_DT", "CREATED_DT")
