"""Rule corpus used by the tests, ``__spark_entry__`` and ``bench.py``.

The catalog is the union of
  * hand-written rules (queue 1: rules that run and rules that must fail;
    rows that must not be selected; rendering cases in queue 9),
  * one rule per region, derived by Spark from ``region`` (queue 3): as many rules
    at any size, each over all line items of its region's suppliers, with one
    summary row per supplier, and
  * one catalog row per supplier, derived by Spark from ``supplier`` (queue 6): rows
    to be read, selected, rendered and ordered as the data grows, never run.

Each hand-written rule records what a run must produce for it: ``None`` for a
successful rule, else the expected ``ERROR_TEXT`` (the engine error class in
brackets, or the engine's own message).
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType, StructField, StructType

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Run parameters of the checks.
QUEUE = 1
REGION_QUEUE = 3
SUPPLIER_QUEUE = 6
RENDER_QUEUE = 9
UNION_QUEUE = 7
DOMAIN = "FMR"
FIC_MIS_DATE = "2024-01-15"
AS_OF_DT = "2000-12-31"
EXECUTION_ID = "exec-check-0001"
SCHEMA = "global_temp"
SOR = "SRC"
CLOCK_START = datetime(2024, 1, 15, 6, 0, 0)


class TickingClock:
    """Deterministic clock: each call returns the next second after CLOCK_START."""

    def __init__(self, start: datetime = CLOCK_START):
        self._next = start

    def __call__(self) -> datetime:
        now = self._next
        self._next = now + timedelta(seconds=1)
        return now


@dataclass(frozen=True)
class CorpusRule:
    dq_id: int
    chk_id: str | None
    sql: str | None
    queue: int = QUEUE
    lri: str | None = "Y"
    domain: str | None = DOMAIN
    schema: str | None = SCHEMA
    sor: str | None = SOR
    # None: the rule succeeds; else the expected ERROR_TEXT (SQL expression for DuckDB).
    error: str | None = None
    # The rule's values decide whether it fails: the checks derive that from the tables.
    by_value: bool = False
    desc: str = ""


_C01 = """SELECT c_mktsegment AS sor, COUNT(*) AS total_count,
  SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS total_dollar_amount,
  SUM(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) AS fail_count,
  SUM(CASE WHEN c_acctbal < 0 THEN ABS(CAST(c_acctbal AS DECIMAL(18,2))) END) AS fail_dollar_amount
FROM $ds.customer GROUP BY c_mktsegment"""

_C02 = """SELECT '$vdo' AS SOR, COUNT(*) AS TOTAL_COUNT, SUM(amt) AS TOTAL_DOLLAR_AMOUNT,
  SUM(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS FAIL_COUNT,
  SUM(CASE WHEN n > 1 THEN amt END) AS FAIL_DOLLAR_AMOUNT
FROM (SELECT CAST(l_extendedprice AS DECIMAL(18,2)) AS amt,
        COUNT(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n FROM $ds.lineitem) x"""

_C03 = """SELECT o.o_orderstatus AS SOR, COUNT(*) AS TOTAL_COUNT,
  SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS TOTAL_DOLLAR_AMOUNT,
  SUM(CASE WHEN l.l_shipdate < o.o_orderdate THEN 1 ELSE 0 END) AS FAIL_COUNT,
  SUM(CASE WHEN l.l_shipdate < o.o_orderdate THEN CAST(l.l_extendedprice AS DECIMAL(18,2)) END) AS FAIL_DOLLAR_AMOUNT
FROM $ds.lineitem l JOIN $ds.orders o ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderstatus"""

_C04 = """SELECT '$vdo' AS SOR, COUNT(*) AS TOTAL_COUNT,
  SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS TOTAL_DOLLAR_AMOUNT,
  SUM(CASE WHEN l.k IS NULL THEN 1 ELSE 0 END) AS FAIL_COUNT,
  SUM(CASE WHEN l.k IS NULL THEN CAST(o.o_totalprice AS DECIMAL(18,2)) END) AS FAIL_DOLLAR_AMOUNT
FROM $ds.orders o LEFT JOIN (SELECT DISTINCT l_orderkey AS k FROM $ds.lineitem) l ON o.o_orderkey = l.k"""

_C05 = """SELECT '$vdo' AS SOR, COUNT(*) AS TOTAL_COUNT,
  SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS TOTAL_DOLLAR_AMOUNT,
  SUM(CASE WHEN o_orderdate > CAST('$asofdt' AS TIMESTAMP) THEN 1 ELSE 0 END) AS FAIL_COUNT,
  SUM(CASE WHEN o_orderdate > CAST('$asofdt' AS TIMESTAMP) THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS FAIL_DOLLAR_AMOUNT
FROM $ds.orders"""

_C06 = """SELECT '$vdo' AS SOR, COUNT(*) AS TOTAL_COUNT, 0 AS TOTAL_DOLLAR_AMOUNT,
  SUM(CASE WHEN p_name IS NULL THEN 1 ELSE 0 END) AS FAIL_COUNT, 0 AS FAIL_DOLLAR_AMOUNT
FROM $ds.part"""

_C07 = """SELECT CAST(NULL AS STRING) AS SOR, COUNT(*) AS TOTAL_COUNT,
  SUM(CAST(s_acctbal AS DECIMAL(18,2))) AS TOTAL_DOLLAR_AMOUNT,
  SUM(CAST(s_nationkey AS BIGINT)) AS FAIL_COUNT,
  SUM(CAST(s_acctbal AS DECIMAL(18,2))) AS FAIL_DOLLAR_AMOUNT
FROM $ds.supplier WHERE s_suppkey < 0"""

_C08 = """SELECT r_name AS SOR, COUNT(*) AS TOTAL_COUNT, 0 AS TOTAL_DOLLAR_AMOUNT, 0 AS FAIL_COUNT,
  0 AS FAIL_DOLLAR_AMOUNT FROM $ds.region WHERE r_regionkey < 0 GROUP BY r_name"""

_C09 = """SELECT event_type AS SOR, COUNT(*) AS TOTAL_COUNT,
  SUM(CAST(value AS DECIMAL(18,2))) AS TOTAL_DOLLAR_AMOUNT,
  SUM(CASE WHEN value > 100 THEN 1 ELSE 0 END) AS FAIL_COUNT,
  SUM(CASE WHEN value > 100 THEN CAST(value AS DECIMAL(18,2)) END) AS FAIL_DOLLAR_AMOUNT
FROM $ds.events WHERE ts >= CAST('$misdate' AS TIMESTAMP) GROUP BY ROLLUP(event_type)"""

# 23 of 160 from the 25 nations: a tie at the second decimal.
_C10 = """SELECT 'TIE' AS SOR, 6 * COUNT(*) + 10 AS TOTAL_COUNT, CAST(COUNT(DISTINCT n_regionkey) AS DECIMAL(9,2)) - 3.01 AS TOTAL_DOLLAR_AMOUNT,
  COUNT(*) - 2 AS FAIL_COUNT, CAST(COUNT(DISTINCT n_regionkey) AS DECIMAL(9,2)) - 4.01 AS FAIL_DOLLAR_AMOUNT, MAX(n_name) AS EXTRA
FROM $ds.nation"""

_C11 = "SELECT r_name AS SOR, COUNT(*) AS TOTAL_COUNT FROM $ds.region GROUP BY r_name"

_C12 = """SELECT '$vdo' AS SOR, COUNT(*) AS TOTAL_COUNT, 0 AS TOTAL_DOLLAR_AMOUNT, 0 AS FAIL_COUNT,
  0 AS FAIL_DOLLAR_AMOUNT FROM $ds.$foo"""

_C16 = """SELECT 'X' AS SOR, 1 AS TOTAL_COUNT, 1 AS TOTAL_DOLLAR_AMOUNT,
  CASE WHEN raise_error('boom') IS NULL THEN 0 END AS FAIL_COUNT, 0 AS FAIL_DOLLAR_AMOUNT FROM $ds.region"""

_C17 = """SELECT r_name AS SOR, CONCAT(CAST(COUNT(*) AS STRING), '.5') AS TOTAL_COUNT, 0 AS TOTAL_DOLLAR_AMOUNT,
  0 AS FAIL_COUNT, 0 AS FAIL_DOLLAR_AMOUNT FROM $ds.region GROUP BY r_name"""

_C18 = """SELECT r_name AS SOR, CASE WHEN r_regionkey = 1 THEN 'abc' ELSE '5' END AS TOTAL_COUNT,
  0 AS TOTAL_DOLLAR_AMOUNT, 0 AS FAIL_COUNT, 0 AS FAIL_DOLLAR_AMOUNT FROM $ds.region"""

_C19 = """SELECT 'X' AS SOR, 1 AS TOTAL_COUNT, 0 AS TOTAL_DOLLAR_AMOUNT, COUNT(*) AS FAIL_COUNT,
  0 AS FAIL_DOLLAR_AMOUNT FROM $ds.orders"""

# Per-customer summary (one summary row per customer that has orders).
_C26 = """SELECT CAST(o.o_custkey AS STRING) AS SOR, COUNT(*) AS TOTAL_COUNT,
  SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS TOTAL_DOLLAR_AMOUNT,
  SUM(CASE WHEN l.l_shipdate < o.o_orderdate THEN 1 ELSE 0 END) AS FAIL_COUNT,
  SUM(CASE WHEN l.l_shipdate < o.o_orderdate THEN CAST(l.l_extendedprice AS DECIMAL(18,2)) END) AS FAIL_DOLLAR_AMOUNT
FROM $ds.lineitem l JOIN $ds.orders o ON l.l_orderkey = o.o_orderkey GROUP BY o.o_custkey"""

# Orders without line items, through NOT EXISTS (an anti join in Spark).
_C27 = """SELECT o_orderpriority AS SOR, COUNT(*) AS TOTAL_COUNT,
  SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS TOTAL_DOLLAR_AMOUNT,
  SUM(CASE WHEN empty THEN 1 ELSE 0 END) AS FAIL_COUNT,
  SUM(CASE WHEN empty THEN CAST(o_totalprice AS DECIMAL(18,2)) END) AS FAIL_DOLLAR_AMOUNT
FROM (SELECT o.o_orderpriority, o.o_totalprice,
        NOT EXISTS (SELECT 1 FROM $ds.lineitem l WHERE l.l_orderkey = o.o_orderkey) AS empty FROM $ds.orders o) x
GROUP BY o_orderpriority"""

# Grouping sets over a join with a dimension table.
_C28 = """SELECT COALESCE(n.n_name, 'ALL') AS SOR, COUNT(*) AS TOTAL_COUNT,
  SUM(CAST(c.c_acctbal AS DECIMAL(18,2))) AS TOTAL_DOLLAR_AMOUNT,
  SUM(CASE WHEN c.c_acctbal < 0 THEN 1 ELSE 0 END) AS FAIL_COUNT,
  SUM(CASE WHEN c.c_acctbal < 0 THEN CAST(c.c_acctbal AS DECIMAL(18,2)) END) AS FAIL_DOLLAR_AMOUNT
FROM $ds.customer c JOIN $ds.nation n ON c.c_nationkey = n.n_nationkey
GROUP BY GROUPING SETS ((n.n_name), ())"""

# A rule whose rendered text keeps so many placeholders that the message
# exceeds the 4000-character limit.
_C29 = (
    "SELECT '$vdo' AS SOR, COUNT(*) AS TOTAL_COUNT, 0 AS TOTAL_DOLLAR_AMOUNT, 0 AS FAIL_COUNT, "
    "0 AS FAIL_DOLLAR_AMOUNT FROM $ds.customer WHERE c_mktsegment IN ("
    + ", ".join(f"'$seg_{a}{b}'" for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz")
    + ")"
)

# A runtime error whose text (it carries the lineitem row count) exceeds 4000 characters.
_C30 = """SELECT 'X' AS SOR, n AS TOTAL_COUNT, 0 AS TOTAL_DOLLAR_AMOUNT,
  CASE WHEN n >= 0 THEN raise_error(concat('lineitem rows: ', CAST(n AS STRING), ' ', repeat('x', 5000))) ELSE n END
    AS FAIL_COUNT, 0 AS FAIL_DOLLAR_AMOUNT
FROM (SELECT COUNT(*) AS n FROM $ds.lineitem) t"""

# Window: orders of a customer on a day beyond the first one, per priority.
_C31 = """SELECT o_orderpriority AS SOR, COUNT(*) AS TOTAL_COUNT, SUM(amt) AS TOTAL_DOLLAR_AMOUNT,
  SUM(CASE WHEN rn > 1 THEN 1 ELSE 0 END) AS FAIL_COUNT, SUM(CASE WHEN rn > 1 THEN amt END) AS FAIL_DOLLAR_AMOUNT
FROM (SELECT o_orderpriority, CAST(o_totalprice AS DECIMAL(18,2)) AS amt,
        ROW_NUMBER() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey) AS rn FROM $ds.orders) x
GROUP BY o_orderpriority"""

# A summary that holds the same row twice, once per half.
_C32_HALF = """SELECT o_orderstatus AS SOR, COUNT(*) AS TOTAL_COUNT, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS TOTAL_DOLLAR_AMOUNT,
  SUM(CASE WHEN o_orderdate > TIMESTAMP '$asofdt 00:00:00' THEN 1 ELSE 0 END) AS FAIL_COUNT, 0 AS FAIL_DOLLAR_AMOUNT
FROM $ds.orders GROUP BY o_orderstatus"""
_C32 = f"{_C32_HALF} UNION ALL {_C32_HALF}"

# Expected ERROR_TEXT of failing rules, as DuckDB SQL expressions.
ZERO_ROWS = "'DQ SQL returned zero rows.'"
PARSE = "'[PARSE_SYNTAX_ERROR]'"
NOT_FOUND = "'[TABLE_OR_VIEW_NOT_FOUND]'"
RAISED = "'[USER_RAISED_EXCEPTION]'"
UNRESOLVED = "@unresolved"  # computed from the catalog text by the oracle

CORPUS: tuple[CorpusRule, ...] = (
    CorpusRule(1, "C01", _C01, desc="range check, GROUP BY label, lower-case names"),
    CorpusRule(2, "C02", _C02, desc="window, duplicate keys"),
    CorpusRule(3, "C03", _C03, desc="join, cross-table dates"),
    CorpusRule(4, "C04", _C04, desc="left join on distinct keys, orphans"),
    CorpusRule(5, "C05", _C05, desc="$asofdt"),
    CorpusRule(6, "C06", _C06, desc="completeness, all pass"),
    CorpusRule(7, "C07", _C07, desc="empty input: null label and sums"),
    CorpusRule(8, "C08", _C08, error=ZERO_ROWS, desc="zero summary rows"),
    CorpusRule(9, "C09", _C09, desc="ROLLUP, $misdate"),
    CorpusRule(10, "C10", _C10, desc="rounding tie, truncation, extra column"),
    CorpusRule(
        11,
        "C11",
        _C11,
        error="'Result is missing required columns: [''FAIL_COUNT'', ''FAIL_DOLLAR_AMOUNT'', "
        "''TOTAL_DOLLAR_AMOUNT'']. Got: [''SOR'', ''TOTAL_COUNT'']'",
        desc="missing columns",
    ),
    CorpusRule(12, "C12", _C12, error=UNRESOLVED, desc="unresolved placeholder"),
    CorpusRule(13, "C13", "SELEC 1", error=PARSE, desc="parse error"),
    CorpusRule(14, "C14", "SELECT * FROM $ds.nope", error=NOT_FOUND, desc="unknown table"),
    CorpusRule(15, "C15", "SELECT * FROM $ds.customer", schema=None, error=PARSE, desc="null schema"),
    CorpusRule(16, "C16", _C16, error=RAISED, desc="runtime error in the rule's job"),
    CorpusRule(17, "C17", _C17, error=RAISED, by_value=True, desc="fractional text measure"),
    CorpusRule(18, "C18", _C18, error=RAISED, by_value=True, desc="one bad row fails the rule"),
    CorpusRule(19, "C19", _C19, error=RAISED, by_value=True, desc="percentage beyond DECIMAL(5,2)"),
    CorpusRule(20, "C20", None, error="'DQ_SQL is null'", desc="null rule text"),
    # never selected for queue 1 / FMR
    CorpusRule(21, "C21", _C06, lri="N", desc="inactive"),
    CorpusRule(22, "C22", _C06, lri=None, desc="null active flag"),
    CorpusRule(23, "C23", _C06, domain="EIDF", desc="other domain"),
    CorpusRule(24, "C24", _C06, domain="fmr", desc="domain case differs"),
    CorpusRule(25, "C25", _C06, queue=2, desc="other queue"),
    # summaries used by specific checks (queue 4 / 5)
    CorpusRule(26, "C26", _C26, queue=4, desc="per-customer summary"),
    CorpusRule(27, "C27", _C27, queue=4, desc="NOT EXISTS anti join"),
    CorpusRule(28, "C28", _C28, queue=4, desc="grouping sets over a join"),
    CorpusRule(31, "C31", _C31, queue=4, desc="ROW_NUMBER window per customer and day"),
    CorpusRule(29, "C29", _C29, queue=5, error=UNRESOLVED, desc="error text over 4000 characters"),
    CorpusRule(30, "C30", _C30, queue=5, error=RAISED, desc="runtime error text over 4000 characters"),
    # equal rows within a summary and between rules, and a failure (queue 7)
    CorpusRule(32, "C32", _C32, queue=UNION_QUEUE, desc="equal rows in one summary"),
    CorpusRule(33, "C33", _C32_HALF, queue=UNION_QUEUE, desc="the same summary in another rule"),
    CorpusRule(34, "C34", _C08, queue=UNION_QUEUE, error=ZERO_ROWS, desc="a failure among them"),
    # rendering cases (queue 9, never executed)
    CorpusRule(91, "R1", "$ds.t $dsx $vdo $DS", queue=RENDER_QUEUE, schema="S", sor=None),
    CorpusRule(92, "R2", "a $x ${y} $1 $_Z", queue=RENDER_QUEUE, schema="S", sor="V"),
    CorpusRule(93, "R3", "$ds", queue=RENDER_QUEUE, schema="p$vdo", sor="Q"),
    CorpusRule(94, "R4", "$vdo", queue=RENDER_QUEUE, schema="S", sor="$ds"),
    CorpusRule(95, "R5", "SELECT '$USD' AS SOR", queue=RENDER_QUEUE),
    CorpusRule(96, "R6", "SELECT get_json_object(j, '$.a') FROM t", queue=RENDER_QUEUE),
    CorpusRule(97, None, "SELECT 1", queue=RENDER_QUEUE, desc="null check id"),
)

BY_CHK = {r.chk_id: r for r in CORPUS if r.chk_id}

# Catalog as an Oracle-style table: NUMBER keys arrive as DECIMAL(38,0).
CATALOG_SCHEMA = StructType(
    [
        StructField("DQ_ID", DecimalType(38, 0), True),
        StructField("DQ_CHK_ID", StringType(), True),
        StructField("DQ_QUEUE_ID", DecimalType(38, 0), True),
        StructField("DQ_LRI", StringType(), True),
        StructField("DQ_DMN", StringType(), True),
        StructField("DQ_SCHEMA", StringType(), True),
        StructField("DQ_SOR", StringType(), True),
        StructField("DQ_SQL", StringType(), True),
        StructField("DQ_DESC", StringType(), True),
    ]
)

# Rule text per region, completed by Spark from the region table.
REGION_SQL_HEAD = (
    "SELECT s.s_name AS SOR, COUNT(*) AS TOTAL_COUNT, "
    "SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS TOTAL_DOLLAR_AMOUNT, "
    "SUM(CASE WHEN l.l_shipdate > CAST('$asofdt' AS TIMESTAMP) THEN 1 ELSE 0 END) AS FAIL_COUNT, "
    "SUM(CASE WHEN l.l_shipdate > CAST('$asofdt' AS TIMESTAMP) THEN CAST(l.l_extendedprice AS DECIMAL(18,2)) END) "
    "AS FAIL_DOLLAR_AMOUNT FROM $ds.lineitem l JOIN $ds.supplier s ON l.l_suppkey = s.s_suppkey "
    "JOIN $ds.nation n ON s.s_nationkey = n.n_nationkey "
)
REGION_SQL_TAIL = " GROUP BY s.s_suppkey, s.s_name"
REGION_ID_OFFSET = 50000

# Rule text per supplier; $vdo is the supplier's name.
SUPPLIER_SQL_HEAD = (
    "SELECT '$vdo' AS SOR, COUNT(*) AS TOTAL_COUNT, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS TOTAL_DOLLAR_AMOUNT, "
    "0 AS FAIL_COUNT, 0 AS FAIL_DOLLAR_AMOUNT FROM $ds.lineitem WHERE l_shipdate > CAST('$misdate' AS TIMESTAMP) AND l_suppkey = "
)
SUPPLIER_ID_OFFSET = 100000


def corpus_catalog(spark: SparkSession) -> DataFrame:
    rows = [
        (
            Decimal(r.dq_id),
            r.chk_id,
            Decimal(r.queue),
            r.lri,
            r.domain,
            r.schema,
            r.sor,
            r.sql,
            r.desc,
        )
        for r in CORPUS
    ]
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def region_catalog(regions: DataFrame) -> DataFrame:
    """One active rule per region."""
    key = F.col("r_regionkey")
    return regions.select(
        (key + F.lit(REGION_ID_OFFSET)).cast(DecimalType(38, 0)).alias("DQ_ID"),
        F.concat(F.lit("REGION-"), F.col("r_name")).alias("DQ_CHK_ID"),
        F.lit(REGION_QUEUE).cast(DecimalType(38, 0)).alias("DQ_QUEUE_ID"),
        F.lit("Y").alias("DQ_LRI"),
        F.lit(DOMAIN).alias("DQ_DMN"),
        F.lit(SCHEMA).alias("DQ_SCHEMA"),
        F.col("r_name").alias("DQ_SOR"),
        F.concat(F.lit(REGION_SQL_HEAD), F.lit("WHERE n.n_regionkey = "), key.cast("string"), F.lit(REGION_SQL_TAIL)).alias("DQ_SQL"),
        F.lit("late shipments by supplier of one region").alias("DQ_DESC"),
    )


def supplier_catalog(suppliers: DataFrame) -> DataFrame:
    """One catalog row per supplier: in debt means inactive and in the other domain, so
    that domain has no active row; check id null for nation 13 (``'None'`` coercion)."""
    key, in_debt = F.col("s_suppkey"), F.col("s_acctbal") < 0
    return suppliers.select(
        (key + F.lit(SUPPLIER_ID_OFFSET)).cast(DecimalType(38, 0)).alias("DQ_ID"),
        F.when(F.col("s_nationkey") == 13, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("S"), key.cast("string")))
        .alias("DQ_CHK_ID"),
        F.lit(SUPPLIER_QUEUE).cast(DecimalType(38, 0)).alias("DQ_QUEUE_ID"),
        F.when(in_debt, F.lit("N")).otherwise(F.lit("Y")).alias("DQ_LRI"),
        F.when(in_debt, F.lit("EIDF")).otherwise(F.lit(DOMAIN)).alias("DQ_DMN"),
        F.lit(SCHEMA).alias("DQ_SCHEMA"),
        F.col("s_name").alias("DQ_SOR"),
        F.concat(F.lit(SUPPLIER_SQL_HEAD), key.cast("string")).alias("DQ_SQL"),
        F.lit("shipments of one supplier").alias("DQ_DESC"),
    )


def test_catalog(spark: SparkSession) -> DataFrame:
    """Corpus rules and the rows derived from ``global_temp.region`` and ``.supplier``."""
    derived = region_catalog(spark.table(f"{SCHEMA}.region")).unionByName(supplier_catalog(spark.table(f"{SCHEMA}.supplier")))
    return corpus_catalog(spark).unionByName(derived)
