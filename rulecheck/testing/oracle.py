"""DuckDB SQL that computes, independently of Spark, what a run over the test
corpus must produce. The checks run it on the same parquet tables (views
``region nation customer supplier part orders lineitem events``).

The SQL mirrors the engine's semantics in plain SQL: literal placeholder
replacement, truncation toward zero, exact half-even percentages in integer
arithmetic, ``'NA'`` labels and one FAILED row per failing rule.
"""

from __future__ import annotations

from rulecheck.testing.corpus import (
    AS_OF_DT,
    CLOCK_START,
    CORPUS,
    DOMAIN,
    EXECUTION_ID,
    FIC_MIS_DATE,
    REGION_ID_OFFSET,
    REGION_QUEUE,
    REGION_SQL_HEAD,
    REGION_SQL_TAIL,
    SUPPLIER_ID_OFFSET,
    SUPPLIER_QUEUE,
    SUPPLIER_SQL_HEAD,
    UNRESOLVED,
    CorpusRule,
)


def q(value: str | None) -> str:
    """SQL string literal."""
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def catalog_cte() -> str:
    rows = ",\n".join(
        f"({r.dq_id}, {q(r.chk_id)}, {r.queue}, {q(r.lri)}, {q(r.domain)}, {q(r.schema)}, {q(r.sor)}, {q(r.sql)}, {q(r.desc)})"
        for r in CORPUS
    )
    return f"""catalog AS (
  SELECT CAST(c0 AS DECIMAL(38,0)) AS DQ_ID, CAST(c1 AS VARCHAR) AS DQ_CHK_ID, CAST(c2 AS DECIMAL(38,0)) AS DQ_QUEUE_ID,
         CAST(c3 AS VARCHAR) AS DQ_LRI, CAST(c4 AS VARCHAR) AS DQ_DMN, CAST(c5 AS VARCHAR) AS DQ_SCHEMA,
         CAST(c6 AS VARCHAR) AS DQ_SOR, CAST(c7 AS VARCHAR) AS DQ_SQL, CAST(c8 AS VARCHAR) AS DQ_DESC
  FROM (VALUES {rows}) v(c0, c1, c2, c3, c4, c5, c6, c7, c8)
  UNION ALL
  SELECT CAST(r_regionkey + {REGION_ID_OFFSET} AS DECIMAL(38,0)), 'REGION-' || r_name, CAST({REGION_QUEUE} AS DECIMAL(38,0)),
         'Y', {q(DOMAIN)}, 'global_temp', r_name,
         {q(REGION_SQL_HEAD + 'WHERE n.n_regionkey = ')} || CAST(r_regionkey AS VARCHAR) || {q(REGION_SQL_TAIL)},
         'late shipments by supplier of one region'
  FROM region
  UNION ALL
  SELECT CAST(s_suppkey + {SUPPLIER_ID_OFFSET} AS DECIMAL(38,0)),
         CASE WHEN s_nationkey = 13 THEN NULL ELSE 'S' || CAST(s_suppkey AS VARCHAR) END,
         CAST({SUPPLIER_QUEUE} AS DECIMAL(38,0)),
         CASE WHEN s_acctbal < 0 THEN 'N' ELSE 'Y' END,
         CASE WHEN s_acctbal < 0 THEN 'EIDF' ELSE {q(DOMAIN)} END, 'global_temp', s_name,
         {q(SUPPLIER_SQL_HEAD)} || CAST(s_suppkey AS VARCHAR), 'shipments of one supplier'
  FROM supplier
)"""


def rendered_expr(sql: str = "DQ_SQL", schema: str = "DQ_SCHEMA", sor: str = "DQ_SOR") -> str:
    out = f"replace({sql}, '$ds', coalesce({schema}, ''))"
    out = f"replace({out}, '$vdo', coalesce({sor}, ''))"
    out = f"replace({out}, '$misdate', {q(FIC_MIS_DATE)})"
    return f"replace({out}, '$asofdt', {q(AS_OF_DT)})"


def unresolved_expr(rendered: str) -> str:
    return f"regexp_extract_all({rendered}, '\\$[a-zA-Z_]+')"


def unresolved_message_expr(rendered: str) -> str:
    items = f"array_to_string(list_transform({unresolved_expr(rendered)}, lambda x: '''' || x || ''''), ', ')"
    return f"left('Unresolved placeholders in SQL: [' || {items} || ']. Final SQL: ' || left({rendered}, 500), 4000)"


def selected(queue: int, domain: str = DOMAIN) -> str:
    return f"(SELECT * FROM catalog WHERE DQ_QUEUE_ID = {queue} AND DQ_LRI = 'Y' AND DQ_DMN = {q(domain)})"


def duck_rule_text(rule: CorpusRule) -> str:
    """Rule text rendered for DuckDB, where the tables live in the default schema."""
    text = rule.sql.replace("$ds.", "")
    for token, value in (("$vdo", rule.sor or ""), ("$misdate", FIC_MIS_DATE), ("$asofdt", AS_OF_DT)):
        text = text.replace(token, value)
    return text


def long_expr(x: str) -> str:
    return f"CAST(COALESCE(TRUNC({x}), 0) AS BIGINT)"


def sor_expr(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR CAST({x} AS VARCHAR) = '' THEN 'NA' ELSE CAST({x} AS VARCHAR) END"


def pct_expr(f: str, t: str) -> str:
    a = f"(abs(CAST({f} AS HUGEINT)) * 10000)"
    return (
        f"CASE WHEN {t} > 0 THEN TRY_CAST(sign({f}) * ({a} // {t} + CASE WHEN 2 * ({a} % {t}) > {t} "
        f"OR (2 * ({a} % {t}) = {t} AND (({a} // {t}) % 2) = 1) THEN 1 ELSE 0 END) / 100 AS DECIMAL(5,2)) "
        f"ELSE CAST(0 AS DECIMAL(5,2)) END"
    )


#: The results table's row type, column by column in place.
LAYOUT = (
    "struct<DQ_ID:bigint,DQ_CHK_ID:string,DQ_QUEUE_ID:bigint,EXECUTION_ID:string,RUN_FIC_MIS_DATE:string,RUN_AS_OF_DT:string,RUN_DMN:string,"
    "SOR:string,TOTAL_COUNT:bigint,TOTAL_DOLLAR_AMOUNT:bigint,FAIL_COUNT:bigint,FAIL_DOLLAR_AMOUNT:bigint,FAIL_COUNT_PERCENTAGE:decimal(5,2),"
    "FAIL_DOLLAR_PERCENTAGE:decimal(5,2),EXECUTION_STATUS:string,ERROR_MESSAGE:string,EXECUTION_START_DT:timestamp,EXECUTION_END_DT:timestamp,CREATED_DT:timestamp>"
)


def run_stamps(execution_id: str = EXECUTION_ID, domain: str = DOMAIN) -> str:
    return (
        f"{q(execution_id)} AS EXECUTION_ID, {q(FIC_MIS_DATE)} AS RUN_FIC_MIS_DATE, "
        f"{q(AS_OF_DT)} AS RUN_AS_OF_DT, {q(domain)} AS RUN_DMN"
    )


def normalised_sql(summary: str, keys: str, carried: tuple[str, ...] = ()) -> str:
    """Result rows (comparable columns) of a successful summary; ``carried`` columns
    of it may be used in ``keys``."""
    tail = ", 'SUCCESS' AS EXECUTION_STATUS, CAST(NULL AS VARCHAR) AS ERROR_TEXT"
    more = "".join(f"s.{c}, " for c in carried)
    return f"""SELECT {keys}, {run_stamps()}, n.SOR, n.TOTAL_COUNT, n.TOTAL_DOLLAR_AMOUNT, n.FAIL_COUNT, n.FAIL_DOLLAR_AMOUNT,
  {pct_expr('n.FAIL_COUNT', 'n.TOTAL_COUNT')} AS FAIL_COUNT_PERCENTAGE,
  {pct_expr('n.FAIL_DOLLAR_AMOUNT', 'n.TOTAL_DOLLAR_AMOUNT')} AS FAIL_DOLLAR_PERCENTAGE{tail}
FROM (SELECT {more}{sor_expr('s.SOR')} AS SOR, {long_expr('s.TOTAL_COUNT')} AS TOTAL_COUNT,
        {long_expr('s.TOTAL_DOLLAR_AMOUNT')} AS TOTAL_DOLLAR_AMOUNT, {long_expr('s.FAIL_COUNT')} AS FAIL_COUNT,
        {long_expr('s.FAIL_DOLLAR_AMOUNT')} AS FAIL_DOLLAR_AMOUNT
      FROM ({summary}) s) n"""


def rule_keys(rule: CorpusRule) -> str:
    return (
        f"CAST({rule.dq_id} AS BIGINT) AS DQ_ID, {q(rule.chk_id or 'None')} AS DQ_CHK_ID, "
        f"CAST({rule.queue} AS BIGINT) AS DQ_QUEUE_ID"
    )


def failure_row_sql(rule: CorpusRule, err: str, when: str = "true") -> str:
    return (
        f"SELECT {rule_keys(rule)}, {run_stamps()}, 'NA' AS SOR, CAST(0 AS BIGINT) AS TOTAL_COUNT, "
        f"CAST(0 AS BIGINT) AS TOTAL_DOLLAR_AMOUNT, CAST(0 AS BIGINT) AS FAIL_COUNT, CAST(0 AS BIGINT) AS FAIL_DOLLAR_AMOUNT, "
        f"CAST(0 AS DECIMAL(5,2)) AS FAIL_COUNT_PERCENTAGE, CAST(0 AS DECIMAL(5,2)) AS FAIL_DOLLAR_PERCENTAGE, "
        f"'FAILED' AS EXECUTION_STATUS, CAST({err} AS VARCHAR) AS ERROR_TEXT WHERE {when}"
    )


def value_failure_sql(rule: CorpusRule) -> str:
    """Rows of a rule whose values decide: it fails when a measure of any summary row is
    not an integer, or a percentage would exceed 999.99; else its rows count."""
    summary = duck_rule_text(rule)
    measures = ("TOTAL_COUNT", "TOTAL_DOLLAR_AMOUNT", "FAIL_COUNT", "FAIL_DOLLAR_AMOUNT")
    read = ", ".join(f"TRY_CAST(CAST({m} AS VARCHAR) AS DOUBLE) AS {m}" for m in measures)
    no_integer = " OR ".join(f"NOT regexp_full_match(COALESCE(CAST({m} AS VARCHAR), '0'), '[+-]?[0-9]+')" for m in measures)
    beyond = " OR ".join(f"(CASE WHEN {t} > 0 THEN abs({f}) * 100 / {t} >= 999.995 ELSE false END)" for f, t in (("FAIL_COUNT", "TOTAL_COUNT"), ("FAIL_DOLLAR_AMOUNT", "TOTAL_DOLLAR_AMOUNT")))
    bad = f"(EXISTS (SELECT 1 FROM ({summary}) s WHERE {no_integer}) OR EXISTS (SELECT 1 FROM (SELECT {read} FROM ({summary}) s) v WHERE {beyond}))"
    good = normalised_sql(f"SELECT SOR, {read} FROM ({summary}) s", rule_keys(rule))
    return f"SELECT * FROM ({failure_row_sql(rule, rule.error, bad)}) UNION ALL SELECT * FROM ({good}) WHERE NOT {bad}"


def rule_rows_sql(rule: CorpusRule) -> str:
    """Comparable result rows of one corpus rule (success or failure)."""
    if rule.by_value:
        return value_failure_sql(rule)
    if rule.error is None:
        return normalised_sql(duck_rule_text(rule), rule_keys(rule))
    if rule.error == UNRESOLVED:
        return failure_row_sql(rule, f"(SELECT {unresolved_message_expr(rendered_expr())} FROM catalog WHERE DQ_CHK_ID = {q(rule.chk_id)})")
    return failure_row_sql(rule, rule.error)


def region_rows_sql() -> str:
    """Comparable rows of the region queue: one GROUP BY over all line items stands in
    for the rules."""
    asof = q(AS_OF_DT)
    summary = f"""SELECT sel.DQ_ID, sel.DQ_CHK_ID, a.SOR, a.TOTAL_COUNT, a.TOTAL_DOLLAR_AMOUNT, a.FAIL_COUNT, a.FAIL_DOLLAR_AMOUNT
  FROM {selected(REGION_QUEUE)} sel JOIN (
    SELECT n_regionkey, s_name AS SOR, COUNT(*) AS TOTAL_COUNT, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS TOTAL_DOLLAR_AMOUNT,
           SUM(CASE WHEN l_shipdate > CAST({asof} AS TIMESTAMP) THEN 1 ELSE 0 END) AS FAIL_COUNT,
           SUM(CASE WHEN l_shipdate > CAST({asof} AS TIMESTAMP) THEN CAST(l_extendedprice AS DECIMAL(18,2)) END) AS FAIL_DOLLAR_AMOUNT
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    GROUP BY n_regionkey, s_suppkey, s_name) a ON a.n_regionkey = CAST(sel.DQ_ID AS BIGINT) - {REGION_ID_OFFSET}"""
    keys = f"CAST(n.DQ_ID AS BIGINT) AS DQ_ID, n.DQ_CHK_ID, CAST({REGION_QUEUE} AS BIGINT) AS DQ_QUEUE_ID"
    return normalised_sql(summary, keys, carried=("DQ_ID", "DQ_CHK_ID"))


def with_catalog(body: str) -> str:
    return f"WITH {catalog_cte()}\n{body}"


def rules_rows_sql(chk_ids: list[str]) -> str:
    """UNION ALL of the comparable rows of the given corpus rules."""
    by_chk = {r.chk_id: r for r in CORPUS}
    return "\nUNION ALL\n".join(rule_rows_sql(by_chk[c]) for c in chk_ids)


def queue_chk_ids(queue: int, domain: str = DOMAIN) -> list[str]:
    """Check ids of the hand-written rules a run of ``queue`` selects."""
    return [r.chk_id for r in CORPUS if r.queue == queue and r.lri == "Y" and r.domain == domain and r.chk_id]


def ticking_times_sql(order_by: str) -> str:
    """Start and end text of the k-th executed rule under the ticking clock
    (two ticks per rule: start, end)."""
    base = f"TIMESTAMP '{CLOCK_START.isoformat(sep=' ')}'"
    k = f"(row_number() OVER (ORDER BY {order_by}) - 1)"
    return (
        f"strftime({base} + to_seconds(2 * {k}), '%Y-%m-%d %H:%M:%S') AS EXECUTION_START_DT, "
        f"strftime({base} + to_seconds(2 * {k} + 1), '%Y-%m-%d %H:%M:%S') AS EXECUTION_END_DT"
    )
