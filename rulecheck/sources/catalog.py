"""The rule catalog: read it, select a queue's active rules, coerce keys, order
and render them, then bring the (metadata-sized) rule list to the driver once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from rulecheck.functions.render import render_placeholders, unresolved_placeholders
from rulecheck.schema import ACTIVE_FLAG, CATALOG_COLUMNS, CATALOG_FETCH_SIZE, OPTIONAL_CATALOG_COLUMNS


# Ids per range when rules are numbered.
ID_RANGE = 4096


@dataclass(frozen=True)
class Rule:
    """One selected rule, as the driver needs it to start its job."""

    seq: int
    dq_id: int
    chk_id: str
    queue_id: int
    rendered_sql: str | None
    unresolved: tuple[str, ...]


def read_catalog_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    fetchsize: int = CATALOG_FETCH_SIZE,
) -> DataFrame:
    """Catalog over JDBC. Filters added later with :func:`select_rules` are pushed
    into the database query by Spark's JDBC source."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", str(fetchsize))
    for key, value in (properties or {}).items():
        reader = reader.option(key, value)
    return reader.load()


def check_catalog_columns(df: DataFrame) -> dict[str, str]:
    """Upper-case name -> actual name of the catalog's columns; raises when a
    required column is missing (reads the schema only)."""
    present = {c.upper(): c for c in df.columns}
    missing = [c for c in CATALOG_COLUMNS if c not in present and c not in OPTIONAL_CATALOG_COLUMNS]
    if missing:
        raise ValueError(f"Rule catalog is missing columns: {missing}. Got: {df.columns}")
    return present


def project_catalog(df: DataFrame) -> DataFrame:
    """The eight catalog columns used, with keys coerced.

    Only these columns reach the scan (column pruning). ``DQ_SCHEMA`` and
    ``DQ_SOR`` may be absent and then read as null. ``DQ_ID`` and
    ``DQ_QUEUE_ID`` become longs (fractions truncated, text that is not an
    integer becomes null and is rejected at :func:`collect_rules`);
    ``DQ_CHK_ID`` becomes text with null written as ``'None'``.
    """
    present = check_catalog_columns(df)
    types = {f.name: f.dataType for f in df.schema.fields}

    def pick(name: str):
        return F.col(f"`{present[name]}`") if name in present else F.lit(None).cast("string")

    def as_text(name: str):
        # No cast on columns that already are text: a cast (also from a JDBC
        # VARCHAR(n)) would keep the equality filters out of the source query.
        if name in present and isinstance(types[present[name]], StringType):
            return pick(name)
        return pick(name).cast("string")

    def as_long(name: str):
        if name in present and isinstance(types[present[name]], LongType):
            return pick(name)
        return pick(name).try_cast("bigint")

    return df.select(
        as_long("DQ_ID").alias("DQ_ID"),
        F.coalesce(as_text("DQ_CHK_ID"), F.lit("None")).alias("DQ_CHK_ID"),
        as_long("DQ_QUEUE_ID").alias("DQ_QUEUE_ID"),
        as_text("DQ_LRI").alias("DQ_LRI"),
        as_text("DQ_DMN").alias("DQ_DMN"),
        as_text("DQ_SCHEMA").alias("DQ_SCHEMA"),
        as_text("DQ_SOR").alias("DQ_SOR"),
        as_text("DQ_SQL").alias("DQ_SQL"),
    )


def select_rules(df: DataFrame, queue_id: int, domain: str) -> DataFrame:
    """Active rules of one queue and domain: exact, case-sensitive equality;
    nulls never match.

    Applied to the catalog as read (before :func:`project_catalog`), the
    comparison is on the stored values, as a database would make it, and all
    three predicates reach the source (JDBC query or parquet row-group filter)
    whatever the key type."""
    return df.where(
        (F.col("DQ_QUEUE_ID") == F.lit(int(queue_id)))
        & (F.col("DQ_LRI") == F.lit(ACTIVE_FLAG))
        & (F.col("DQ_DMN") == F.lit(domain))
    )


def number_rules(df: DataFrame) -> DataFrame:
    """Adds ``RULE_SEQ``: the place of each rule in its queue's execution order
    (``DQ_ID``, then ``DQ_CHK_ID``), from 0.

    Rules are numbered inside ranges of ``ID_RANGE`` ids; the ranges' counts, a small
    table, give what comes before each range. No task holds a whole queue.
    """
    ranged = df.withColumn("__range", F.floor(F.coalesce(F.col("DQ_ID"), F.lit(0)) / ID_RANGE))
    counts = ranged.groupBy("DQ_QUEUE_ID", "__range").agg(F.count(F.lit(1)).alias("__rules"))
    before = Window.partitionBy("DQ_QUEUE_ID").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("DQ_QUEUE_ID", "__range", F.coalesce(F.sum("__rules").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("DQ_QUEUE_ID", "__range").orderBy(F.col("DQ_ID").asc_nulls_first(), F.col("DQ_CHK_ID").asc())
    numbered = ranged.withColumn("__place", F.row_number().over(inside) - 1)
    same = numbered["DQ_QUEUE_ID"].eqNullSafe(counts["DQ_QUEUE_ID"]) & (numbered["__range"] == counts["__range"])
    joined = numbered.join(counts, same).withColumn("RULE_SEQ", (F.col("__before") + F.col("__place")).cast("bigint"))
    return joined.select(*[numbered[c] for c in df.columns], "RULE_SEQ")


def count_rules(df: DataFrame) -> DataFrame:
    """Number of rules per queue."""
    return df.groupBy("DQ_QUEUE_ID").agg(F.count(F.lit(1)).cast("bigint").alias("RULE_COUNT"))


def with_rendering(df: DataFrame, fic_mis_date: str, as_of_dt: str) -> DataFrame:
    """Adds ``RENDERED_SQL`` and ``UNRESOLVED`` (array of leftover placeholders)."""
    rendered = render_placeholders("DQ_SQL", "DQ_SCHEMA", "DQ_SOR", fic_mis_date, as_of_dt)
    return df.withColumn("RENDERED_SQL", rendered).withColumn("UNRESOLVED", unresolved_placeholders("RENDERED_SQL"))


def prepared_rules(df: DataFrame, queue_id: int, domain: str, fic_mis_date: str, as_of_dt: str) -> DataFrame:
    """Select, project and render: the whole catalog plan before the collect, one scan."""
    check_catalog_columns(df)
    return with_rendering(project_catalog(select_rules(df, queue_id, domain)), fic_mis_date, as_of_dt)


def collect_rules(prepared: DataFrame) -> list[Rule]:
    """The one action on the catalog. The rule list is metadata (one row per rule that
    is about to run as a job of its own, with its text rendered once), the only thing a
    run brings to the driver; its length is the rule count, so no separate count job
    runs. The catalog is read once, so keys, texts and places come from the same rows,
    also over JDBC; places follow from the collected keys, in the order of
    :func:`number_rules` (which numbers catalogs of any size without a collect).

    A rule without a usable ``DQ_ID`` stops the run here, before any rule runs.
    """
    rows = prepared.select("DQ_ID", "DQ_CHK_ID", "DQ_QUEUE_ID", "RENDERED_SQL", "UNRESOLVED").collect()
    bad = [r["DQ_CHK_ID"] for r in rows if r["DQ_ID"] is None or r["DQ_QUEUE_ID"] is None]
    if bad:
        raise ValueError(f"Rules without an integer DQ_ID or DQ_QUEUE_ID: {bad}")
    return [
        Rule(
            seq=seq,
            dq_id=int(r["DQ_ID"]),
            chk_id=r["DQ_CHK_ID"],
            queue_id=int(r["DQ_QUEUE_ID"]),
            rendered_sql=r["RENDERED_SQL"],
            unresolved=tuple(r["UNRESOLVED"] or ()),
        )
        for seq, r in enumerate(sorted(rows, key=lambda r: (r["DQ_ID"], r["DQ_CHK_ID"], r["RENDERED_SQL"] or "")))
    ]
