"""Rule summary -> result values, as one projection on top of the rule's plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulecheck.functions.measures import exact_percents, measure_to_long, percent_overflow_guard, sor_label
from rulecheck.schema import MISSING_COLUMNS_MESSAGE, SUMMARY_COLUMNS


class SummaryContractError(ValueError):
    """The rule's summary lacks required columns or has unusable types."""


def uppercase_columns(df: DataFrame) -> DataFrame:
    """Every column renamed to upper case, in one projection."""
    return df.toDF(*[c.upper() for c in df.columns])


def summary_positions(columns: list[str], given: list[str]) -> dict[str, int]:
    """Position of each required summary column among upper-cased names (with
    duplicates the first one wins); ``given`` are the names as the rule wrote them."""
    missing = sorted(set(SUMMARY_COLUMNS) - set(columns))
    if missing:
        raise SummaryContractError(MISSING_COLUMNS_MESSAGE.format(missing=missing, got=given))
    return {name: columns.index(name) for name in SUMMARY_COLUMNS}


def normalise_summary(df: DataFrame) -> DataFrame:
    """The five measured columns of each summary row: label and four longs.

    Names are upper-cased and columns then picked by position, so duplicate names
    cannot be ambiguous. Measures become longs (truncated toward zero, see
    :func:`measure_to_long`). Fail measures whose percentage would not fit
    DECIMAL(5,2) raise here, inside the rule's job. Extra summary columns are
    pruned away by the optimizer. Percentages are added by
    :func:`with_percentages`, once per run over all rules' rows.
    """
    upper = uppercase_columns(df)
    positions = summary_positions(upper.columns, df.columns)
    fields = upper.schema.fields
    positional = upper.toDF(*[f"_c{i}" for i in range(len(fields))])

    def src(name: str):
        return F.col(f"_c{positions[name]}")

    def dtype(name: str):
        return fields[positions[name]].dataType

    try:
        longs = {name: measure_to_long(src(name), dtype(name), name) for name in SUMMARY_COLUMNS[1:]}
    except TypeError as exc:
        raise SummaryContractError(str(exc)) from exc
    measured = positional.select(
        sor_label(src("SOR"), dtype("SOR")).alias("SOR"),
        *[col.alias(name) for name, col in longs.items()],
    )
    return measured.select(
        "SOR",
        "TOTAL_COUNT",
        "TOTAL_DOLLAR_AMOUNT",
        percent_overflow_guard(F.col("FAIL_COUNT"), F.col("TOTAL_COUNT"), "FAIL_COUNT_PERCENTAGE").alias("FAIL_COUNT"),
        percent_overflow_guard(
            F.col("FAIL_DOLLAR_AMOUNT"), F.col("TOTAL_DOLLAR_AMOUNT"), "FAIL_DOLLAR_PERCENTAGE"
        ).alias("FAIL_DOLLAR_AMOUNT"),
    )


def with_percentages(df: DataFrame) -> DataFrame:
    """Adds both exact half-even percentages (DECIMAL(5,2)) to normalised rows."""
    return exact_percents(
        df,
        [
            ("FAIL_COUNT", "TOTAL_COUNT", "FAIL_COUNT_PERCENTAGE"),
            ("FAIL_DOLLAR_AMOUNT", "TOTAL_DOLLAR_AMOUNT", "FAIL_DOLLAR_PERCENTAGE"),
        ],
    )
