"""Column expressions that turn a rule summary's values into result values.

All of them stay JVM-side (no Python UDF): they are plain Catalyst expressions
that whole-stage codegen compiles into the rule's own final stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    ShortType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from rulecheck.schema import PERCENT_LIMIT_HUNDREDTHS, PERCENT_TYPE

_INTEGRAL = (ByteType, ShortType, IntegerType, LongType)
_FRACTIONAL = (DecimalType, FloatType, DoubleType)


class UnsupportedMeasureType(TypeError):
    """A summary measure has a type that has no integer meaning (date, binary, ...)."""


def measure_to_long(c: Column, dtype: DataType, name: str) -> Column:
    """Integer value of a measure: null, 0, false and '' give 0; fractions are
    truncated toward zero; integer strings are parsed.

    A value with no exact integer reading (``'12.5'``, ``'abc'``, NaN, out of the
    long range) raises at execution, which fails the rule. Types without an
    integer meaning are rejected before any job runs (a timestamp would
    otherwise silently become epoch seconds).
    """
    if isinstance(dtype, NullType):
        return F.lit(0).cast("bigint")
    if isinstance(dtype, _INTEGRAL + (BooleanType,)):
        return F.coalesce(c.cast("bigint"), F.lit(0).cast("bigint"))
    if not isinstance(dtype, _FRACTIONAL + (StringType,)):
        raise UnsupportedMeasureType(f"Column {name} has type {dtype.simpleString()}, which has no integer value")
    bad = F.raise_error(F.concat(F.lit(f"{name} is not an integer value: "), c.cast("string")))
    empty = c.isNull() | (c == F.lit("")) if isinstance(dtype, StringType) else c.isNull()
    return F.when(empty, F.lit(0).cast("bigint")).otherwise(F.coalesce(c.try_cast("bigint"), bad))


def sor_label(c: Column, dtype: DataType) -> Column:
    """Source label of a summary row, as Python would print the value: null, '', numeric
    zero, false, empty binary, arrays and maps give 'NA'; true gives 'True'; timestamps
    have six digits behind the second or none; floats are printed as doubles. Other
    binary and nested values have no label text and raise, which fails the rule."""
    na = F.lit("NA")
    if isinstance(dtype, NullType):
        return na
    if isinstance(dtype, StringType):
        return F.when(c.isNull() | (c == F.lit("")), na).otherwise(c)
    if isinstance(dtype, BooleanType):
        return F.when(c.isNull() | ~c, na).otherwise(F.lit("True"))
    if isinstance(dtype, (FloatType, DoubleType)):
        return F.when(c.isNull() | (c == F.lit(0)), na).otherwise(float_text(c.cast("double")))
    if isinstance(dtype, _INTEGRAL + _FRACTIONAL):
        return F.when(c.isNull() | (c == F.lit(0)), na).otherwise(c.cast("string"))
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        whole = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        precise = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        return F.when(c.isNull(), na).when(precise.endswith(".000000"), whole).otherwise(precise)
    if isinstance(dtype, (BinaryType, ArrayType, MapType, StructType)):
        size = F.lit(1) if isinstance(dtype, StructType) else F.octet_length(c) if isinstance(dtype, BinaryType) else F.size(c)
        no_text = F.raise_error(F.lit(f"SOR of type {dtype.simpleString()} has no label text"))
        return F.when(c.isNull() | (size == 0), na).otherwise(no_text.cast("string"))
    return F.when(c.isNull(), na).otherwise(c.cast("string"))


def float_text(c: Column) -> Column:
    """A double as Python prints it: its fewest digits (15, 16 or 17 at most) that read
    back as the same value, plain from 1e-4 to below 1e16, else with an exponent of at
    least two digits."""
    size = F.abs(c)
    fifteen, sixteen, all_digits = (F.format_string(f"%.{n}e", size) for n in (14, 15, 16))
    text = F.when(fifteen.cast("double") == size, fifteen).when(sixteen.cast("double") == size, sixteen).otherwise(all_digits)
    exponent = F.substring_index(text, "e", -1).cast("int")
    digits = F.regexp_replace(F.replace(F.substring_index(text, "e", 1), F.lit("."), F.lit("")), r"(?<=.)0+$", "")
    rest = F.substr(digits, F.lit(2))
    padded = F.rpad(digits, F.greatest(exponent + 1, F.length(digits)), F.lit("0"))
    behind = F.substr(padded, exponent + 2)
    plain = F.concat(F.substr(padded, F.lit(1), exponent + 1), F.lit("."), F.when(behind == "", "0").otherwise(behind))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
    power = F.concat(F.when(exponent < 0, "-").otherwise("+"), F.when(F.abs(exponent) < 10, "0").otherwise(""), F.abs(exponent).cast("string"))
    scientific = F.concat(F.substr(digits, F.lit(1), F.lit(1)), F.when(rest == "", "").otherwise(F.concat(F.lit("."), rest)), F.lit("e"), power)
    laid_out = F.when((exponent >= 16) | (exponent < -4), scientific).when(exponent >= 0, plain).otherwise(small)
    special = F.when(F.isnan(c), "nan").when(size == float("inf"), F.when(c < 0, "-inf").otherwise("inf"))
    return F.coalesce(special, F.concat(F.when(c < 0, "-").otherwise(""), laid_out))


def percent_overflow_guard(fail: Column, total: Column, name: str) -> Column:
    """``fail`` unchanged, or an error when ``fail / total * 100`` rounded
    half-to-even at two decimals would not fit DECIMAL(5,2).

    The rounded value exceeds 999.99 exactly when |fail| * 10000 / total >= 99999.5
    (at 99999.5 the tie goes to the even 100000), i.e. when
    20000 * |fail| >= 199999 * total. Checked in the rule's own job, so an
    overflow fails that rule only; the percentage itself is computed later,
    once for all rules of a run (:func:`exact_percents`).
    """
    big = F.abs(fail.cast("decimal(20,0)")) * F.lit(20000).cast("decimal(5,0)")
    limit = total.cast("decimal(20,0)") * F.lit(199999).cast("decimal(6,0)")
    message = F.concat(F.lit(f"{name} does not fit DECIMAL(5,2): "), fail.cast("string"), F.lit(" of "), total.cast("string"))
    return F.when((total > 0) & (big >= limit), F.raise_error(message)).otherwise(fail)


def exact_percents(df: DataFrame, specs: list[tuple[str, str, str]]) -> DataFrame:
    """Adds, for each ``(fail, total, out)``, ``out`` = ``fail / total * 100``
    rounded half-to-even at two decimals, exactly, as DECIMAL(5,2); 0.00 when
    ``total <= 0``.

    Integer arithmetic on decimals: with n = |fail| * 10000, m = n mod total
    and q = (n - m) / total, the result in hundredths is q + 1 when 2m > total,
    or 2m = total and q is odd; otherwise q. The sign of ``fail`` is put back
    afterwards. A result outside DECIMAL(5,2) raises, which fails the rule
    instead of the whole run.

    The steps are separate projections shared by all specs, so each expression
    stays small (written as one expression, n, m and q repeat many times); the
    optimizer collapses the projections again.
    """
    tmp = [tuple(f"__{out}_{s}" for s in "ntmqh") for _, _, out in specs]
    df = df.withColumns(
        {
            k: v
            for (fail, total, _), (n, t, _, _, _) in zip(specs, tmp)
            for k, v in (
                (n, F.abs(F.col(fail).cast("decimal(20,0)")) * F.lit(10000).cast("decimal(5,0)")),
                (t, F.col(total).cast("decimal(20,0)")),
            )
        }
    )
    df = df.withColumns({m: F.when(F.col(t) > 0, F.col(n) % F.col(t)) for n, t, m, _, _ in tmp})
    df = df.withColumns({q: ((F.col(n) - F.col(m)) / F.col(t)).cast("decimal(38,0)") for n, t, m, q, _ in tmp})

    def bump(t: str, m: str, q: str) -> Column:
        tie_to_odd = (F.col(m) * 2 == F.col(t)) & (F.col(q) % 2 == 1)
        return F.when((F.col(m) * 2 > F.col(t)) | tie_to_odd, F.lit(1)).otherwise(F.lit(0))

    df = df.withColumns({h: (F.col(q) + bump(t, m, q)).cast("decimal(38,0)") for _, t, m, q, h in tmp})

    def value(fail: str, total: str, out: str, h: str) -> Column:
        f, hundredths = F.col(fail), F.col(h)
        signed = F.when(f < 0, -hundredths).otherwise(hundredths)
        too_big = F.raise_error(
            F.concat(F.lit(f"{out} does not fit DECIMAL(5,2): "), f.cast("string"), F.lit(" of "), F.col(total).cast("string"))
        )
        fitted = F.when(hundredths > F.lit(PERCENT_LIMIT_HUNDREDTHS), too_big).otherwise(
            (signed / F.lit(100)).cast(PERCENT_TYPE)
        )
        return F.when(F.col(total) > 0, fitted).otherwise(F.lit(0).cast(PERCENT_TYPE))

    df = df.withColumns({out: value(fail, total, out, names[4]) for (fail, total, out), names in zip(specs, tmp)})
    return df.drop(*[name for names in tmp for name in names])


def truncate_error(message: str | None, limit: int) -> str | None:
    """First ``limit`` characters of an error text."""
    return None if message is None else message[:limit]
