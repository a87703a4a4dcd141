"""Measure coercion, source labels and exact percentages."""

from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rulecheck.functions.measures import (
    UnsupportedMeasureType,
    exact_percents,
    measure_to_long,
    sor_label,
)


def to_long(df, col="v"):
    return [r[0] for r in df.select(measure_to_long(F.col(col), df.schema[col].dataType, col)).collect()]


def test_to_long_strings(spark):
    df = spark.createDataFrame([("",), (None,), (" 12 ",), ("-7",), ("0",)], "v string")
    assert to_long(df) == [0, 0, 12, -7, 0]


@pytest.mark.parametrize("bad", ["12.5", "abc", "1e3"])
def test_to_long_bad_strings_raise(spark, bad):
    df = spark.createDataFrame([(bad,)], "v string")
    with pytest.raises(Exception, match="not an integer value"):
        to_long(df)


def test_to_long_fractions_truncate_toward_zero(spark):
    df = spark.createDataFrame([(-12.99,), (12.99,), (None,), (0.0,)], "v double")
    assert to_long(df) == [-12, 12, 0, 0]
    dec = spark.createDataFrame([(Decimal("-12.99"),), (Decimal("3183256271.63"),)], "v decimal(18,2)")
    assert to_long(dec) == [-12, 3183256271]


def test_to_long_nan_and_overflow_raise(spark):
    with pytest.raises(Exception, match="not an integer value"):
        to_long(spark.createDataFrame([(float("nan"),)], "v double"))
    with pytest.raises(Exception, match="not an integer value"):
        to_long(spark.createDataFrame([(1e19,)], "v double"))


def test_to_long_booleans_and_nulls(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "v boolean")
    assert to_long(df) == [1, 0, 0]
    nulls = spark.sql("SELECT NULL AS v")
    assert to_long(nulls) == [0]


def test_to_long_rejects_timestamps(spark):
    df = spark.sql("SELECT current_timestamp() AS v")
    with pytest.raises(UnsupportedMeasureType):
        measure_to_long(F.col("v"), df.schema["v"].dataType, "v")


def test_sor_label(spark):
    def labels(df):
        return [r[0] for r in df.select(sor_label(F.col("v"), df.schema["v"].dataType)).collect()]

    assert labels(spark.createDataFrame([("A",), ("",), (None,)], "v string")) == ["A", "NA", "NA"]
    assert labels(spark.createDataFrame([(0,), (7,), (None,)], "v int")) == ["NA", "7", "NA"]
    assert labels(spark.createDataFrame([(True,), (False,)], "v boolean")) == ["True", "NA"]
    assert labels(spark.createDataFrame([(Decimal("0.00"),), (Decimal("12.50"),)], "v decimal(4,2)")) == ["NA", "12.50"]
    assert labels(spark.sql("SELECT NULL AS v")) == ["NA"]


def half_even_percent(fail: int, total: int) -> Decimal:
    if total <= 0:
        return Decimal("0.00")
    value = Fraction(abs(fail) * 10000, total)
    floor = value.numerator // value.denominator
    rest = value - floor
    hundredths = floor + (1 if rest > Fraction(1, 2) or (rest == Fraction(1, 2) and floor % 2 == 1) else 0)
    sign = -1 if fail < 0 else 1
    return (Decimal(sign * hundredths) / 100).quantize(Decimal("0.01"))


def test_percent_grid_matches_exact_half_even(spark):
    # every (fail, total) with 0 <= fail <= total <= 400, generated without a join
    n = 401
    grid = (
        spark.range(n * n)
        .select((F.col("id") % n).alias("fail"), (F.col("id") / n).cast("bigint").alias("total"))
        .where((F.col("total") >= 1) & (F.col("fail") <= F.col("total")))
    )
    got = exact_percents(grid, [("fail", "total", "pct")]).collect()
    assert len(got) == sum(t + 1 for t in range(1, n))
    bad = [(r.fail, r.total, r.pct) for r in got if r.pct != half_even_percent(r.fail, r.total)]
    assert bad == []


def test_percent_edges(spark):
    rows = [
        (23, 160),  # tie 14.375 -> 14.38 (q odd)
        (1, 32),  # tie 3.125 -> 3.12 (q even)
        (-23, 160),
        (5, 0),
        (5, -3),
        (0, 0),
        (999_999_999_999_999, 1_000_000_000_000_000),
        (9_223_372_036_854_775_807, 9_223_372_036_854_775_806),
        (-9_223_372_036_854_775_808, 9_223_372_036_854_775_807),
    ]
    df = spark.createDataFrame(rows, "fail bigint, total bigint")
    got = [r.pct for r in exact_percents(df, [("fail", "total", "pct")]).collect()]
    assert got == [half_even_percent(f, t) for f, t in rows]


def test_percent_out_of_range_raises(spark):
    df = spark.createDataFrame([(1000, 1)], "fail bigint, total bigint")
    with pytest.raises(PySparkException, match="does not fit"):
        exact_percents(df, [("fail", "total", "pct")]).collect()


def test_overflow_guard_matches_rounding(spark):
    from rulecheck.functions.measures import percent_overflow_guard

    # around the 999.99 limit: 999.99 fits, 999.995 (tie -> 1000.00) and above do not
    rows = [(99999, 10000), (199999, 20000), (199998, 20000), (-199999, 20000), (10, 0), (1000, 1)]
    df = spark.createDataFrame(rows, "fail bigint, total bigint")
    for fail, total in rows:
        one = df.where((F.col("fail") == fail) & (F.col("total") == total))
        guarded = one.select(percent_overflow_guard(F.col("fail"), F.col("total"), "P").alias("g"))
        fits = total <= 0 or half_even_percent(abs(fail), total) <= Decimal("999.99")
        if fits:
            assert guarded.first().g == fail
        else:
            with pytest.raises(PySparkException, match="does not fit"):
                guarded.collect()


def test_labels_print_like_python(spark):
    import math
    import struct
    from datetime import datetime

    doubles = [1e16, 1e15, 1.5e7, 12345678.9, 1e-4, 0.00012345, 1e-5, 123.456e-9, -2.5e20, 0.5, -7.0, 1e100, 3.0e-10, math.nan, math.inf, -math.inf, 9007199254740993.0]
    df = spark.createDataFrame([(x,) for x in doubles], "v double")
    got = [r[0] for r in df.select(sor_label(F.col("v"), df.schema["v"].dataType)).collect()]
    assert got == [str(x) for x in doubles]
    floats = [0.1, 1e10, 16777216.0, 3.4e38]
    df = spark.createDataFrame([(x,) for x in floats], "v float")
    got = [r[0] for r in df.select(sor_label(F.col("v"), df.schema["v"].dataType)).collect()]
    assert got == [str(struct.unpack("f", struct.pack("f", x))[0]) for x in floats]
    times = [datetime(2024, 1, 2, 3, 4, 0, 500000), datetime(2024, 1, 2), datetime(2024, 1, 2, 3, 4, 5, 1)]
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.createDataFrame([(x,) for x in times], f"v {kind}")
        got = [r[0] for r in df.select(sor_label(F.col("v"), df.schema["v"].dataType)).collect()]
        assert got == [str(x) for x in times]
    for empty, full in (("CAST('' AS BINARY)", "CAST('a' AS BINARY)"), ("slice(array('a'), 1, 0)", "array('a')"), ("map_from_arrays(array(), array())", "map('a', 1)")):
        df = spark.sql(f"SELECT {empty} AS v")
        assert df.select(sor_label(F.col("v"), df.schema["v"].dataType)).first()[0] == "NA"
        df = spark.sql(f"SELECT {full} AS v")
        with pytest.raises(Exception, match="no label text"):
            df.select(sor_label(F.col("v"), df.schema["v"].dataType)).collect()
