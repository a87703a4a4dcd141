"""Property tests: Spark expressions against a plain-Python model of the rules.

Each hypothesis example is a whole list of cases evaluated in one Spark job.
"""

from __future__ import annotations

import re
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rulecheck.functions.measures import measure_to_long, sor_label
from rulecheck.functions.render import render_placeholders, unresolved_placeholders

FRAGMENTS = ["$ds", "$vdo", "$misdate", "$asofdt", "$DS", "$x", "$_y", "$", "${z}", "$1", "a", "Z", "_", " ", ".", "'", "\\", "é"]
text = st.lists(st.sampled_from(FRAGMENTS), max_size=12).map("".join)
maybe_text = st.one_of(st.none(), text)
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def model_render(sql, schema, sor, misdate, asof):
    out = sql
    for token, value in (("$ds", schema or ""), ("$vdo", sor or ""), ("$misdate", misdate), ("$asofdt", asof)):
        out = out.replace(token, value)
    return out, re.findall(r"\$[a-zA-Z_]+", out)


@SETTINGS
@given(cases=st.lists(st.tuples(text, maybe_text, maybe_text, text, text), min_size=1, max_size=60))
def test_render_matches_model(spark, cases):
    df = spark.createDataFrame(cases, "t string, s string, v string, m string, a string")
    rows = df.select(
        F.monotonically_increasing_id().alias("i"),
        render_placeholders("t", "s", "v", "@M", "@A").alias("r"),
    ).select("i", "r", unresolved_placeholders("r").alias("u")).orderBy("i").collect()
    for (t, s, v, _, _), row in zip(cases, rows):
        rendered, unresolved = model_render(t, s, v, "@M", "@A")
        assert row.r == rendered
        assert list(row.u) == unresolved


ints = st.integers(min_value=-(2**63), max_value=2**63 - 1)


@SETTINGS
@given(
    values=st.lists(
        st.one_of(
            ints.map(str),
            ints.map(lambda i: f"  {i} "),
            ints.filter(lambda i: i >= 0).map(lambda i: f"+{i}"),
            st.just(""),
            st.none(),
        ),
        min_size=1,
        max_size=60,
    )
)
def test_text_measures_match_int(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(measure_to_long(F.col("v"), df.schema["v"].dataType, "v")).collect()]
    assert got == [int(v or 0) for v in values]


@SETTINGS
@given(values=st.lists(st.decimals(min_value=-(10**15), max_value=10**15, places=2, allow_nan=False), min_size=1, max_size=60))
def test_decimal_measures_truncate_like_int(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v decimal(18,2)")
    got = [r[0] for r in df.select(measure_to_long(F.col("v"), df.schema["v"].dataType, "v")).collect()]
    assert got == [int(v or 0) for v in values]


@SETTINGS
@given(values=st.lists(st.one_of(st.none(), st.integers(-5, 5), st.decimals(-3, 3, places=2, allow_nan=False)), min_size=1, max_size=40))
def test_decimal_labels_match_str_or_na(spark, values):
    df = spark.createDataFrame([(None if v is None else Decimal(v),) for v in values], "v decimal(10,2)")
    got = [r[0] for r in df.select(sor_label(F.col("v"), df.schema["v"].dataType)).collect()]
    expected = [str((Decimal(v).quantize(Decimal("0.01")) if v is not None else None) or "NA") for v in values]
    assert got == expected
