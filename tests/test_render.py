"""Placeholder rendering and the unresolved-placeholder check (FIXTURES §5.4)."""

from rulecheck.functions.render import render_placeholders, unresolved_placeholders

CASES = [
    # template, schema, sor, rendered, unresolved
    ("$ds.t $dsx $vdo $DS", "S", None, "S.t Sx  $DS", ["$DS"]),
    ("a $x ${y} $1 $_Z", "S", "V", "a $x ${y} $1 $_Z", ["$x", "$_Z"]),
    ("$ds", "p$vdo", "Q", "pQ", []),
    ("$vdo", "S", "$ds", "$ds", ["$ds"]),
    ("'$USD'", "S", "V", "'$USD'", ["$USD"]),
    ("get_json_object(j, '$.a')", "S", "V", "get_json_object(j, '$.a')", []),
    ("x $misdate y $asofdt", None, None, "x 2024-01-15 y 2000-12-31", []),
    ("FROM $ds.customer", None, None, "FROM .customer", []),
    ("v$session and $ds", "a$1b", None, "v$session and a$1b", ["$session"]),
    ("regexp_like(c, 'x$')", None, None, "regexp_like(c, 'x$')", []),
]


def test_rendering_cases(spark):
    df = spark.createDataFrame([(t, s, v) for t, s, v, _, _ in CASES], "t string, s string, v string")
    out = df.select(
        render_placeholders("t", "s", "v", "2024-01-15", "2000-12-31").alias("r"),
    ).select("r", unresolved_placeholders("r").alias("u"))
    got = [(row["r"], list(row["u"])) for row in out.collect()]
    assert got == [(r, u) for _, _, _, r, u in CASES]


def test_dollar_in_value_is_literal(spark):
    # A regex replacement would read "$1" in the value as a group reference.
    df = spark.createDataFrame([("SELECT '$vdo'", "x", "a$1b")], "t string, s string, v string")
    row = df.select(render_placeholders("t", "s", "v", "d", "e").alias("r")).first()
    assert row["r"] == "SELECT 'a$1b'"


def test_null_template_stays_null(spark):
    df = spark.createDataFrame([(None, "s", "v")], "t string, s string, v string")
    assert df.select(render_placeholders("t", "s", "v", "d", "e").alias("r")).first()["r"] is None
