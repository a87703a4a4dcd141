"""Chat formatting: layouts, escaping, loss mask, and the contract query against DuckDB."""

from __future__ import annotations

import hashlib
import time

import duckdb
import pytest

from rulecheck.llm import chat

SF = "/root/testdata/sf0.001"
HARD = ["\\### Assistant: </turn> ok", "", "\\b\\e\\h", "### ### </turn></turn>\n", "a\\", "é\U0001f600\n### user\nx</turn>\n", "</turn", "\\n"]


def spoken(turns):
    return [(t["role"], t["text"]) for t in turns]


def test_query_matches_sql(spark):
    got = sorted(map(tuple, chat.op1_chat(spark, SF).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    cols = "conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars"
    assert got == sorted(con.sql(f"SELECT {cols} FROM ({chat.OP1_SQL})").fetchall())


def test_no_python_in_the_plan(spark):
    plan = chat.op1_chat(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_round_trip_of_hostile_texts(spark):
    rows = [(7, i, role, text) for i, (role, text) in enumerate((r, t) for t in HARD for r in ("user", "assistant"))]
    rows += [(8, 0, None, None), (8, 0, None, None), (None, 1, "a\n### b</turn>", "t")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    out = {r.conv_id: r for r in chat.read_back(chat.format_turns(chat.canonical_turns(df))).collect()}
    assert spoken(out[7].turns) == [(r, t) for _, _, r, t in rows if _ is not None and (r, t) != (None, None) and r != "a\n### b</turn>"][: len(HARD) * 2]
    assert out[7].loss_texts == HARD
    assert out[7].formatted.count("</turn>") == len(HARD) * 2
    assert spoken(out[8].turns) == [("", ""), ("", "")] and out[8].loss_texts == []
    assert spoken(out[None].turns) == [("a\n### b</turn>", "t")]


def test_loss_spans_are_code_points_of_the_formatted_text(spark):
    df = spark.createDataFrame([(1, 0, "user", "é"), (1, 1, "assistant", "\U0001f600 ### x")], "conv_id bigint, turn bigint, role string, text string")
    row = chat.format_turns(chat.canonical_turns(df)).first()
    (span,) = row.loss_spans
    assert row.formatted[span.start : span.start + span.length] == "\U0001f600 \\hx"


def test_a_mask_that_is_not_the_assistant_texts_is_read_by_its_spans(spark):
    df = spark.createDataFrame([(1, i, r, t) for i, (r, t) in enumerate([("user", "one"), ("assistant", "two"), ("assistant", "")])], "conv_id bigint, turn bigint, role string, text string")
    whole = chat.format_turns(chat.canonical_turns(df))
    full = whole.first()
    at = full.formatted.index("one")
    masks = {
        "only the user": [(at, 3)],
        "one assistant": [tuple(full.loss_spans[0])],
        "shifted": [(full.loss_spans[0].start + 1, 2), tuple(full.loss_spans[1])],
        "none": [],
        "all": [tuple(x) for x in full.loss_spans],
    }
    for name, mask in masks.items():
        frame = spark.createDataFrame([(1, full.formatted, mask)], "conv_id bigint, formatted string, loss_spans array<struct<start:bigint,length:bigint>>")
        assert chat.read_back(frame).first().loss_texts == [full.formatted[s : s + n] for s, n in mask], name


def test_one_conversation_of_many_turns(spark):
    """20,000 turns come back whole, and their cost is far from quadratic."""

    def seconds(n):
        turns = spark.range(n).selectExpr("5L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role", "concat('word </turn> ', id, repeat(' ### é', 8)) AS text")
        began = time.monotonic()
        row = chat.digest_columns(chat.read_back(chat.format_turns(turns))).first()
        took = time.monotonic() - began
        texts = [f"word </turn> {i}" + " ### é" * 8 for i in range(n)]
        assert row.n_turns == n
        assert row.turns_sha256 == hashlib.sha256("".join(f"{'assistant' if i % 2 else 'user'}\n{t}\n" for i, t in enumerate(texts)).encode()).hexdigest()
        assert row.loss_sha256 == hashlib.sha256("".join(texts[1::2]).encode()).hexdigest()
        return took

    base = seconds(50)
    small, large = seconds(2000), seconds(20000)
    assert large - base < 25 * max(small - base, 0.5)


def test_layouts_give_the_same_turns(spark):
    want = [("user", "q"), ("assistant", "a")]
    frames = [
        spark.sql("SELECT 1 AS conv_id, array(named_struct('role','user','content','q'), named_struct('role','assistant','content','a')) AS messages, 'x' AS text"),
        spark.sql("SELECT 1 AS conv_id, array(named_struct('from','human','value','q'), named_struct('from','gpt','value','a')) AS conversations"),
        spark.sql("SELECT 1 AS conv_id, 'q' AS prompt, 'a' AS response, 5 AS formatted, 6 AS s"),
        spark.sql("SELECT 1 AS conv_id, 'q' AS prompt, 'a' AS completion"),
        spark.sql("SELECT 1 AS conv_id, 'q' AS instruction, '' AS input, 'a' AS output"),
    ]
    for df in frames:
        row = chat.read_back(chat.format_turns(chat.canonical_turns(df))).first()
        assert spoken(row.turns) == want, df.columns
        assert row.loss_texts == ["a"]
    with_input = spark.sql("SELECT 1 AS conv_id, 's' AS system, 'q' AS instruction, 'more' AS input, 'a' AS output")
    row = chat.read_back(chat.format_turns(chat.canonical_turns(with_input))).first()
    assert spoken(row.turns) == [("system", "s"), ("user", "q\n\nmore"), ("assistant", "a")]
    with pytest.raises(ValueError, match="no mapping"):
        chat.canonical_turns(spark.sql("SELECT 1 AS a"))


def test_rows_of_one_table_in_two_layouts(spark):
    df = spark.sql(
        "SELECT 1 AS conv_id, 'q' AS prompt, 'a' AS response, CAST(NULL AS ARRAY<STRUCT<role: STRING, content: STRING>>) AS messages "
        "UNION ALL SELECT 2, NULL, NULL, array(named_struct('role', 'assistant', 'content', 'b'))"
    )
    out = {r.conv_id: spoken(r.turns) for r in chat.read_back(chat.format_turns(chat.canonical_turns(df))).collect()}
    assert out == {1: [("user", "q"), ("assistant", "a")], 2: [("assistant", "b")]}


def test_fingerprint_is_of_paths_not_of_their_order(spark):
    a = chat.field_paths(spark.sql("SELECT 1 AS conv_id, 'q' AS prompt, 'a' AS response").schema)
    b = chat.field_paths(spark.sql("SELECT 'a' AS response, 'q' AS prompt, 1 AS conv_id").schema)
    assert chat.fingerprint(a) == chat.fingerprint(b) == hashlib.sha256(b"conv_id\nprompt\nresponse").hexdigest()[:16]
    nested = spark.sql("SELECT 1 AS conv_id, array(named_struct('role', 'u', 'content', 'c')) AS messages").schema
    assert chat.field_paths(nested) == {"conv_id", "messages.[].role", "messages.[].content"}


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.digest_columns(chat.read_back(chat.format_turns(chat.canonical_turns(df)))).collect() == []
