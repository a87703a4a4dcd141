"""Chat formatting: heterogeneous conversation layouts to one training template.

A table's layout is recognised by its schema fingerprint: the sorted list of its
nested field paths (array elements as ``[]``) that belong to a known mapping's
vocabulary, hashed. The fingerprint selects a declarative mapping, which says
where ids, turns, roles and texts are. Layouts within one table (rows that fill
different columns) are told apart by the same hash over the paths a row fills.
All work is DataFrame and SQL functions.

Template, per turn::

    ### <role>\\n<text></turn>\\n

Inside roles and texts ``\\`` becomes ``\\b``, ``</turn>`` becomes ``\\e`` and
``### `` becomes ``\\h`` (in roles also a line feed ``\\n``), so control strings
occur only where the template puts them and ``read_back`` is exact.

The loss mask of a conversation is a list of (start, length) spans in code
points of the formatted string, one per assistant text.

Cases: null text or role is empty; turns are ordered by turn number, then role,
then text (nulls first), so repeated turns are all kept in a fixed order; an
empty table gives no conversations; rows with a null id form one conversation
with a null id; extra columns are ignored, whatever their names; texts have any
length, conversations any number of turns (the work grows in proportion to them).
A conversation is one string and one digest, so one task holds it whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

END = "</turn>\n"
HEAD = "### "
ASSISTANT = "assistant"
# What stands for a control string inside a text, in the order of escaping.
ESCAPES = (("\\", "\\b"), ("</turn>", "\\e"), ("### ", "\\h"))
SPEAKERS = (("human", "user"), ("prompter", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))


@dataclass(frozen=True)
class Mapping:
    """Where one layout keeps its conversation.

    ``id`` names the id column. ``turns``: an array column with ``role`` and
    ``text`` fields; or ``rows``: one turn per row, numbered by that column; or
    ``fixed``: pairs of a role and the columns whose texts (joined by a blank
    line, empty ones left out) make that turn.
    """

    id: str
    role: str = ""
    text: str = ""
    turns: str = ""
    rows: str = ""
    fixed: tuple[tuple[str, tuple[str, ...]], ...] = ()
    roles: tuple[tuple[str, str], ...] = ()  # this layout's names of roles

    def paths(self) -> frozenset[str]:
        """Nested field paths this layout needs."""
        if self.turns:
            return frozenset({self.id, f"{self.turns}.[].{self.role}", f"{self.turns}.[].{self.text}"})
        if self.rows:
            return frozenset({self.id, self.rows, self.role, self.text})
        return frozenset({self.id, *(c for _, columns in self.fixed for c in columns)})


# Most specific first: a table that fits several takes the first.
MAPPINGS = (
    Mapping("conv_id", "role", "content", turns="messages"),
    Mapping("conv_id", "from", "value", turns="conversations", roles=SPEAKERS),
    Mapping("conv_id", "role", "text", rows="turn"),
    Mapping("conv_id", fixed=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping("conv_id", fixed=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping("conv_id", fixed=(("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping("conv_id", fixed=(("user", ("prompt",)), ("assistant", ("completion",)))),
)


def field_paths(kind: T.DataType, prefix: str = "") -> set[str]:
    """Paths of all leaf fields of a schema, array elements as ``[]``."""
    if isinstance(kind, T.StructType):
        return {p for f in kind.fields for p in field_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)}
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{prefix}.[]")
    return {prefix}


def fingerprint(paths: set[str] | frozenset[str]) -> str:
    """Hash of a set of field paths."""
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def registry(mappings: tuple[Mapping, ...] = MAPPINGS) -> dict[str, Mapping]:
    return {fingerprint(m.paths()): m for m in mappings}


def layouts(schema: T.StructType, mappings: tuple[Mapping, ...] = MAPPINGS) -> list[str]:
    """Fingerprints of the known layouts whose paths a schema holds; extra columns don't matter."""
    have = field_paths(schema)
    found = [fingerprint(have & m.paths()) for m in mappings if m.paths() <= have]
    known = registry(mappings)
    return list(dict.fromkeys(f for f in found if f in known))


def _column(name: str) -> Column:
    return F.col(f"`{name}`")


def _row_fingerprint(choices: list[Mapping]) -> Column:
    """Fingerprint of the paths a row fills: of the first layout with a filled column that
    no other layout before it explains; the first layout where all are null."""
    out: Column | None = None
    for m in choices:
        tops = {p.split(".")[0] for p in m.paths()} - {m.id}
        filled = reduce(lambda a, b: a & b, [_column(c).isNotNull() for c in sorted(_needed(m, tops))])
        code = F.lit(fingerprint(m.paths()))
        out = F.when(filled, code) if out is None else out.when(filled, code)
    return out.otherwise(F.lit(fingerprint(choices[0].paths())))


def _needed(m: Mapping, tops: set[str]) -> set[str]:
    """Columns that must be filled for a row to have a layout; an instruction's input may be absent."""
    return {columns[0] for _, columns in m.fixed} or ({m.turns} if m.turns else tops - {m.text, m.role})


def canonical_turns(df: DataFrame, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """Turn rows (``conv_id``, ``turn``, ``role``, ``text``) of a table in any known layout."""
    known = registry(mappings)
    codes = layouts(df.schema, mappings)
    if not codes:
        raise ValueError(f"no mapping for a table with fields {sorted(field_paths(df.schema))}")
    if len(codes) == 1:
        return _apply(df, known[codes[0]])
    tagged = df.withColumn("__layout", _row_fingerprint([known[c] for c in codes]))
    parts = [_apply(tagged.where(F.col("__layout") == c), known[c]) for c in codes]
    return reduce(DataFrame.unionByName, parts)


def _apply(df: DataFrame, m: Mapping) -> DataFrame:
    conv = _column(m.id).cast("bigint").alias("conv_id")
    text: Callable[[Column], Column] = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    if m.rows:
        return df.select(conv, _column(m.rows).cast("bigint").alias("turn"), _role(text(_column(m.role)), m), text(_column(m.text)).alias("text"))
    if m.turns:
        rows = df.select(conv, F.posexplode(_column(m.turns)).alias("turn", "__t"))
        return rows.select("conv_id", F.col("turn").cast("bigint"), _role(text(F.col("__t")[m.role]), m), text(F.col("__t")[m.text]).alias("text"))
    joined = [F.array_join(F.filter(F.array(*[text(_column(c)) for c in columns]), lambda x: x != ""), "\n\n") for _, columns in m.fixed]
    parts = [F.struct(F.lit(i).cast("bigint").alias("turn"), F.lit(role).alias("role"), j.alias("text")) for i, ((role, _), j) in enumerate(zip(m.fixed, joined, strict=True))]
    keep = F.filter(F.array(*parts), lambda t: (t["role"] != "system") | (t["text"] != ""))
    return df.select(conv, F.inline(keep))


def _role(role: Column, m: Mapping) -> Column:
    """Canonical name of a layout's role; unknown roles stay as they are."""
    names = F.coalesce(*[F.when(role == a, F.lit(b)) for a, b in m.roles], role) if m.roles else role
    return names.alias("role")


def escape(text: Column) -> Column:
    return reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), ESCAPES, text)


def unescape(text: Column) -> Column:
    return reduce(lambda c, e: F.replace(c, F.lit(e[1]), F.lit(e[0])), reversed(ESCAPES), text)


def _escaped(role: Column, text: Column) -> tuple[Column, Column]:
    """A turn's head line and its body, as the template writes them."""
    return F.concat(F.lit(HEAD), F.replace(escape(role), F.lit("\n"), F.lit("\\n")), F.lit("\n")), escape(text)


def format_turns(turns: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, and ``loss_spans``
    (start from 0 and length, in code points) of the assistant texts.

    One shuffle by conversation brings the turns together in their order; places are
    running sums of the lengths, so the work grows in proportion to the turns.
    """
    head, body = _escaped(F.col("role"), F.col("text"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    length = (F.char_length(head) + F.char_length(body) + F.lit(len(END))).cast("bigint")
    placed = turns.select("conv_id", "turn", "role", "text", F.sum(length).over(order).alias("until"))
    piece = F.struct(
        "until",
        F.concat(head, body, F.lit(END)).alias("piece"),
        F.char_length(body).cast("bigint").alias("length"),
        (F.col("role") == ASSISTANT).alias("loss"),
    )
    grouped = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(piece)).alias("t"))
    spans = F.transform(
        F.filter("t", lambda p: p["loss"]),
        lambda p: F.struct((p["until"] - F.lit(len(END)) - p["length"]).alias("start"), p["length"].alias("length")),
    )
    return grouped.select("conv_id", F.array_join(F.col("t")["piece"], "").alias("formatted"), spans.alias("loss_spans"))


def _spans_are_assistant_texts(segments: Column, spans: Column) -> Column:
    """Whether the mask's spans are exactly the assistant segments' texts, in order: one
    walk over the segments that keeps the place reached and the number of spans met."""
    skip = len(HEAD + ASSISTANT) + 1
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit(0).alias("met"), F.lit(True).alias("same"))

    def step(acc: Column, x: Column) -> Column:
        spoken = F.startswith(x, F.lit(f"{HEAD}{ASSISTANT}\n"))
        span = F.get(spans, acc["met"])
        fits = (span["start"] == acc["at"] + skip) & (span["length"] == F.char_length(x) - skip)
        return F.struct(
            (acc["at"] + F.char_length(x) + F.lit(len(END))).alias("at"),
            (acc["met"] + F.when(spoken, 1).otherwise(0)).alias("met"),
            (acc["same"] & (~spoken | F.coalesce(fits, F.lit(False)))).alias("same"),
        )

    return F.aggregate(segments, start, step, lambda acc: acc["same"] & (acc["met"] == F.size(spans)))


def read_back(formatted: DataFrame) -> DataFrame:
    """Parse formatted strings: ``conv_id``, ``turns`` (role, text) and ``loss_texts``,
    the unescaped text under each span of the mask.

    A mask that covers the assistant texts is checked in one walk and its texts come
    from the split segments; any other mask is read span by span from the string.
    """
    segments = F.filter(F.split("formatted", F.lit(END)), lambda x: x != "")
    head = lambda x: F.substring_index(x, "\n", 1)
    turns = F.transform(
        segments,
        lambda x: F.struct(
            unescape(F.replace(F.substr(head(x), F.lit(len(HEAD) + 1)), F.lit("\\n"), F.lit("\n"))).alias("role"),
            unescape(F.substr(x, F.char_length(head(x)) + 2)).alias("text"),
        ),
    )
    spoken = F.filter(segments, lambda x: F.startswith(x, F.lit(f"{HEAD}{ASSISTANT}\n")))
    texts = F.transform(spoken, lambda x: unescape(F.substr(x, F.lit(len(HEAD + ASSISTANT) + 2))))
    masked = F.transform(
        "loss_spans",
        lambda s: unescape(F.substr("formatted", (s["start"] + 1).cast("int"), s["length"].cast("int"))),
    )
    loss = F.when(_spans_are_assistant_texts(segments, F.col("loss_spans")), texts).otherwise(masked)
    return formatted.select("*", turns.alias("turns"), loss.alias("loss_texts"))


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: all conversations and one that holds control strings."""
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    probe = spark.range(1).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.array(*[F.struct(F.lit(r).alias("role"), F.lit("\\### Assistant: </turn> ok").alias("content")) for r in ("user", "assistant")]).alias("messages"),
    )
    turns = canonical_turns(table).unionByName(canonical_turns(probe))
    return digest_columns(read_back(format_turns(turns)))


def digest_columns(parsed: DataFrame) -> DataFrame:
    """The query's columns, from what was read back."""
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return parsed.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(spoken, 256).alias("turns_sha256"),
        F.char_length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("bigint").alias("formatted_chars"),
    )


# DuckDB: the same digests straight from the table; formatted length from the template's parts.
OP1_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(COUNT(*) AS BIGINT) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(SUM(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
  CAST(SUM(4 + length(role) + 1 + length(replace(replace(replace(text, '\', '\b'), '</turn>', '\e'), '### ', '\h')) + 8) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""
