"""Placeholder rendering of rule text as Column expressions.

Rendering runs over the catalog DataFrame, so it is evaluated by Spark for
every rule in one pass; the driver only receives the finished text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rulecheck.schema import PLACEHOLDER_TOKENS, UNRESOLVED_MESSAGE, UNRESOLVED_PATTERN


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def render_placeholders(
    sql: Column | str,
    schema: Column | str,
    sor: Column | str,
    fic_mis_date: str,
    as_of_dt: str,
) -> Column:
    """Replace every occurrence of ``$ds``, ``$vdo``, ``$misdate``, ``$asofdt``, in that
    order, literally and case-sensitively. A null schema or label renders as ''.

    Literal replacement (``replace``), not ``regexp_replace``: a ``$`` in a value
    must not be read as a group reference. Because the replacements chain, a
    schema value containing ``$vdo`` is expanded by the next step.
    """
    values = (
        F.coalesce(_col(schema).cast("string"), F.lit("")),
        F.coalesce(_col(sor).cast("string"), F.lit("")),
        F.lit(fic_mis_date),
        F.lit(as_of_dt),
    )
    out = _col(sql)
    for token, value in zip(PLACEHOLDER_TOKENS, values):
        out = F.replace(out, F.lit(token), value)
    return out


def unresolved_placeholders(rendered: Column | str) -> Column:
    """All matches of ``$`` followed by letters or underscores, in order of appearance."""
    return F.regexp_extract_all(_col(rendered), F.lit(UNRESOLVED_PATTERN), F.lit(0))


def unresolved_message(unresolved: list[str], rendered: str, excerpt: int | None = None) -> str:
    """Error text for a rule whose rendered SQL still holds placeholders, with all of
    that SQL or its first ``excerpt`` characters."""
    return UNRESOLVED_MESSAGE.format(unresolved=repr(unresolved), sql=rendered[:excerpt])
