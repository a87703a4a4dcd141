"""Contract queries of the operators, and DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rulecheck.llm.chat import OP1_SQL, op1_chat
from rulecheck.llm.encoding import op10_encoding
from rulecheck.llm.fingerprints import op2_fingerprints
from rulecheck.llm.jaccard import op7_jaccard
from rulecheck.llm.language import op6_language
from rulecheck.llm.packing import op9_packing
from rulecheck.llm.page_text import op12_main_text
from rulecheck.llm.prefix_trie import OP11_SQL, op11_prefixes
from rulecheck.llm.quality import op3_quality
from rulecheck.llm.substrings import OP4_SQL, op4_substrings
from rulecheck.llm.topk import OP5_SQL, op5_topk
from rulecheck.llm.vector_codes import OP13_SQL, op13_codes
from rulecheck.llm.warc import OP8_SQL, op8_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat": op1_chat,
    "op2_fingerprints": op2_fingerprints,
    "op3_quality": op3_quality,
    "op4_substrings": op4_substrings,
    "op5_topk": op5_topk,
    "op6_language": op6_language,
    "op7_jaccard": op7_jaccard,
    "op8_warc": op8_warc,
    "op9_packing": op9_packing,
    "op10_encoding": op10_encoding,
    "op11_prefixes": op11_prefixes,
    "op12_main_text": op12_main_text,
    "op13_codes": op13_codes,
}

ORACLES: dict[str, str] = {
    "op1_chat": OP1_SQL,
    "op4_substrings": OP4_SQL,
    "op5_topk": OP5_SQL,
    "op8_warc": OP8_SQL,
    "op11_prefixes": OP11_SQL,
    "op13_codes": OP13_SQL,
}
