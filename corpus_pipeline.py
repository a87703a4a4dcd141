"""From raw documents to packed training sequences, in five stages.

Every stage takes ``(spark, docs, sf_dir)`` and returns a frame; each result is
written as Parquet and read again as the next stage's documents. All stages but
the last return the columns of ``documents``. A row is kept or dropped as a whole; only
substring dedup changes a column. Extra columns, also of names that a stage uses itself,
pass through all stages but the last; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulecheck.llm import jaccard, language, packing, quality, substrings
from rulecheck.llm.common import stage

LEAST_QUALITY = 0.5
LEAST_LANGUAGE_SCORE = 0.25


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not take for bad ones.

    Null and empty texts score by the intercept alone; rows without ``doc_id`` never train
    but are scored; repeated rows are scored, and so kept or dropped, alike; a score of
    exactly LEAST_QUALITY stays, so all rows stay where there are no labels.
    """
    weights = quality.fit(docs, quality.labels_of(spark, sf_dir))
    return quality.score_documents(docs, weights).where(F.col("score") >= LEAST_QUALITY).select("_rest.*")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages.

    Null and empty texts and texts without a letter are in none and go; so does everything
    where no row names a language. Rows with null ``doc_id`` or ``lang`` never train but are
    judged by their text; repeated rows are judged alike; a score of exactly
    LEAST_LANGUAGE_SCORE stays.
    """
    found = language.predict_documents(docs, language.fit(docs))
    return found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE)).select("_rest.*")


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest ``doc_id``.

    Null, empty and wordless texts link with nothing and all stay, repeated ones too. A null
    ``doc_id`` comes before all others; of different texts with one ``doc_id`` that of the
    smaller hash comes first; of rows equal in both one stays.
    """
    return jaccard.keep_first(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without words of passages that occur earlier; other texts as they are.

    A text that loses no word keeps its white space, null stays null and empty empty; one
    that loses all its words becomes empty. ``n_chars`` counts the new text. Documents are
    ordered by ``doc_id``, null first, then by a hash of the text; rows equal in both are
    one document and lose the same words.
    """
    found = substrings.remove_repeats(docs, as_is=True, nulls=True)
    renewed = {"text": F.col("text"), "n_chars": F.char_length("text").cast("bigint")}
    return found.select(*[renewed.get(c, F.col(f"_rest.`{c}`")).alias(c) for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences, with their token ids.

    Null and empty texts are one piece with the end id alone; null ids stay; repeated rows
    are packed once each; texts of any length are cut at the ends of sequences.
    """
    import public_tokenizers

    pieces = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_classifier),
    ("language_id", language_id),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("substring_dedup", substring_dedup),
    ("packing", pack),
]

#: Trained classifiers are not expressible in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
