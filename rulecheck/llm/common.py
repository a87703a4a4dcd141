"""Staging on the cluster's shared folder, and small frame helpers."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rulecheck.session import ensure_checkpoint_dir


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Hand this package's code to the executors (Spark distributes the archive),
    once per application; executors need not have it installed."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        scratch = tempfile.mkdtemp(prefix="rulecheck-code-")  # the driver serves it while the application runs
        atexit.register(shutil.rmtree, scratch, ignore_errors=True)
        sc.addPyFile(shutil.make_archive(f"{scratch}/rulecheck", "zip", os.path.dirname(package), os.path.basename(package)))
        _shipped.add(sc.applicationId)
    return spark


_kept: dict[str, object] = {}


def kept_in_worker(key: str, make: Callable[[], object]):
    """An object that a Python worker keeps from one task of a query to the next
    (caches of pure functions only, so results never depend on it); one at a time."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/llm-staging/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet to shared storage and read it back: cuts the lineage,
    so a lost executor never repeats what came before, and gives Spark its real size."""
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffled(table: DataFrame) -> DataFrame:
    """``table`` as a side of a join that Spark shall not broadcast: tables of classes, nodes
    and links grow with the input, and their size on disk says little about that in memory."""
    return table.hint("merge")


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session; they are set in proportion to the input."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


NO_ID = -(1 << 63)


def document_key() -> tuple[Column, Column]:
    """``_k`` and ``_h``: order key and tie-break of documents. Rows of equal ``doc_id`` are told
    apart by 63 bits of a hash of their text; a null id stands as NO_ID with the sign bit of
    ``_h`` set, so it comes before all ids and is not taken for the smallest one."""
    none = F.col("doc_id").cast("long").isNull()
    bits = F.xxhash64(F.col("text").cast("string")).bitwiseAND(F.lit((1 << 63) - 1))
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    return key.alias("_k"), F.when(none, bits.bitwiseOR(F.lit(NO_ID))).otherwise(bits).alias("_h")


def id_of(key: str, tie: str) -> Column:
    """The document id of a key, null for none."""
    return F.when((F.col(key) != F.lit(NO_ID)) | (F.col(tie) >= 0), F.col(key))


def smallest(rows: DataFrame, most: int, *by: str) -> DataFrame:
    """The rows of the ``most`` smallest hashes of some columns (``drawn``), for a bounded
    sample that depends on the rows alone. Only hashes are sorted: each task keeps its
    ``most`` smallest, and the cut is one number."""
    drawn = rows.withColumn("drawn", F.xxhash64(*by))
    cut = drawn.select("drawn").orderBy("drawn").limit(most).agg(F.max("drawn")).first()[0]
    return drawn.where(F.col("drawn") <= F.lit(cut)) if cut is not None else drawn.where("false")


def documents(docs: DataFrame, *columns: str) -> DataFrame:
    """The named columns of ``docs`` (``doc_id`` as long, ``text`` as string), and no
    others, so extra columns of the input can never clash with an operator's own."""
    kinds = {"doc_id": T.LongType(), "text": T.StringType()}
    return docs.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in columns])
