"""Target tables that rule text refers to.

Rule text names tables as ``$ds.<table>``. Tables of the session catalog (Hive
or any other catalog) resolve directly. Parquet folders without a catalog are
exposed as global temporary views, so ``$ds`` can be ``global_temp``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

GLOBAL_TEMP_SCHEMA = "global_temp"


def register_parquet_tables(spark: SparkSession, base_dir: str, names: Iterable[str]) -> str:
    """Register ``{base_dir}/{name}.parquet`` as ``global_temp.<name>`` for each name.

    Registration is lazy: only the parquet footers are read for the schema.
    Returns the schema name to use as ``DQ_SCHEMA``.
    """
    for name in names:
        spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet").createOrReplaceGlobalTempView(name)
    return GLOBAL_TEMP_SCHEMA
