from __future__ import annotations

import os
import sys
import tempfile

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if REPO not in sys.path:
    sys.path.insert(0, REPO)

from pyspark.sql import SparkSession  # noqa: E402

from rulecheck.sources.tables import register_parquet_tables  # noqa: E402
from rulecheck.testing import corpus as C  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="rulecheck-tests-")
    session = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
        .config("spark.checkpoint.dir", os.path.join(scratch, "checkpoints"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session


@pytest.fixture(scope="session")
def tables(spark):
    register_parquet_tables(spark, SF_SMALL, C.TABLES)
    return SF_SMALL


@pytest.fixture(scope="session")
def catalog(spark, tables):
    return C.test_catalog(spark)
