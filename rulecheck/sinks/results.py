"""Where result rows go: appended, all rows of a run in one write job."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rulecheck.schema import JDBC_BATCH_SIZE, JDBC_ISOLATION_LEVEL, RESULT_COLUMNS, RESULT_SCHEMA

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class ParquetSink:
    """Results as a parquet folder, optionally partitioned, e.g. by business date.

    Folders are named after copies of the partition columns (``PART_<column>``), so
    the columns themselves stay in the files as written: order, types, nulls and
    empty texts come back unchanged. Filter on a ``PART_`` column (``read_parts``)
    to prune folders.
    """

    path: str
    partition_by: tuple[str, ...] = ()

    def append(self, df: DataFrame) -> None:
        parts = {f"PART_{c}": F.col(c).cast("string") for c in self.partition_by}
        writer = df.withColumns(parts).write.mode("append")
        if parts:
            writer = writer.partitionBy(*parts)
        writer.parquet(self.path)

    def read_parts(self, spark: SparkSession) -> DataFrame:
        """Results with the ``PART_`` columns."""
        parts = [StructField(f"PART_{c}", StringType()) for c in self.partition_by]
        return spark.read.schema(StructType(RESULT_SCHEMA.fields + parts)).parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        return self.read_parts(spark).select(*RESULT_COLUMNS)


@dataclass(frozen=True)
class TableSink:
    """Results as a table of the session catalog (created on the first append)."""

    name: str
    format: str = "parquet"

    def append(self, df: DataFrame) -> None:
        df.write.mode("append").format(self.format).saveAsTable(self.name)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.name).select(*RESULT_COLUMNS)


@dataclass(frozen=True)
class JdbcSink:
    """Results appended over JDBC.

    Each write partition opens one connection and inserts in batches. Unless
    ``num_partitions`` is given, every task of the results' last stage writes; a
    number bounds the connections, and with them that stage's tasks. With
    isolation ``NONE`` (the default) there is no transaction; pass
    ``READ_COMMITTED`` to get one transaction per partition. Either way an append
    is not atomic as a whole: a failed one may leave rows behind, and repeating it
    writes them again.
    """

    url: str
    table: str
    properties: dict[str, str] = field(default_factory=dict)
    batchsize: int = JDBC_BATCH_SIZE
    isolation_level: str = JDBC_ISOLATION_LEVEL
    num_partitions: int | None = None
    # Extra writer options, e.g. ``createTableColumnTypes`` for a new table.
    write_options: dict[str, str] = field(default_factory=dict)

    def _options(self) -> dict[str, str]:
        return {"url": self.url, "dbtable": self.table, **self.properties}

    def writer_options(self) -> dict[str, str]:
        bound = {} if self.num_partitions is None else {"numPartitions": str(self.num_partitions)}
        fixed = {"batchsize": str(self.batchsize), "isolationLevel": self.isolation_level}
        return self._options() | self.write_options | fixed | bound

    def append(self, df: DataFrame) -> None:
        df.write.format("jdbc").options(**self.writer_options()).mode("append").save()

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.format("jdbc").options(**self._options()).load()


def append_results(results: DataFrame, sink, row_count: int) -> bool:
    """Append a run's rows in one write. ``row_count`` is known from the run
    (no count job); nothing is written when it is zero."""
    if row_count == 0:
        logger.warning("nothing to append")
        return False
    logger.info("appending %d row(s): %s", row_count, sink)
    sink.append(results)
    return True
