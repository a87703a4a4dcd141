"""Connected components of an edge table, by joins on the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rulecheck.llm.common import shuffled, staging_path
from rulecheck.session import delete_folder


def _written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    spark, path = df.sparkSession, staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``label`` (the smallest node of its component) of every node of ``a``-``b`` edges.

    Labels are a forest that points to smaller nodes. In each round a node takes the
    smallest label among its neighbours (summed up before the shuffle, so a node with
    very many neighbours is no hot spot) and hooks the root of its own tree on it as
    well; then every node skips one step of its tree. A smaller label so reaches a
    whole tree through its root, and trees halve in depth, so rounds grow with the
    logarithm of the longest path, chains included. A round is one job's write to
    shared storage, which also counts the labels that changed; the last one changes
    none. Superseded rounds are deleted. An empty edge table has no nodes.
    """
    return _labelled(edges)[0]


def _labelled(edges: DataFrame) -> tuple[DataFrame, int]:
    """``components``, and the number of rounds."""
    spark: SparkSession = edges.sparkSession
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
    both, links = _written(both.distinct(), "edges")
    labels, path = _written(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("label")), "labels")
    rounds = 0
    while True:
        heard = both.join(shuffled(labels.select(F.col("node").alias("other"), "label")), "other").groupBy("node").agg(F.min("label").alias("low"))
        told = labels.join(shuffled(heard), "node")
        own = told.select("node", F.least("label", "low").alias("near"), F.col("label").alias("was"))
        roots = told.where("low < label").select(F.col("label").alias("node"), F.col("low").alias("near"), F.lit(None).cast("bigint").alias("was"))
        hooked = own.unionByName(roots).groupBy("node").agg(F.min("near").alias("near"), F.max("was").alias("was"))
        above = hooked.select(F.col("node").alias("near"), F.col("near").alias("label"))
        after = hooked.join(shuffled(above), "near").select("node", "label", "was")
        watched = Observation()
        after = after.observe(watched, F.count(F.when(F.col("label") < F.col("was"), 1)).alias("changed"))
        after, newer = _written(after, "labels")
        delete_folder(spark, path)
        labels, path, rounds = after.select("node", "label"), newer, rounds + 1
        if not watched.get["changed"]:
            delete_folder(spark, links)
            return labels, rounds
