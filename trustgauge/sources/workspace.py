"""Intermediate tables on shared storage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def workspace_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir.

    Only a local session without that setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", "") or (
        spark.sparkContext.getCheckpointDir() or ""
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="trustgauge-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


# Paths handed out in this process and not yet swept.
_handed_out: list[str] = []


def scratch_path(spark: SparkSession) -> str:
    """A new path in the shared folder."""
    path = f"{workspace_dir(spark)}/trustgauge/{uuid.uuid4().hex}"
    _handed_out.append(path)
    return path


def sweep(spark: SparkSession) -> int:
    """Remove all intermediate tables of this process, once no result reads them any more."""
    context = spark.sparkContext
    removed = 0
    while _handed_out:
        path = context._jvm.org.apache.hadoop.fs.Path(_handed_out.pop())
        removed += path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
    return removed


def settle(
    df: DataFrame,
    partition_by: Sequence[str] = (),
    schema: T.StructType | None = None,
) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back.

    This cuts the lineage in a way that survives lost executors, keeps columns prunable, and
    gives the optimizer the true size: a join with a settled table is a broadcast only while
    the files stay under spark.sql.autoBroadcastJoinThreshold, and a shuffle join beyond it.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spread a table of few files over the tasks; a table of many files stays as it is.

    For rows that are widened inside the task, such as scores against a grid.
    """
    if len(df.inputFiles()) >= shuffle_width(df.sparkSession):
        return df
    return by_key(df, *keys)


def in_place(df: DataFrame, *keys: str) -> DataFrame:
    """A table as it is read while its rows lie evenly over enough tasks, else spread by key."""
    rows = df.select(F.spark_partition_id().alias("_part")).groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    largest, total = rows.agg(F.max("_n"), F.sum("_n")).first()
    if (largest or 0) * df.sparkSession.sparkContext.defaultParallelism <= 2 * (total or 0):
        return df
    return by_key(df, *keys)


def by_key(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition by key once, so later groupings on the key need no shuffle.

    The explicit width keeps AQE from folding small inputs into one task: a row of text
    grows by an order of magnitude once it is cut into terms.
    """
    return df.repartition(shuffle_width(df.sparkSession), *keys)
