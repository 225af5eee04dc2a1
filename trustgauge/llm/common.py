"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trustgauge.sources.workspace import settle, shuffle_width

# Characters between words, in a regular expression and as a plain string.
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@contextmanager
def _setting(spark: SparkSession, key: str, value: str, default: str) -> Iterator[None]:
    before = spark.conf.get(key, default)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def tidy_shuffles(spark: SparkSession):
    """Let Spark remove the shuffle files of each action as soon as it has ended."""
    return _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true", "false")


def small_batches(spark: SparkSession, rows: int = 500):
    """Hand rows of long texts to Python few at a time, which both sides then hold."""
    return _setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows), "10000")


def store(df: DataFrame, partition_by: Sequence[str] = (), narrow: bool = False) -> DataFrame:
    """Write to the shared folder and read back; the shuffles that led there are dropped.

    A ``narrow`` table, a few numbers a row, is written by a quarter of the usual tasks.
    """
    if narrow:
        df = df.coalesce(max(1, shuffle_width(df.sparkSession) // 4))
    with tidy_shuffles(df.sparkSession):
        return settle(df, partition_by)


def by_bytes(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold up to ``limit`` bytes of a column, or one longer row."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        seen = int(sizes[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, seen + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; null stays null."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def unit_hash(column: Column | str, seed: int) -> Column:
    """A double strictly between 0 and 1 that depends on the column and the seed alone.

    Made from the first 52 bits of an MD5 sum, so that any engine can reproduce it.
    """
    text = F.coalesce((F.col(column) if isinstance(column, str) else column).cast("string"), F.lit(""))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), text)), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def running(
    df: DataFrame, order: Sequence[Column], sums: Mapping[str, str] | None = None
) -> DataFrame:
    """Add ``rank``, the zero-based place in a global order, and sums over all earlier rows.

    ``sums`` maps a new column to the column it adds up. Rows are cut by range and written once
    with their part number, so that counts and ranks see the same cut even when a task is run
    again; every part is ordered on its own and the parts' offsets, one row each, are joined.
    A value that holds a third of all rows spans as many parts as it needs, as long as
    ``order`` ends in columns that tell its rows apart.
    """
    sums = dict(sums or {})
    placed = store(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_part").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(v).alias(f"_all_{k}") for k, v in sums.items()]
    )
    starts = totals.select(
        "_part",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"),
        *[
            F.coalesce(F.sum(f"_all_{k}").over(earlier), F.lit(0)).alias(f"_start_{k}")
            for k in sums
        ],
    )
    inside = Window.partitionBy("_part").orderBy(*order)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumns(
        {"rank": F.row_number().over(inside) - 1}
        | {k: F.coalesce(F.sum(v).over(before), F.lit(0)) for k, v in sums.items()}
    )
    # One row per shuffle partition.
    joined = local.join(F.broadcast(starts), "_part")
    return joined.withColumns(
        {"rank": F.col("rank") + F.col("_start")}
        | {k: F.col(k) + F.col(f"_start_{k}") for k in sums}
    ).drop("_part", "_start", *[f"_start_{k}" for k in sums])
