"""Sharding by proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustgauge.llm.common import running, store

SHARDS = 24
SEED = 20
# Bytes that a record takes besides its text.
OVERHEAD = 8


def assign_shards(
    docs: DataFrame,
    shards: int = SHARDS,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    row_col: str | None = None,
) -> DataFrame:
    """Place of every row: (id, source, size, text_crc32, shard, slot[, row_col]).

    Rows are put in a seeded order within their source; the r-th of n rows has the fraction
    (r + 1/2) / n, and the order of fractions over all sources is cut into ``shards`` runs whose
    counts differ by one at most. Every run, and every stretch within it, so holds each source
    in its share, to within a row or so per source. Slots number a shard's rows from 0.

    Both orders are made from ranges of narrow rows, so a source with a third of all rows is
    spread over as many tasks as others; texts don't move. A null text has no bytes, a null source is a
    source, equal rows take places side by side in the order, a null id is an id, and an empty
    table gives an empty result. A ``row_col`` is carried along.
    """
    row = [row_col] if row_col else []
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"),
        (F.octet_length(F.coalesce(F.col(text_col), F.lit(""))) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"), *row,
    ).withColumn("_order", F.xxhash64(F.lit(seed), F.col("id"), F.col("text_crc32")))
    ties = [F.col(c) for c in ("_order", "id", "text_crc32", "size", *row)]
    ranked = store(running(rows, [F.col("source"), *ties]))
    # One row per source; the first of its rows gives its start in the order.
    strata = store(
        ranked.groupBy("source").agg(F.count(F.lit(1)).alias("_n"), F.min("rank").alias("_first"))
    ).withColumnRenamed("source", "_source")
    fraction = (F.col("rank") - F.col("_first") + 0.5) / F.col("_n")
    mixed = ranked.join(strata, F.col("source").eqNullSafe(F.col("_source"))).withColumn(
        "_fraction", fraction
    ).select("id", "source", "size", "text_crc32", "_order", "_fraction", *row)
    total = ranked.count()
    placed = running(mixed, [F.col("_fraction"), *ties])
    shard = F.expr(f"(rank * {shards}L) div {max(total, 1)}L")
    start = F.expr(f"(shard * {total}L + {shards - 1}L) div {shards}L")
    return placed.withColumn("shard", shard).withColumn("slot", F.col("rank") - start).select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "text_crc32",
        F.col("shard").cast("int").alias("shard"), "slot", *row,
    )


def write_shards(docs: DataFrame, path: str, **settings) -> None:
    """Write ``docs`` as one folder per shard, rows in slot order.

    Rows meet their place by a number of their own, stored with them before they are ranked, so
    rows without id and equal rows are each written once. A null text is empty, a null source one of
    its own. An empty table writes no shard; columns of ``docs`` must not be named shard or slot.
    """
    docs = store(docs.withColumn("_row", F.monotonically_increasing_id()))
    places = store(assign_shards(docs, **settings, row_col="_row").select("_row", "shard", "slot"))
    docs.join(places, "_row").drop("_row").repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)
