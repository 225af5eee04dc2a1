"""Exact ranks and order statistics without sorting a group in one task."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trustgauge.sources.workspace import settle

# Hex digits of the hash that name a cell: 65 536 cells, each an even share of any group.
CELL_DIGITS = 4
CELL_COUNT = 16**CELL_DIGITS

# A bracket with at most this many rows is ordered in one task.
DIRECT_ROWS = 1_000_000
HISTOGRAM_CELLS = 4096


def hash_order(id_col: Column, seed: int) -> Column:
    """Seeded order of rows that any engine and any partitioning reproduces."""
    return F.md5(F.concat(F.lit(f"{seed}:"), id_col.cast("string")))


def _cell(key: Column) -> Column:
    return F.substring(key, 1, CELL_DIGITS)


def hash_rank(df: DataFrame, id_col: str, seed: int, rank_name: str = "rank") -> DataFrame:
    """Zero-based rank of every row in hash order, as (id, rank).

    Rows are ordered inside their hash cell, and a cell's offset comes from the cell counts.
    """
    key = hash_order(F.col(id_col), seed)
    keyed = df.select(F.col(id_col), key.alias("_key"), _cell(key).alias("_cell"))
    earlier = Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = keyed.groupBy("_cell").agg(F.count(F.lit(1)).alias("_n")).select(
        "_cell", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy("_cell").orderBy("_key", id_col)
    # At most CELL_COUNT offsets exist, however large the table.
    return keyed.withColumn("_row", F.row_number().over(inside)).join(
        F.broadcast(offsets), "_cell"
    ).select(id_col, (F.col("_start") + F.col("_row") - 1).alias(rank_name))


def hash_cuts(
    df: DataFrame,
    group: str,
    id_col: str,
    seed: int,
    cut_ranks: Sequence[Callable[[Column], Column]],
) -> DataFrame:
    """Per group, the (hash, id) pair at each requested rank, as columns cut_0, cut_1, ...

    Each function maps the group's row count to a one-based rank; rank 0 gives null. Only the
    narrow key columns are read, and only the cells that hold a cut are ordered.
    """
    key = hash_order(F.col(id_col), seed)
    keyed = df.select(
        F.col(group), F.col(id_col), key.alias("_key"), _cell(key).alias("_cell")
    )
    ordered = Window.partitionBy(group).orderBy("_cell")
    counts = keyed.groupBy(group, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    spans = counts.select(
        group,
        "_cell",
        (F.sum("_n").over(ordered) - F.col("_n")).alias("_start"),
        "_n",
        F.sum("_n").over(Window.partitionBy(group)).alias("_total"),
    )
    wanted = spans.select(
        group,
        "_cell",
        "_start",
        "_n",
        F.posexplode(F.array(*[f(F.col("_total")).cast("long") for f in cut_ranks])).alias(
            "_cut", "_rank"
        ),
    ).where((F.col("_rank") > F.col("_start")) & (F.col("_rank") <= F.col("_start") + F.col("_n")))
    wanted = settle(
        wanted.select(group, "_cell", "_cut", (F.col("_rank") - F.col("_start")).alias("_row"))
    )
    inside = Window.partitionBy(group, "_cell").orderBy("_key", id_col)
    edge = keyed.join(wanted.select(group, "_cell").distinct(), [group, "_cell"], "left_semi")
    hits = edge.withColumn("_row", F.row_number().over(inside)).join(
        wanted, [group, "_cell", "_row"]
    )
    return settle(
        hits.groupBy(group).agg(
            *[
                F.max(F.when(F.col("_cut") == i, F.struct("_key", id_col))).alias(f"cut_{i}")
                for i in range(len(cut_ranks))
            ]
        )
    )


def ordered_rank(df: DataFrame, order: Sequence[Column], rank_name: str = "idx") -> DataFrame:
    """Zero-based rank in a global order, for tables too long for one sorted task.

    The range-partitioned rows are written with their partition number first, so both the
    counts and the ranks read the same cut.
    """
    placed = settle(
        df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy("_part").orderBy(*order)
    # One row per shuffle partition.
    return (
        placed.withColumn("_row", F.row_number().over(inside))
        .join(F.broadcast(starts), "_part")
        .withColumn(rank_name, (F.col("_start") + F.col("_row") - 1).cast("int"))
        .drop("_part", "_row", "_start")
    )


def order_statistics(
    df: DataFrame,
    group: str,
    value: str,
    ranks: Mapping[float, Callable[[Column], Column]],
    tag_name: str = "tag",
    value_name: str = "value",
    direct_rows: int = DIRECT_ROWS,
) -> DataFrame:
    """Exact k-th smallest value per group for each tag: (group, tag, n, value).

    Starts from the range of each group and zooms into the histogram cell that holds the rank
    until few rows are left, each round one narrow scan with a map-side combined count. Equal
    values are counted together, so ties of any size cost one row.
    """
    data = df.select(group, F.col(value).alias("_v")).where(F.col("_v").isNotNull())
    whole = data.groupBy(group).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
    )
    rank_structs = F.array(
        *[
            F.struct(F.lit(tag).alias("tag"), f(F.col("_n")).cast("long").alias("rank"))
            for tag, f in ranks.items()
        ]
    )
    requests = settle(
        whole.withColumn("_r", F.explode(rank_structs)).select(
            group,
            F.col("_r.tag").alias("_tag"),
            F.col("_r.rank").alias("_rank"),
            "_lo",
            "_hi",
            F.col("_n").alias("_left"),
            "_n",
        )
    )
    bracket = [group, "_lo", "_hi"]
    in_bracket = (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))
    wide = (F.col("_left") > direct_rows) & (F.col("_lo") < F.col("_hi"))
    while not requests.where(wide).isEmpty():
        share = (F.col("_v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
        cell = F.least(F.floor(share * HISTOGRAM_CELLS), F.lit(HISTOGRAM_CELLS - 1))
        cells = (
            data.join(requests.where(wide).select(*bracket).distinct(), group)
            .where(in_bracket)
            .groupBy(*bracket, cell.alias("_cell"))
            .agg(
                F.count(F.lit(1)).alias("_c"),
                F.min("_v").alias("_lo2"),
                F.max("_v").alias("_hi2"),
            )
        )
        upto = Window.partitionBy(*bracket).orderBy("_cell")
        cells = cells.withColumn("_start", F.sum("_c").over(upto) - F.col("_c"))
        zoomed = (
            requests.where(wide)
            .join(cells, bracket)
            .where(
                (F.col("_rank") > F.col("_start"))
                & (F.col("_rank") <= F.col("_start") + F.col("_c"))
            )
            .select(
                group,
                "_tag",
                (F.col("_rank") - F.col("_start")).alias("_rank"),
                F.col("_lo2").alias("_lo"),
                F.col("_hi2").alias("_hi"),
                F.col("_c").alias("_left"),
                "_n",
            )
        )
        requests = settle(requests.where(~wide).unionByName(zoomed))

    values = (
        data.join(requests.where("_lo < _hi").select(*bracket).distinct(), group)
        .where(in_bracket)
        .groupBy(*bracket, "_v")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    upto = Window.partitionBy(*bracket).orderBy("_v")
    values = values.withColumn("_end", F.sum("_c").over(upto))
    picked = requests.join(
        values, bracket, "left"
    ).where((F.col("_lo") == F.col("_hi")) | (F.col("_end") >= F.col("_rank")))
    return picked.groupBy(
        group, F.col("_tag").alias(tag_name), F.col("_n").alias("n")
    ).agg(F.min(F.coalesce("_v", "_lo")).alias(value_name))
