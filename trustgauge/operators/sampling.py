"""Splits, limits and bootstrap draws, all from seeded hashes of a stable id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustgauge.operators.ranking import hash_cuts, hash_order, hash_rank

TRAIN, CALIBRATION, TEST = "train", "calibration", "test"
TRAIN_SHARE, CALIBRATION_SHARE = 0.60, 0.20


def stratified_split(
    df: DataFrame,
    target_col: str = "target",
    id_col: str = "id",
    train_fraction: float = TRAIN_SHARE,
    calibration_fraction: float = CALIBRATION_SHARE,
    seed: int = 42,
) -> DataFrame:
    """Add a ``split`` column that keeps the class ratios to the row.

    Per class, the first round(n * fraction) ids in hash order train and the next calibrate
    (halves round to even). The rank at each cut is found on the key columns alone; the rows
    themselves are then labelled by comparing with two keys, without a shuffle.
    """
    if train_fraction <= 0 or calibration_fraction <= 0:
        raise ValueError("train_fraction and calibration_fraction must be positive")
    if train_fraction + calibration_fraction >= 1:
        raise ValueError("train_fraction + calibration_fraction must be below 1")

    def train_end(n: Column) -> Column:
        return F.rint(n * F.lit(train_fraction))

    def calibration_end(n: Column) -> Column:
        return F.least(train_end(n) + F.rint(n * F.lit(calibration_fraction)), n)

    cuts = hash_cuts(df, target_col, id_col, seed, [train_end, calibration_end])
    key = F.struct(hash_order(F.col(id_col), seed).alias("_key"), F.col(id_col))
    return (
        df.join(cuts, target_col, "left")
        .withColumn(
            "split",
            F.when(key <= F.col("cut_0"), TRAIN)
            .when(key <= F.col("cut_1"), CALIBRATION)
            .otherwise(TEST),
        )
        .drop("cut_0", "cut_1")
    )


def limit_rows(
    df: DataFrame, limit: int, group: str = "split", id_col: str = "id", seed: int = 42
) -> DataFrame:
    """First ``limit`` rows of every group in hash order; zero or less keeps all."""
    if limit <= 0:
        return df
    cuts = hash_cuts(df, group, id_col, seed, [lambda n: F.least(n, F.lit(limit))])
    key = F.struct(hash_order(F.col(id_col), seed).alias("_key"), F.col(id_col))
    return df.join(cuts, group).where(key <= F.col("cut_0")).drop("cut_0")


def bootstrap_draws(n_rows: int, members: int, seed: int, spark) -> DataFrame:
    """n draws with replacement per member: one (member, rank) row per draw."""
    # Fixed value: 15 hex digits of the hash, so a draw stays uniform far beyond 2^32 rows.
    digits = 15
    slot = F.col("id")
    member = F.floor(slot / F.lit(n_rows)).cast("int")
    draw = F.conv(
        F.substring(F.md5(F.concat(F.lit(f"{seed}:"), slot.cast("string"))), 1, digits), 16, 10
    ).cast("long")
    return spark.range(n_rows * members).select(
        member.alias("member"), F.pmod(draw, F.lit(n_rows)).alias("rank")
    )


def bootstrap_multiplicities(
    df: DataFrame, members: int, id_col: str = "id", seed: int = 42
) -> DataFrame:
    """How often each row is drawn per member, as (id, multiplicities array).

    One row per input row, in member order, zero where a member skipped it: later steps
    weigh by array position, so features are computed once for all members.
    """
    ranked = hash_rank(df, id_col, seed)
    n_rows = df.count()
    draws = bootstrap_draws(n_rows, members, seed, df.sparkSession)
    wide = draws.groupBy("rank").agg(
        *[F.count_if(F.col("member") == m).alias(f"_m{m}") for m in range(members)]
    )
    counts = F.array(*[F.coalesce(F.col(f"_m{m}"), F.lit(0)).cast("int") for m in range(members)])
    return ranked.join(wide, "rank", "left").select(id_col, counts.alias("multiplicities"))
