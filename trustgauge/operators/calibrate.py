"""Calibrators fitted on the calibration split and applied to any scored rows.

A predictions table has (model, base_model, method, split, id, target, score, prob). Every fit
serves all models at once and returns a small settled table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from trustgauge.functions.scalars import clip_probability, log_loss, sigmoid
from trustgauge.sources.shipping import ship_package
from trustgauge.sources.workspace import settle

# The temperature grid 10^(-1.2) ... 10^(1.2) in 121 even steps of the exponent.
TEMPERATURES = [float(10.0**e) for e in np.linspace(-1.2, 1.2, 121)]

# Cells of scores per unit of their inverse hyperbolic sine; the largest scaled score up to which no
# probability is clipped and the loss is exact to ten digits; what rounding may add to a bound.
SCORE_CELLS, UNCLIPPED, BOUND_SLACK = 200.0, 14.0, 1e-9

# The penalty on Platt's slope, the number of rows below which a single short step
# replaces the fit, and the length of that step.
PLATT_L2 = 1e-4
PLATT_MIN_ROWS = 10
PLATT_SHORT_STEP = 0.03

# Newton stops when no parameter would move further than this, at the latest after so many sums.
PLATT_TOLERANCE = 1e-11
PLATT_ROUNDS = 100

# Method names of the calibrated variants.
RAW, TEMPERATURE, ISOTONIC, PLATT = (
    "raw",
    "temperature_scaling",
    "isotonic_regression",
    "platt_scaling_extra",
)

PLATT_COLUMNS = "model string, slope double, intercept double"

# Entries of a node of the tree that block ends are looked up in: 2 to the power of this.
NODE_BITS = 7

BLOCK_COLUMNS = "model string, hi double, weight double, positives double"


# --- temperature -----------------------------------------------------------------------------


def temperature_losses(predictions: DataFrame) -> DataFrame:
    """Mean log loss per model and grid temperature: (model, step, temperature, loss).

    Rows are widened to the grid inside the task and averaged there; only one partial row per
    model and step leaves it.
    """
    grid = F.array(*[F.lit(t) for t in TEMPERATURES])
    wide = predictions.select(
        "model", "target", "score", F.posexplode(grid).alias("step", "temperature")
    )
    loss = log_loss(F.col("target"), sigmoid(F.col("score") / F.col("temperature")))
    return wide.groupBy("model", "step", "temperature").agg(F.avg(loss).alias("loss"))


def temperature_bounds(predictions: DataFrame) -> DataFrame:
    """Bounds of the mean loss per model and step from sums by cell: (model, step, low, high).

    Scores of one target are summed in cells that widen with the score's size; the grid meets the
    cells only. Within a cell the loss moves one way with the score, so its ends bound it. Where no
    probability is clipped it is convex as well: at least the loss of the mean score, and at
    most the chord between the ends.
    """
    cell = F.floor(F.asinh("score") * SCORE_CELLS)
    cells = predictions.where(F.col("score").isNotNull() & F.col("target").isNotNull()).groupBy(
        "model", "target", cell.alias("cell")
    ).agg(
        F.count(F.lit(1)).alias("n"), F.avg("score").alias("mean"), F.min("score").alias("a"), F.max("score").alias("z")
    )
    grid = F.array(*[F.lit(t) for t in TEMPERATURES])
    wide = cells.select("*", F.posexplode(grid).alias("step", "temperature"))
    y, t = F.col("target"), F.col("temperature")
    at = {c: log_loss(y, sigmoid(F.col(c) / t)) for c in ("a", "z", "mean")}
    # NaN and infinity fall outside.
    smooth = (F.abs("a") < UNCLIPPED * t) & (F.abs("z") < UNCLIPPED * t)
    met = wide.select(
        "model", "step", "n", smooth.alias("smooth"), at["a"].alias("la"), at["z"].alias("lz"), at["mean"].alias("lm"),
        F.coalesce(F.try_divide(F.col("mean") - F.col("a"), F.col("z") - F.col("a")), F.lit(0.0)).alias("part"),
    )
    chord = F.col("la") + (F.col("lz") - F.col("la")) * F.least(F.greatest("part", F.lit(0.0)), F.lit(1.0))
    low = F.when(F.col("smooth"), F.col("lm")).otherwise(F.least("la", "lz"))
    high = F.when(F.col("smooth"), chord).otherwise(F.greatest("la", "lz"))
    return met.groupBy("model", "step").agg(
        (F.sum(F.col("n") * low) / F.sum("n") - BOUND_SLACK).alias("low"),
        (F.sum(F.col("n") * high) / F.sum("n") + BOUND_SLACK).alias("high"),
    )


def fit_temperature(predictions: DataFrame) -> DataFrame:
    """Grid temperature with the least loss, the smaller one on a tie: (model, temperature).

    Steps whose least possible loss is above some other's greatest are out; the rows are widened
    to the few that the bounds leave open, not to the whole grid.
    """
    bounds = settle(temperature_bounds(predictions))
    best = bounds.groupBy("model").agg(F.min("high").alias("_high"))
    left = bounds.join(best, "model").where(F.col("low") <= F.col("_high"))
    # One row per model, up to the grid's length of steps.
    steps = settle(left.groupBy("model").agg(F.sort_array(F.collect_list("step")).alias("_steps")))
    grid = F.array(*[F.lit(t) for t in TEMPERATURES])
    wide = predictions.join(steps, "model").select(
        "model", "target", "score", F.explode("_steps").alias("step")
    ).withColumn("temperature", F.get(grid, F.col("step")))
    loss = log_loss(F.col("target"), sigmoid(F.col("score") / F.col("temperature")))
    losses = wide.groupBy("model", "step", "temperature").agg(F.avg(loss).alias("loss"))
    found = F.min_by("temperature", F.struct("loss", "step"))
    fitted = losses.groupBy("model").agg(found.alias("temperature"))
    # A model whose scores or targets are all null has no bounds, and no loss either.
    everyone = predictions.select("model").distinct()
    least = F.coalesce("temperature", F.lit(TEMPERATURES[0]))
    return settle(everyone.join(fitted, "model", "left").select("model", least.alias("temperature")))


def temperature_probability(score: Column, temperature: Column) -> Column:
    return clip_probability(sigmoid(score / temperature))


def apply_temperature(predictions: DataFrame, temperatures: DataFrame) -> DataFrame:
    """Scaled probabilities; null for a model without a temperature."""
    return (
        predictions.join(temperatures, "model", "left")
        .withColumn("prob", temperature_probability(F.col("score"), F.col("temperature")))
        .drop("temperature")
    )


# --- Platt -----------------------------------------------------------------------------------


def _platt_sums(rows: DataFrame, at: DataFrame) -> DataFrame:
    """Loss, gradient and curvature per model at its (slope, intercept), in one aggregate."""
    x = F.col("slope") * F.col("score") + F.col("intercept")
    p = sigmoid(x)
    error, bend = p - F.col("target"), p * (1.0 - p)
    z = F.col("score")
    loss = F.greatest(x, F.lit(0.0)) + F.log1p(F.exp(-F.abs(x))) - F.col("target") * x
    return rows.join(at, "model").groupBy("model").agg(
        F.avg(loss).alias("_loss"),
        F.avg(error * z).alias("_g1"),
        F.avg(error).alias("_g0"),
        F.avg(bend * z * z).alias("_h11"),
        F.avg(bend * z).alias("_h10"),
        F.avg(bend).alias("_h00"),
        F.count(F.lit(1)).alias("_n"),
    )


@dataclass
class _PlattState:
    """Best point so far of one model, the move last tried from it, and the point to try next."""

    slope: float = 1.0
    intercept: float = 0.0
    best: tuple[float, float] | None = None
    best_loss: float = math.inf
    move: tuple[float, float] = (0.0, 0.0)
    done: bool = False

    def step(self, sums: Row) -> None:
        """Take a try that lowers the penalised loss as best, else go half the way to it."""
        here = (self.slope, self.intercept)
        loss = sums["_loss"] + PLATT_L2 / 2 * self.slope * self.slope
        if self.best is None or loss <= self.best_loss:
            self.best, self.best_loss = here, loss
            g1, g0 = sums["_g1"] + PLATT_L2 * self.slope, sums["_g0"]
            if sums["_n"] < PLATT_MIN_ROWS:
                self.move, self.done = (-PLATT_SHORT_STEP * g1, -PLATT_SHORT_STEP * g0), True
            else:
                h11, h10, h00 = sums["_h11"] + PLATT_L2, sums["_h10"], sums["_h00"] + 1e-12
                det = h11 * h00 - h10 * h10
                self.move = (h10 * g0 - h00 * g1) / det, (h10 * g1 - h11 * g0) / det
        else:
            self.move = self.move[0] / 2, self.move[1] / 2
        self.slope, self.intercept = self.best[0] + self.move[0], self.best[1] + self.move[1]
        self.done = self.done or max(map(abs, self.move)) <= PLATT_TOLERANCE


def fit_platt(predictions: DataFrame) -> DataFrame:
    """Slope and intercept per model: (model, slope, intercept).

    The minimum of the mean log loss plus ``PLATT_L2 / 2`` times the squared slope, found by
    Newton's method for all models at once: each round is one grouped sum over the rows, of
    which one row per model comes to the driver. This is the point that a gradient descent
    on the same loss approaches, and stops short of when it is ended early. A model with fewer
    than ``PLATT_MIN_ROWS`` rows is not fitted: it takes one gradient step of length
    ``PLATT_SHORT_STEP`` from slope 1 and intercept 0. Rows without score or target are left out.
    """
    spark = predictions.sparkSession
    rows = settle(
        predictions.select("model", "score", F.col("target").cast("double").alias("target")).where(
            F.col("score").isNotNull() & F.col("target").isNotNull()
        )
    )
    states: dict[str, _PlattState] = {
        r["model"]: _PlattState() for r in rows.select("model").distinct().collect() if r["model"] is not None
    }
    for _ in range(PLATT_ROUNDS):
        at = [(m, s.slope, s.intercept) for m, s in states.items() if not s.done]
        if not at:
            break
        for sums in _platt_sums(rows, spark.createDataFrame(at, PLATT_COLUMNS)).collect():
            states[sums["model"]].step(sums)
    fitted = [(m, s.slope, s.intercept) for m, s in states.items()]
    return settle(spark.createDataFrame(fitted, PLATT_COLUMNS).coalesce(1))


def platt_probability(score: Column, slope: Column, intercept: Column) -> Column:
    return clip_probability(sigmoid(slope * score + intercept))


def apply_platt(predictions: DataFrame, platt: DataFrame) -> DataFrame:
    """Platt probabilities; null for a model without parameters."""
    return (
        predictions.join(platt, "model", "left")
        .withColumn(
            "prob", platt_probability(F.col("score"), F.col("slope"), F.col("intercept"))
        )
        .drop("slope", "intercept")
    )


# --- isotonic --------------------------------------------------------------------------------


def pool_violators(hi: np.ndarray, weight: np.ndarray, positives: np.ndarray):
    """Pool adjacent violators over points sorted by ``hi``.

    Runs that do not rise are pooled a whole array at a time first; what is left goes through
    the usual stack. Neighbours with equal means become one block, which leaves the step
    function as it is and makes block means rise strictly: 0/1 targets over n rows then give
    less than n^(2/3) blocks. The blocks do not depend on the order of pooling, so pooling
    slices first and their blocks afterwards gives the same.
    """
    for _ in range(16):
        mean = positives / weight
        starts = np.flatnonzero(np.r_[True, mean[:-1] < mean[1:]])
        if len(starts) == len(hi):
            return hi, weight, positives
        ends = np.r_[starts[1:], len(hi)] - 1
        hi = hi[ends]
        weight = np.add.reduceat(weight, starts)
        positives = np.add.reduceat(positives, starts)
    blocks: list[list[float]] = []
    for h, w, s in zip(hi.tolist(), weight.tolist(), positives.tolist()):
        while blocks and blocks[-1][2] / blocks[-1][1] >= s / w:
            _, w0, s0 = blocks.pop()
            w, s = w + w0, s + s0
        blocks.append([h, w, s])
    pooled = np.asarray(blocks, dtype=float).reshape(-1, 3)
    return pooled[:, 0], pooled[:, 1], pooled[:, 2]


def _pool_frame(points: pd.DataFrame) -> pd.DataFrame:
    hi, weight, positives = pool_violators(
        points["hi"].to_numpy(), points["weight"].to_numpy(), points["positives"].to_numpy()
    )
    return pd.DataFrame(
        {"model": points["model"].iloc[0], "hi": hi, "weight": weight, "positives": positives}
    )


def _pool_slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pool a sorted partition; between batches only the blocks so far are kept."""
    held: pd.DataFrame | None = None
    for batch in batches:
        for model, points in batch.groupby("model", sort=False):
            if held is not None and held["model"].iloc[0] == model:
                points = pd.concat([held, points], ignore_index=True)
            elif held is not None:
                yield held
            held = _pool_frame(points)
    if held is not None:
        yield held


def isotonic_blocks(predictions: DataFrame) -> DataFrame:
    """Isotonic fit of target on probability: (model, lo, hi, value), one row per block.

    A row holds lo < prob <= hi; null marks the open end. Equal probabilities are pooled by a
    plain aggregation, then every slice of the sorted points pools its own violators, and only
    the remaining blocks of a model meet in one task.
    """
    ship_package(predictions.sparkSession)
    points = predictions.groupBy("model", F.col("prob").alias("hi")).agg(
        F.count(F.lit(1)).cast("double").alias("weight"),
        F.sum("target").cast("double").alias("positives"),
    )
    slices = (
        points.repartitionByRange("model", "hi")
        .sortWithinPartitions("model", "hi")
        .mapInPandas(_pool_slices, BLOCK_COLUMNS)
    )
    pooled = slices.groupBy("model").applyInPandas(
        lambda blocks: _pool_frame(blocks.sort_values("hi")), BLOCK_COLUMNS
    )
    ordered = Window.partitionBy("model").orderBy("hi")
    return settle(
        pooled.select(
            "model",
            F.lag("hi").over(ordered).alias("lo"),
            "hi",
            F.lead("hi").over(ordered).isNull().alias("last"),
            (F.col("positives") / F.col("weight")).alias("value"),
        )
    )


def isotonic_tree(blocks: DataFrame) -> list[DataFrame]:
    """The blocks as a search tree, its root level first: tables (model, node, ends, values).

    A leaf holds up to 2^NODE_BITS neighbouring blocks of a model by their upper ends, the last one
    open; a node above holds the last ends of as many nodes. There are as many levels as the
    model with most blocks needs, two for 16 thousand.
    """
    order = Window.partitionBy("model").orderBy("_end")
    end = F.when(F.col("last"), F.lit(float("inf"))).otherwise(F.col("hi"))
    entries = blocks.select("model", end.alias("_end"), "value").withColumn(
        "_rank", F.row_number().over(order) - 1
    )
    levels, entries = [], settle(entries)
    most = entries.agg(F.max("_rank")).first()[0] or 0
    while True:
        listed = F.sort_array(F.collect_list(F.struct("_end", "value")))
        level = settle(
            entries.groupBy("model", F.shiftright("_rank", NODE_BITS).alias("node"))
            .agg(listed.alias("_l"))
            .select("model", "node", F.col("_l._end").alias("ends"), F.col("_l.value").alias("values"))
        )
        levels.append(level)
        most >>= NODE_BITS
        if not most:
            return levels[::-1]
        entries = level.select(
            "model", F.col("node").alias("_rank"), F.element_at("ends", -1).alias("_end"),
            F.lit(None).cast("double").alias("value"),
        )


def tree_lookup(predictions: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """Add ``isotonic_prob`` from a tree of blocks; a projection and joins only, so it may stream.

    Each level is met in an equality join on (model, node) and halved to the first end at or
    after the probability; a level that is small is broadcast by Spark, and none multiplies
    rows. The steps are separate projections, which Spark compiles into one loop.
    """
    names = predictions.columns
    found = predictions.withColumn("_node", F.lit(0))
    for depth, level in enumerate(levels):
        node = level.select(
            F.col("model").alias("_model"), F.col("node").alias("_at"), F.col("ends").alias("_ends"),
            F.col("values").alias("_values"),
        )
        met = (F.col("model") == F.col("_model")) & (F.col("_node") == F.col("_at"))
        found = found.join(node, met, "left").withColumn("_pos", F.lit(0))
        for bit in range(NODE_BITS, -1, -1):
            probe = F.get("_ends", F.col("_pos") + ((1 << bit) - 1))
            found = found.withColumn(
                "_pos", F.col("_pos") + F.when(probe < F.col("prob"), 1 << bit).otherwise(0)
            )
        if depth < len(levels) - 1:
            found = found.select(*names, (F.shiftleft("_node", NODE_BITS) + F.col("_pos")).alias("_node"))
    value = F.when(F.col("prob").isNotNull(), F.get("_values", F.col("_pos")))
    return found.select(*names, clip_probability(value).alias("isotonic_prob"))


def isotonic_lookup(predictions: DataFrame, blocks: DataFrame) -> DataFrame:
    """Add ``isotonic_prob``: the value of the first block that ends at or above prob.

    Above the last block its value holds; it is null for a model without blocks and for a null
    probability. Only the blocks are written, as a search tree; predictions are neither
    shuffled for it nor written, and may be a stream.
    """
    return tree_lookup(predictions, isotonic_tree(blocks))


def apply_isotonic(predictions: DataFrame, blocks: DataFrame) -> DataFrame:
    return isotonic_lookup(predictions, blocks).withColumn(
        "prob", F.col("isotonic_prob")
    ).drop("isotonic_prob")


# --- whole families --------------------------------------------------------------------------


def calibrated_family(
    predictions: DataFrame,
    temperatures: DataFrame,
    blocks: DataFrame,
    platt: DataFrame | None = None,
) -> DataFrame:
    """All variants of each raw model in long form, from one pass over the raw predictions.

    Temperature and Platt read the score, isotonic reads the probability. The raw variant
    keeps its own method name; the others are named ``base_model/method``. No row is lost: a
    model without a fit keeps its raw variant, and its calibrated probabilities are null.
    """
    joined = isotonic_lookup(predictions.join(temperatures, "model", "left"), blocks)
    variants = [
        F.struct(F.col("method").alias("method"), F.col("prob").alias("prob")),
        F.struct(
            F.lit(TEMPERATURE).alias("method"),
            temperature_probability(F.col("score"), F.col("temperature")).alias("prob"),
        ),
        F.struct(F.lit(ISOTONIC).alias("method"), F.col("isotonic_prob").alias("prob")),
    ]
    if platt is not None:
        joined = joined.join(platt, "model", "left")
        variants.append(
            F.struct(
                F.lit(PLATT).alias("method"),
                platt_probability(F.col("score"), F.col("slope"), F.col("intercept")).alias("prob"),
            )
        )
    return joined.withColumn("_v", F.explode(F.array(*variants))).select(
        F.concat_ws("/", "base_model", "_v.method").alias("model"),
        "base_model",
        F.col("_v.method").alias("method"),
        "split",
        "id",
        "target",
        "score",
        F.col("_v.prob").alias("prob"),
    )


def calibration_notes(temperatures: DataFrame, platt: DataFrame | None = None) -> DataFrame:
    """Fitted parameters in long form: (model, parameter, value)."""
    notes = temperatures.select(
        "model", F.lit("temperature").alias("parameter"), F.col("temperature").alias("value")
    )
    if platt is None:
        return notes
    return notes.unionByName(
        platt.unpivot("model", ["slope", "intercept"], "parameter", "value")
    )
