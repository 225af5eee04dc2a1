"""Linear SVM by distributed dual coordinate ascent, with the duality gap as its certificate.

The fit minimises P(w) = reg / 2 * |w|^2 + mean of max(0, 1 - y * w x) over rows with y = -1 or 1.
A last feature of value 1 stands for the intercept. Every row has a dual value a in [0, 1];
w(a) = sum of a * y * x / (reg * n), and D(a) = mean of a - reg / 2 * |w(a)|^2 is never above P(w).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustgauge.functions.scalars import signed_label
from trustgauge.operators.linear import DENSE_WEIGHTS, LinearModel
from trustgauge.sources.shipping import ship_package
from trustgauge.sources.workspace import settle

REG = 1e-3
# The fit ends when the gap, which is 1 before the first round, is no larger, or after so many rounds.
GAP, ROUNDS = 1e-3, 60
# Times each task goes over its rows before tasks exchange what they learnt.
PASSES = 4
# Rows a task has at least once a fit over more tasks, each of which allows for all others, has not closed the gap.
TASK_ROWS = 1000

STATE = "id {id}, target double, features array<struct<idx:int,w:double>>, a double, loss double"


@dataclass(frozen=True)
class SvmFit:
    """A fitted model, the dual values it was made of, and how far it is from the optimum at most."""

    model: LinearModel
    duals: DataFrame
    primal: float
    dual: float
    rounds: int

    @property
    def gap(self) -> float:
        return self.primal - self.dual


def _sparse(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indices, values and row boundaries of the features of a batch."""
    cells = batch.column("features")
    flat = cells.flatten()
    bounds = cells.offsets.to_numpy() - cells.offsets[0].as_py()
    return flat.field("idx").to_numpy(), flat.field("w").to_numpy(), bounds.astype(np.int64)


def _row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.append(0.0, np.cumsum(values))[bounds])


def ascend(
    idx: np.ndarray, val: np.ndarray, bounds: np.ndarray, y: np.ndarray, a: np.ndarray,
    v: np.ndarray, scale: float, together: float, order: np.ndarray,
) -> None:
    """Maximise the dual in one row after the other; ``a`` and the task's weights ``v`` move.

    ``scale`` is reg * n. As ``together`` tasks add up what they find without seeing each other,
    each takes its own changes for that many times as large, which keeps their sum an ascent.
    """
    lengths = 1.0 + _row_sums(val * val, bounds)
    for i in order.tolist():
        cols, x = idx[bounds[i] : bounds[i + 1]], val[bounds[i] : bounds[i + 1]]
        margin = y[i] * (x @ v[cols] + v[-1])
        best = a[i] + (1.0 - margin) * scale / (together * lengths[i])
        move = min(1.0, max(0.0, best)) - a[i]
        if move:
            a[i] += move
            step = together * move * y[i] / scale
            v[cols] += step * x
            v[-1] += step


def _round(shared, scale: float, together: int, number: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        v = w.copy()
        for batch in batches:
            idx, val, bounds = _sparse(batch)
            y = np.where(batch.column("target").to_numpy() == 1, 1.0, -1.0)
            a = batch.column("a").to_numpy().copy()
            loss = np.maximum(0.0, 1.0 - y * (_row_sums(val * w[idx], bounds) + w[-1]))
            rng = np.random.default_rng(number)
            for _ in range(PASSES):
                ascend(idx, val, bounds, y, a, v, scale, together, rng.permutation(len(y)))
            columns = {"a": pa.array(a), "loss": pa.array(loss)}
            yield pa.RecordBatch.from_arrays(
                [columns.get(n, batch.column(i)) for i, n in enumerate(batch.schema.names)], batch.schema.names
            )

    return run


def _weights(state: DataFrame, scale: float, size: int) -> np.ndarray:
    """w(a): one sum per feature, as many numbers as the vocabulary has terms."""
    pull = F.col("a") * signed_label(F.col("target")) / scale
    rows = state.where("a > 0").select(pull.alias("pull"), "features")
    sums = rows.select("pull", F.inline("features")).groupBy("idx").agg(F.sum(F.col("pull") * F.col("w")).alias("s"))
    w = np.zeros(size + 1)
    found = sums.toArrow()
    w[found.column("idx").to_numpy()] = found.column("s").to_numpy()
    w[-1] = rows.agg(F.coalesce(F.sum("pull"), F.lit(0.0))).first()[0]
    return w


def fit(
    rows: DataFrame, size: int, reg: float = REG, gap: float = GAP, rounds: int = ROUNDS, id_col: str = "id",
    finish: bool = False,
) -> SvmFit:
    """Fit on rows of (id, target, features), features being (idx, w) below ``size``.

    In a round every task improves the dual values of its own rows against the common weights and
    its own changes, in one pass over the table that is written as the next round's; the new weights
    are one sum per feature. The pass measures the loss of the weights it started from, so the gap
    is exact. With ``finish`` few rows whose gap stays open in many tasks get as many rounds more in few of them.
    Rows are read and written once a round; what is sent about are the weights, at
    most DENSE_WEIGHTS numbers. A null target is left out, null features are none; without
    rows all weights are 0.
    """
    if size > DENSE_WEIGHTS:
        raise ValueError(f"weights of {size} features exceed {DENSE_WEIGHTS}; limit the vocabulary")
    spark = rows.sparkSession
    ship_package(spark)
    empty = F.lit(0.0)
    state = settle(
        rows.where(F.col("target").isNotNull()).select(
            F.col(id_col).alias("id"), F.col("target").cast("double").alias("target"),
            F.coalesce("features", F.array().cast("array<struct<idx:int,w:double>>")).alias("features"),
            empty.alias("a"), empty.alias("loss"),
        )
    )
    schema = STATE.format(id=state.schema["id"].dataType.simpleString())
    n = state.count()
    scale = reg * max(n, 1)
    w, mean_a, number = np.zeros(size + 1), 0.0, 0
    while True:
        shared = spark.sparkContext.broadcast(w)
        together = max(1, state.rdd.getNumPartitions())
        after = settle(state.mapInArrow(_round(shared, scale, together, number), schema))
        sums = after.agg(F.coalesce(F.avg("loss"), empty).alias("loss"), F.coalesce(F.avg("a"), empty).alias("a")).first()
        half = reg / 2 * float(w @ w)
        primal, dual = half + sums["loss"], mean_a - half
        if finish and primal - dual > gap and number == rounds > 0 and 0 < n < TASK_ROWS * (together - 1):
            state, rounds = settle(state.coalesce(-(-n // TASK_ROWS))), 2 * rounds
            continue
        if primal - dual <= gap or number == rounds:
            break
        state, mean_a, number = after, sums["a"], number + 1
        w = _weights(state, scale, size)
        shared.destroy()
    weights = settle(
        spark.createDataFrame([(i, float(x)) for i, x in enumerate(w[:-1])], "idx int, weight double")
    )
    return SvmFit(LinearModel(weights, float(w[-1]), size), state.select("id", "a"), primal, dual, number)


def objective(rows: DataFrame, reg: float = REG) -> DataFrame:
    """Primal and dual at given dual values: one row (n, primal, dual, gap).

    ``rows`` holds (id, target, features, a). Weights and margins are joins and sums, so any number of
    features will do.
    """
    rows = settle(
        rows.select("id", "features", "a", signed_label(F.col("target")).alias("y")).withColumn(
            "n", F.lit(rows.count()).cast("double")
        )
    )
    pull = F.col("a") * F.col("y") / (reg * F.col("n"))
    cells = rows.select("id", pull.alias("pull"), F.inline("features"))
    weights = settle(cells.groupBy("idx").agg(F.sum(F.col("pull") * F.col("w")).alias("weight")))
    level = rows.agg(F.coalesce(F.sum(pull), F.lit(0.0)).alias("level"))
    sums = cells.join(weights, "idx").groupBy("id").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    scored = rows.select("id", "y", "a").join(sums, "id", "left")
    # One row.
    scored = scored.join(F.broadcast(level))
    loss = F.greatest(F.lit(0.0), 1.0 - F.col("y") * (F.coalesce("dot", F.lit(0.0)) + F.col("level")))
    totals = scored.agg(
        F.count(F.lit(1)).alias("n"), F.avg(loss).alias("loss"), F.avg("a").alias("a"), F.max("level").alias("level")
    )
    square = weights.agg(F.coalesce(F.sum(F.col("weight") * F.col("weight")), F.lit(0.0)).alias("square"))
    half = reg / 2 * (F.col("square") + F.col("level") * F.col("level"))
    return totals.join(F.broadcast(square)).select(
        "n", (half + F.col("loss")).alias("primal"), (F.col("a") - half).alias("dual")
    ).withColumn("gap", F.col("primal") - F.col("dual"))
