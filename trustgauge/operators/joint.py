"""Many logistic regressions fitted side by side: one pass over the rows per step of all of them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustgauge.sources.shipping import ship_package
from trustgauge.sources.workspace import settle

# Pairs of moves that a quasi-Newton direction is made of; how flat a loss must be to be done; the
# share of the promised fall that a step must bring; how often a step is halved.
MEMORY, FLAT, ARMIJO, HALVINGS = 10, 1e-6, 1e-4, 30
# Weights of all members together, which go to every task.
MOST_WEIGHTS = 2_000_000
SUMS = "member int, idx int, value double"


class Descent:
    """L-BFGS for one loss that is evaluated elsewhere: ask for ``trial``, tell its loss and slope."""

    def __init__(self, size: int, max_iter: int):
        self.point = self.trial = np.zeros(size)
        self.loss, self.slope = np.inf, np.zeros(size)
        self.moves: list[tuple[np.ndarray, np.ndarray]] = []
        self.left, self.halved, self.done = max_iter, 0, False
        self.direction, self.length = np.zeros(size), 0.0

    def tell(self, loss: float, slope: np.ndarray) -> None:
        first = np.isinf(self.loss)
        promised = ARMIJO * self.length * float(self.slope @ self.direction)
        if first or loss <= self.loss + promised:
            if not first:
                move, turn = self.trial - self.point, slope - self.slope
                if float(move @ turn) > 1e-12:
                    self.moves = [*self.moves[1 - MEMORY :], (move, turn)]
                self.left -= 1
            self.point, self.loss, self.slope = self.trial, loss, slope
            if np.abs(slope).max(initial=0.0) <= FLAT or not self.left:
                self.done = True
                return
            self.direction, self.halved = -self._newton(slope), 0
            self.length = 1.0 if self.moves else min(1.0, 1.0 / np.abs(slope).sum())
        else:
            self.halved, self.length = self.halved + 1, self.length / 2
            self.done = self.halved > HALVINGS
        self.trial = self.point + self.length * self.direction

    def _newton(self, slope: np.ndarray) -> np.ndarray:
        """The slope times an estimate of the inverse curvature."""
        out, shares = slope.copy(), []
        for move, turn in reversed(self.moves):
            share = float(move @ out) / float(move @ turn)
            out -= share * turn
            shares.append(share)
        if self.moves:
            move, turn = self.moves[-1]
            out *= float(move @ turn) / float(turn @ turn)
        for (move, turn), share in zip(self.moves, reversed(shares), strict=True):
            out += (share - float(turn @ out) / float(move @ turn)) * move
        return out


def _row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.append(0.0, np.cumsum(values))[bounds])


def _evaluate(shared):
    """Weighted loss and slope of each member over a task's rows; index -1 holds the loss."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights: dict[int, np.ndarray] = shared.value
        losses, slopes = dict.fromkeys(weights, 0.0), {m: np.zeros(len(w)) for m, w in weights.items()}
        for batch in batches:
            cells = batch.column("features")
            flat, bounds = cells.flatten(), (cells.offsets.to_numpy() - cells.offsets[0].as_py()).astype(np.int64)
            idx, val = flat.field("idx").to_numpy(), flat.field("w").to_numpy()
            member = batch.column("member").to_numpy()
            target, times = batch.column("target").to_numpy(), batch.column("times").to_numpy()
            found = np.unique(member).tolist()
            owner = np.repeat(member, np.diff(bounds)) if len(found) > 1 else None
            for m in found:
                w, rows = weights[m], member == m
                own = np.append(0, np.cumsum(np.diff(bounds)[rows]))
                # A batch that one file gave has one member.
                cols, x = (idx, val) if len(found) == 1 else (idx[owner == m], val[owner == m])
                z = _row_sums(x * w[cols], own) + w[-1]
                y, c = target[rows], times[rows]
                losses[m] += float((c * (np.maximum(z, 0.0) - y * z + np.log1p(np.exp(-np.abs(z))))).sum())
                tail = np.exp(-np.abs(z))
                error = c * (np.where(z >= 0, 1.0, tail) / (1.0 + tail) - y)
                slopes[m] += np.bincount(cols, x * np.repeat(error, np.diff(own)), len(w))
                slopes[m][-1] += error.sum()
        for m, slope in slopes.items():
            some = np.flatnonzero(slope)
            if len(some) or losses[m]:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(some) + 1, m, dtype=np.int32)),
                        pa.array(np.append(-1, some).astype(np.int32)),
                        pa.array(np.append(losses[m], slope[some])),
                    ],
                    ["member", "idx", "value"],
                )

    return run


def fit_many(rows: DataFrame, sizes: Sequence[int], max_iter: int, reg_param: float) -> list[tuple[DataFrame, float]]:
    """Weights (idx, weight) and intercept of every member, from rows of (member, target, times, features).

    Each minimises the mean log loss, a row counting ``times``, plus ``reg_param / 2`` times the squared
    weights, the intercept left out. A step of all members is one pass over the rows of those
    not yet done: a task sums loss and slope of every member, Spark adds the sums by member
    and feature, and the driver takes each member's quasi-Newton step. The number of passes is that of the
    slowest member, whatever their number. Weights and slopes are as many numbers as
    the vocabularies have terms together, at most MOST_WEIGHTS. A member without rows has
    weights of 0.
    """
    if sum(sizes) > MOST_WEIGHTS:
        raise ValueError(f"{sum(sizes)} weights exceed {MOST_WEIGHTS}; limit the vocabularies")
    spark = rows.sparkSession
    ship_package(spark)
    rows = rows.select(
        "member", F.col("target").cast("double").alias("target"), F.col("times").cast("double").alias("times"),
        F.coalesce("features", F.array().cast("array<struct<idx:int,w:double>>")).alias("features"),
    )
    mass = {r["member"]: r["mass"] for r in rows.groupBy("member").agg(F.sum("times").alias("mass")).collect()}
    fits = {m: Descent(size + 1, max_iter) for m, size in enumerate(sizes)}
    for m in set(fits) - set(mass):
        fits[m].done = True
    while active := [m for m, fit in fits.items() if not fit.done]:
        shared = spark.sparkContext.broadcast({m: fits[m].trial for m in active})
        parts = rows.where(F.col("member").isin(active)).mapInArrow(_evaluate(shared), SUMS)
        sums = parts.groupBy("member", "idx").agg(F.sum("value").alias("value")).toArrow()
        shared.destroy()
        owner, places, values = (sums.column(n).to_numpy() for n in ("member", "idx", "value"))
        for m in active:
            idx, value = places[owner == m], values[owner == m] / mass[m]
            weights = fits[m].trial.copy()
            weights[-1] = 0.0
            slope = reg_param * weights
            slope[idx[idx >= 0]] += value[idx >= 0]
            fits[m].tell(float(value[idx < 0].sum()) + reg_param / 2 * float(weights @ weights), slope)
    cells = [(m, i, float(x)) for m, fit in fits.items() for i, x in enumerate(fit.point[:-1])]
    table = settle(spark.createDataFrame(cells, "member int, idx int, weight double"), partition_by=["member"])
    return [
        (table.where(F.col("member") == m).select("idx", "weight"), float(fit.point[-1])) for m, fit in fits.items()
    ]
