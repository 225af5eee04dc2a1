"""Evaluation of all model variants at once: each report is one grouped query."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trustgauge.functions.scalars import (
    base_model,
    clip_probability,
    confidence,
    log_loss,
    method,
    predicted_label,
)

# Default bin count and default abstention thresholds.
N_BINS = 10
THRESHOLDS = [0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95]


def _ratio(numerator: Column, denominator: Column) -> Column:
    """0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def classification_metrics(predictions: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1, log loss, Brier score and the four counts per model."""
    y = F.col("target")
    safe = clip_probability(F.col("prob"))
    label = predicted_label(safe)
    sums = predictions.groupBy("model").agg(
        F.avg((label == y).cast("double")).alias("accuracy"),
        F.avg(log_loss(y, F.col("prob"))).alias("log_loss"),
        F.avg((safe - y) * (safe - y)).alias("brier_score"),
        F.count_if((label == 0) & (y == 0)).alias("tn"),
        F.count_if((label == 1) & (y == 0)).alias("fp"),
        F.count_if((label == 0) & (y == 1)).alias("fn"),
        F.count_if((label == 1) & (y == 1)).alias("tp"),
    )
    rates = sums.withColumn("precision", _ratio(F.col("tp"), F.col("tp") + F.col("fp"))).withColumn(
        "recall", _ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    )
    f1 = _ratio(
        F.lit(2.0) * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")
    )
    return rates.select(
        "model", "accuracy", "precision", "recall", f1.alias("f1"), "log_loss", "brier_score",
        "tn", "fp", "fn", "tp",
    )


def _edges(n_bins: int) -> list[float]:
    """Bin edges i * (1 / n) in doubles: edge 6 of 10 is 0.6000000000000001, not 0.6."""
    width = 1.0 / n_bins
    return [i * width for i in range(n_bins)] + [1.0]


def _bin_number(conf: Column, n_bins: int) -> Column:
    """One-based bin [left, right); the last one is closed."""
    passed = F.lit(1)
    for edge in _edges(n_bins)[1:-1]:
        passed = passed + (conf >= F.lit(edge)).cast("int")
    return passed


def _bin_sums(predictions: DataFrame, n_bins: int) -> DataFrame:
    conf = confidence(F.col("prob"))
    correct = (predicted_label(F.col("prob")) == F.col("target")).cast("double")
    return predictions.groupBy("model", _bin_number(conf, n_bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("count"),
        F.avg(conf).alias("mean_confidence"),
        F.avg(correct).alias("accuracy"),
    )


def reliability_bins(predictions: DataFrame, n_bins: int = N_BINS) -> DataFrame:
    """Count, mean confidence and accuracy per model and equal-width confidence bin.

    Empty bins are kept, with the midpoint as confidence and no accuracy. They come from a
    list of bins per model, so the predictions are read once.
    """
    edges = _edges(n_bins)
    filled = _bin_sums(predictions, n_bins).groupBy("model").agg(
        F.collect_list(F.struct("bin", "count", "mean_confidence", "accuracy")).alias("_bins")
    )
    spine = F.array(
        *[
            F.struct(
                F.lit(i + 1).alias("bin"), F.lit(edges[i]).alias("left"),
                F.lit(edges[i + 1]).alias("right"),
            )
            for i in range(n_bins)
        ]
    )
    listed = filled.select("model", "_bins", F.inline(spine))
    mine = listed.select(
        "model", "bin", "left", "right",
        F.get(F.filter("_bins", lambda b: b.bin == F.col("bin")), F.lit(0)).alias("_b"),
    )
    return mine.select(
        "model", "bin", "left", "right",
        F.coalesce("_b.count", F.lit(0)).cast("long").alias("count"),
        F.coalesce("_b.mean_confidence", (F.col("left") + F.col("right")) / 2.0).alias(
            "mean_confidence"
        ),
        F.col("_b.accuracy").alias("accuracy"),
    )


def expected_calibration_error(predictions: DataFrame, n_bins: int = N_BINS) -> DataFrame:
    """Count-weighted gap between accuracy and confidence: (model, ece)."""
    gap = F.abs(F.col("accuracy") - F.col("mean_confidence")) * F.col("count")
    return _bin_sums(predictions, n_bins).groupBy("model").agg(
        _ratio(F.sum(gap), F.sum("count")).alias("ece")
    )


def rejection_curve(
    predictions: DataFrame, thresholds: Sequence[float] = THRESHOLDS
) -> DataFrame:
    """Coverage and accuracy of the answered rows per model and threshold.

    A row is counted once, under the number of thresholds its confidence passes; answers at a
    threshold are the sum of the groups that pass it. No row is repeated per threshold.
    """
    taus = sorted(float(t) for t in thresholds)
    conf = confidence(F.col("prob"))
    passed = F.lit(0)
    for tau in taus:
        passed = passed + (conf > F.lit(tau)).cast("int")
    correct = predicted_label(F.col("prob")) == F.col("target")
    groups = (
        predictions.groupBy("model", passed.alias("passed"))
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(correct).alias("right"))
        .groupBy("model")
        .agg(
            F.collect_list(F.struct("passed", "n", "right")).alias("_groups"),
            F.sum("n").alias("total"),
        )
    )
    grid = F.array(*[F.lit(t) for t in taus])
    wide = groups.select("model", "total", "_groups", F.posexplode(grid).alias("_k", "threshold"))

    def over(field: str) -> Column:
        return F.aggregate(
            "_groups",
            F.lit(0).cast("long"),
            lambda total, g: total + F.when(g.passed > F.col("_k"), g[field]).otherwise(0),
        )

    sums = wide.select(
        "model", "threshold", "total", over("n").alias("answered"), over("right").alias("_right")
    )
    return sums.select(
        "model",
        "threshold",
        _ratio(F.col("answered"), F.col("total")).alias("coverage"),
        (F.col("total") - F.col("answered")).alias("rejected"),
        "answered",
        F.try_divide(F.col("_right").cast("double"), F.col("answered").cast("double")).alias(
            "selective_accuracy"
        ),
    )


def leaderboard(predictions: DataFrame, n_bins: int = N_BINS) -> DataFrame:
    """Metrics and calibration error of every variant, best calibrated first."""
    metrics = classification_metrics(predictions).join(
        expected_calibration_error(predictions, n_bins), "model"
    )
    return metrics.select(
        base_model(F.col("model")).alias("base_model"),
        method(F.col("model")).alias("method"),
        "accuracy", "precision", "recall", "f1", "log_loss", "brier_score",
        "tn", "fp", "fn", "tp", "ece", "model",
    ).orderBy("ece", "log_loss", "model")


def best_variant(board: DataFrame) -> DataFrame:
    return board.orderBy("ece", "log_loss", "model").limit(1)


def family_order(board: DataFrame) -> DataFrame:
    """Base models by their best variant: (base_model, place), first place first."""
    best = board.groupBy("base_model").agg(
        F.min(F.struct("ece", "log_loss", "model")).alias("_best")
    )
    # One row per model family.
    place = F.row_number().over(Window.orderBy("_best"))
    return best.select("base_model", place.alias("place")).orderBy("place")


def split_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
