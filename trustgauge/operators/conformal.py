"""Split conformal prediction for binary classifiers, for all models and levels at once."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustgauge.functions.scalars import nonconformity, predicted_label
from trustgauge.operators.ranking import DIRECT_ROWS, order_statistics
from trustgauge.sources.workspace import settle

# Default error levels and the methods that take part besides raw scores.
ALPHAS = [0.05, 0.10, 0.15, 0.20, 0.25]
CANDIDATE_METHODS = ["raw", "raw_margin_sigmoid", "label_smoothing_0.10", "bootstrap_ensemble"]


def _checked(alphas: Sequence[float]) -> list[float]:
    levels = [float(a) for a in alphas]
    if not levels or any(math.isnan(a) or not 0.0 < a < 1.0 for a in levels):
        raise ValueError("alpha must be between 0 and 1")
    return levels


def quantile_rank(n: Column, alpha: float) -> Column:
    """ceil((n + 1)(1 - alpha)), held within 1..n."""
    rank = F.ceil((n + 1).cast("double") * F.lit(1.0 - alpha))
    return F.least(F.greatest(rank, F.lit(1).cast("long")), n)


def conformal_quantiles(
    calibration: DataFrame,
    alphas: Sequence[float] = ALPHAS,
    direct_rows: int = DIRECT_ROWS,
) -> DataFrame:
    """Exact score quantile per model and level: (model, alpha, n, qhat)."""
    scores = calibration.select(
        "model", nonconformity(F.col("target"), F.col("prob")).alias("score")
    )
    ranks = {a: (lambda n, a=a: quantile_rank(n, a)) for a in _checked(alphas)}
    return settle(
        order_statistics(scores, "model", "score", ranks, "alpha", "qhat", direct_rows)
    )


def prediction_sets(test: DataFrame, quantiles: DataFrame) -> DataFrame:
    """Sets per row and level: which classes are in, their number, and what that means.

    A model without quantiles has no sets; that is an error, not a model less.
    """
    known = quantiles.select("model").distinct()
    unknown = [r["model"] for r in test.select("model").distinct().join(known, "model", "left_anti").collect()]
    if unknown:
        raise ValueError(f"no calibration rows for {sorted(unknown)}")
    p = F.col("prob")
    sets = (
        test.join(quantiles.select("model", "alpha", "qhat"), "model")
        .withColumn("include_0", F.lit(1.0) - (F.lit(1.0) - p) <= F.col("qhat"))
        .withColumn("include_1", F.lit(1.0) - p <= F.col("qhat"))
    )
    size = F.col("include_0").cast("int") + F.col("include_1").cast("int")
    return sets.withColumn("set_size", size).withColumns(
        {
            "contains_true": F.when(F.col("target") == 1, F.col("include_1")).otherwise(
                F.col("include_0")
            ),
            "is_singleton": F.col("set_size") == 1,
            "is_empty": F.col("set_size") == 0,
            "is_ambiguous": F.col("set_size") == 2,
        }
    )


def evaluate_conformal(
    calibration: DataFrame,
    test: DataFrame,
    alphas: Sequence[float] = ALPHAS,
    direct_rows: int = DIRECT_ROWS,
) -> DataFrame:
    """Coverage, set size and singleton quality per model and level."""
    sets = prediction_sets(test, conformal_quantiles(calibration, alphas, direct_rows))
    hit = F.col("is_singleton") & (predicted_label(F.col("prob")) == F.col("target"))

    def rate(flag: str) -> Column:
        return F.avg(F.col(flag).cast("double"))

    return sets.groupBy("model", "alpha", "qhat").agg(
        rate("contains_true").alias("empirical_coverage"),
        F.avg(F.col("set_size").cast("double")).alias("avg_set_size"),
        rate("is_singleton").alias("singleton_rate"),
        rate("is_ambiguous").alias("ambiguous_rate"),
        rate("is_empty").alias("empty_rate"),
        F.try_divide(
            F.count_if(hit).cast("double"), F.count_if("is_singleton").cast("double")
        ).alias("singleton_accuracy"),
    ).select(
        "model", "alpha", (F.lit(1.0) - F.col("alpha")).alias("target_coverage"), "qhat",
        "empirical_coverage", "avg_set_size", "singleton_rate", "ambiguous_rate", "empty_rate",
        "singleton_accuracy",
    )


def conformal_candidates(
    predictions: DataFrame, methods: Sequence[str] = CANDIDATE_METHODS
) -> DataFrame:
    """Uncalibrated variants: recalibrated ones have already used the calibration split."""
    return predictions.where(F.col("method").isin(list(methods)))
