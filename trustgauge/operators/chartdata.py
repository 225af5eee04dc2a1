"""The tables behind the usual charts, ready to plot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reliability_series(bins: DataFrame) -> DataFrame:
    return bins.where(F.col("accuracy").isNotNull() & (F.col("count") > 0)).select(
        "model", "bin", "mean_confidence", "accuracy"
    )


def rejection_series(curve: DataFrame) -> DataFrame:
    return curve.where(F.col("selective_accuracy").isNotNull()).select(
        "model", "threshold", "coverage", "selective_accuracy"
    )


def threshold_panels(curve: DataFrame) -> DataFrame:
    """Accuracy, coverage and rejected rows by threshold, with the scale of the last panel."""
    panels = curve.select(
        "model",
        "threshold",
        F.col("selective_accuracy").alias("accuracy"),
        "coverage",
        F.col("rejected").cast("double").alias("rejected"),
    ).unpivot(
        ["model", "threshold"], ["accuracy", "coverage", "rejected"], "panel", "value"
    )
    scale = curve.agg(F.greatest(F.max("rejected"), F.lit(1)).cast("long")).scalar()
    return panels.where(F.col("value").isNotNull()).withColumn("max_rejected", scale)


def confusion_cells(metrics: DataFrame) -> DataFrame:
    """The four counts per model and their share of the largest count."""
    cells = metrics.unpivot("model", ["tn", "fp", "fn", "tp"], "cell", "n")
    top = F.greatest(
        *[F.max(c) for c in ("tn", "fp", "fn", "tp")], F.lit(1)
    ).cast("double")
    return cells.withColumn("intensity", F.col("n") / metrics.agg(top).scalar())


def conformal_panels(conformal: DataFrame) -> DataFrame:
    return conformal.select(
        "model",
        "alpha",
        F.col("empirical_coverage").alias("coverage"),
        "singleton_rate",
        F.col("avg_set_size").alias("set_size"),
    ).unpivot(
        ["model", "alpha"], ["coverage", "singleton_rate", "set_size"], "panel", "value"
    ).orderBy("model", "panel", "alpha")


def category_matrix(summary: DataFrame, models: list[str] | None = None) -> DataFrame:
    """Highly confident errors by category and model; a missing pair counts 0."""
    pivot = summary.groupBy("category").pivot("model", models)
    return pivot.agg(F.sum("high_confidence_error_count")).na.fill(0)
