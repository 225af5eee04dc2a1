"""Result tables on disk."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

# The name and column order of every result table.
RESULT_COLUMNS: dict[str, list[str]] = {
    "metrics_summary": [
        "base_model", "method", "accuracy", "precision", "recall", "f1", "log_loss",
        "brier_score", "tn", "fp", "fn", "tp", "ece", "model",
    ],
    "reliability_bins": [
        "model", "bin", "left", "right", "count", "mean_confidence", "accuracy",
    ],
    "rejection_curves": [
        "model", "threshold", "coverage", "rejected", "answered", "selective_accuracy",
    ],
    "high_confidence_errors": [
        "model", "text", "true_label", "predicted_label", "confidence", "prob_positive",
    ],
    "error_analysis": [
        "model", "category", "true_label", "predicted_label", "confidence", "prob_positive",
        "is_high_confidence", "keyword", "text",
    ],
    "error_category_summary": [
        "model", "category", "error_count", "high_confidence_error_count", "mean_confidence",
        "max_confidence",
    ],
    "conformal_prediction": [
        "model", "alpha", "target_coverage", "qhat", "empirical_coverage", "avg_set_size",
        "singleton_rate", "ambiguous_rate", "empty_rate", "singleton_accuracy",
    ],
}


def write_table(df: DataFrame, folder: str, name: str, fmt: str = "parquet") -> str:
    """Write one result table, in its fixed column order when it has one."""
    path = f"{folder.rstrip('/')}/{name}"
    ordered = df.select(*RESULT_COLUMNS[name]) if name in RESULT_COLUMNS else df
    writer = ordered.write.mode("overwrite")
    if fmt == "csv":
        writer.csv(
            path, header=True, quote='"', escape='"', emptyValue="", nullValue="",
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        )
    else:
        writer.format(fmt).save(path)
    return path


def write_results(tables: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> list[str]:
    return [write_table(df, folder, name, fmt) for name, df in tables.items()]


def write_by_family(df: DataFrame, folder: str, name: str) -> str:
    """Result table with one folder per base model."""
    path = f"{folder.rstrip('/')}/{name}"
    df.write.mode("overwrite").partitionBy("base_model").parquet(path)
    return path
