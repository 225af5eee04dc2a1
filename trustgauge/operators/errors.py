"""Wrong predictions: the most confident ones, their likely reasons, and summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trustgauge.functions.rules import error_category
from trustgauge.functions.scalars import HIGH_CONFIDENCE, confidence, predicted_label
from trustgauge.functions.text import extract_keyword
from trustgauge.operators.phrases import phrase_hits
from trustgauge.sources.workspace import settle

# Report sizes and the cut of an example text.
TOP_ERRORS = 12
EXAMPLES_PER_MODEL = 8
EXAMPLE_CHARS = 220
EXAMPLE_KEEP = 217


def with_category(
    rows: DataFrame,
    target: str,
    predicted: str,
    phrases: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Add ``category``; the text is lowered once, in a step of its own."""
    category = error_category(
        F.col("text"), F.col(target), F.col(predicted), phrases, F.col("_lowered")
    )
    lowered = rows.withColumn("_lowered", F.lower("text"))
    return lowered.withColumn("category", category).drop("_lowered")


def with_category_by_rules(rows: DataFrame, target: str, predicted: str, rules: DataFrame) -> DataFrame:
    """Add ``category`` under phrase lists given as a table (rule_set, phrase), of any number.

    A rule set bears the name of the list that it replaces; a list without rows is empty.
    """
    category = error_category(F.col("text"), F.col(target), F.col(predicted), hits=F.col("_hits"))
    return phrase_hits(rows, rules, hits_col="_hits").withColumn("category", category).drop("_hits")


def wrong_predictions(predictions: DataFrame) -> DataFrame:
    p = F.col("prob")
    return (
        predictions.withColumn("predicted_label", predicted_label(p))
        .where(F.col("predicted_label") != F.col("target"))
        .withColumn("confidence", confidence(p))
        .withColumnsRenamed({"target": "true_label", "prob": "prob_positive"})
    )


def _top_errors(errors: DataFrame, n: int) -> DataFrame:
    """Top n per model; Spark trims each task to n rows per model before the shuffle."""
    tie = "id" if "id" in errors.columns else "text"  # saved errors carry no id
    order = Window.partitionBy("model").orderBy(F.desc("confidence"), F.asc(tie))
    return errors.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= n).drop(
        "_rank"
    )


def high_confidence_errors(
    predictions: DataFrame, texts: DataFrame, top_n: int = TOP_ERRORS
) -> DataFrame:
    """Most confident mistakes of every model, with text.

    The ranking runs on narrow rows; texts are looked up for the few rows that are left.
    """
    top = settle(
        _top_errors(
            wrong_predictions(predictions).select(
                "model", "id", "true_label", "predicted_label", "confidence", "prob_positive"
            ),
            top_n,
        )
    )
    return top.join(texts.select("id", "text"), "id").select(
        "model", "id", "text", "true_label", "predicted_label", "confidence", "prob_positive"
    )


def error_analysis(
    predictions: DataFrame,
    texts: DataFrame,
    threshold: float = HIGH_CONFIDENCE,
    phrases: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """One row per wrong prediction with category, confidence flag, keyword and text.

    The variants that fail on a document in the same way are listed on one row, so each text
    is joined and searched once, not once per variant.
    """
    mistakes = wrong_predictions(predictions).groupBy(
        "id", "true_label", "predicted_label"
    ).agg(F.collect_list(F.struct("model", "confidence", "prob_positive")).alias("_models"))
    found = mistakes.join(texts.select("id", "text"), "id")
    judged = with_category(found, "true_label", "predicted_label", phrases).select(
        "id",
        "category",
        "true_label",
        "predicted_label",
        extract_keyword(F.col("text")).alias("keyword"),
        "text",
        "_models",
    )
    return judged.select(*judged.columns[:-1], F.inline_outer("_models")).select(
        "model",
        "id",
        "category",
        "true_label",
        "predicted_label",
        "confidence",
        "prob_positive",
        (F.col("confidence") >= F.lit(threshold)).alias("is_high_confidence"),
        "keyword",
        "text",
    )


def error_category_summary(errors: DataFrame) -> DataFrame:
    """Counts and confidence per model and category, worst first."""
    return errors.groupBy("model", "category").agg(
        F.count(F.lit(1)).alias("error_count"),
        F.count_if("is_high_confidence").alias("high_confidence_error_count"),
        F.avg("confidence").alias("mean_confidence"),
        F.max("confidence").alias("max_confidence"),
    ).orderBy(
        F.asc("model"), F.desc("high_confidence_error_count"), F.desc("error_count"),
        F.asc("category"),
    )


def error_examples(errors: DataFrame, n: int = EXAMPLES_PER_MODEL) -> DataFrame:
    """Top examples per model with the text on one line and cut to report length."""
    line = F.replace(F.col("text"), F.lit("\n"), F.lit(" "))
    shown = F.when(
        F.length(line) > EXAMPLE_CHARS, F.concat(F.substring(line, 1, EXAMPLE_KEEP), F.lit("..."))
    ).otherwise(line)
    columns = [
        *(["id"] if "id" in errors.columns else []),
        "category", "true_label", "predicted_label", "confidence", "example",
    ]
    # With an id to break ties, only the short example goes through the ranking.
    listed = errors.withColumn("example", shown)
    ranked = listed.select("model", *columns) if "id" in columns else listed
    return _top_errors(ranked, n).select("model", *columns)


def recategorize(
    saved: DataFrame, phrases: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Category of already saved errors; all of them count as highly confident."""
    out = with_category(saved, "true_label", "predicted_label", phrases).withColumn(
        "is_high_confidence", F.lit(True)
    )
    return out if "keyword" in saved.columns else out.withColumn("keyword", F.lit(""))
