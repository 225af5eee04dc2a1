"""The end-to-end jobs: main experiment, external model, saved errors."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustgauge.functions.text import compose_text
from trustgauge.operators import calibrate, chartdata, conformal, errors, features, linear, metrics, svm
from trustgauge.operators.mlp import MlpSettings, fit_mlp, mlp_scores
from trustgauge.operators.parallel import side_by_side
from trustgauge.operators.sampling import CALIBRATION_SHARE, TRAIN_SHARE, stratified_split
from trustgauge.plans.bindings import as_predictions
from trustgauge.sources.labelled import load_saved_errors
from trustgauge.sources.sinks import write_results
from trustgauge.sources.workspace import by_key, settle

HELD_OUT = "split <> 'train'"
KEEP = ("id", "target", "split")


@dataclass(frozen=True)
class Settings:
    max_features: int = features.MAX_FEATURES
    min_df: int = features.MIN_DF
    ngram_range: tuple[int, int] = features.NGRAMS
    ensemble_size: int = 5
    smoothing: float = linear.SMOOTHING
    include_platt: bool = False
    extra_models: bool = True
    seed: int = 42
    max_iter: int = linear.LOGISTIC["max_iter"]
    reg_param: float = linear.LOGISTIC["reg_param"]
    train_share: float = TRAIN_SHARE
    calibration_share: float = CALIBRATION_SHARE
    mlp: MlpSettings = field(default_factory=lambda: MlpSettings(seed=73))


@dataclass(frozen=True)
class Prepared:
    """Split documents with TF-IDF rows and vectors, computed once for all linear models."""

    docs: DataFrame
    vocabulary: DataFrame
    rows: DataFrame
    train_vectors: DataFrame


def split_labelled(
    df: DataFrame,
    seed: int = 42,
    train_share: float = TRAIN_SHARE,
    calibration_share: float = CALIBRATION_SHARE,
) -> DataFrame:
    """(id, target, split, text) from a labelled table: compose the text, then split.

    Written once by split, so that no later step parses or composes the texts again.
    """
    keyword = F.col("keyword") if "keyword" in df.columns else None
    composed = by_key(
        df.select("id", "target", compose_text(F.col("text"), keyword).alias("text")), "id"
    )
    split = stratified_split(
        composed, train_fraction=train_share, calibration_fraction=calibration_share, seed=seed
    )
    return settle(split, partition_by=["split"])


def prepare(docs: DataFrame, settings: Settings = Settings()) -> Prepared:
    cut = by_key(docs, "id")
    train = cut.where("split = 'train'")
    vocabulary = features.fit_vocabulary(
        train, settings.min_df, settings.max_features, settings.ngram_range
    )
    rows = settle(
        features.tfidf(cut, vocabulary, settings.ngram_range, KEEP),
        partition_by=["split"],
    )
    vectors = features.to_vectors(
        rows.where("split = 'train'"), vocabulary.count(), ("id", "target")
    )
    return Prepared(docs, vocabulary, rows, vectors)


def _linear_predictions(
    prepared: Prepared, model: linear.LinearModel, family: str, method: str
) -> DataFrame:
    scored = linear.linear_scores(prepared.rows.where(HELD_OUT), model)
    return as_predictions(linear.with_probability(scored), family, method)


def logistic(prepared: Prepared, settings: Settings) -> DataFrame:
    model = linear.fit_logistic(prepared.train_vectors, settings.max_iter, settings.reg_param)
    return _linear_predictions(prepared, model, "logreg_tfidf", "raw")


def label_smoothing(prepared: Prepared, settings: Settings) -> DataFrame:
    model = linear.fit_smoothed_logistic(prepared.train_vectors, settings.smoothing)
    name = f"label_smoothing_{settings.smoothing:.2f}"
    return _linear_predictions(prepared, model, "logreg_tfidf", name)


def bootstrap_ensemble(prepared: Prepared, settings: Settings) -> DataFrame:
    members = linear.fit_ensemble(
        prepared.docs.where("split = 'train'").select("id", "target", "text"),
        settings.ensemble_size,
        settings.min_df,
        settings.max_features,
        ngram_range=settings.ngram_range,
        seed=settings.seed + 100,
    )
    scored = linear.ensemble_scores(
        by_key(prepared.docs.where(HELD_OUT), "id"), members, settings.ngram_range, KEEP
    ).withColumn("score", F.lit(None).cast("double"))
    return as_predictions(scored, "logreg_tfidf", "bootstrap_ensemble")


def naive_bayes(prepared: Prepared, settings: Settings) -> DataFrame:
    train = prepared.rows.where("split = 'train'")
    model = linear.fit_naive_bayes(train, prepared.vocabulary)
    return _linear_predictions(prepared, model, "naive_bayes_tfidf", "raw")


def linear_svm(prepared: Prepared, settings: Settings) -> DataFrame:
    """The margin of the SVM is used as a score without calibration, on purpose."""
    train = prepared.rows.where("split = 'train'")
    model = svm.fit(train, prepared.vocabulary.count()).model
    return _linear_predictions(prepared, model, "linear_svm_tfidf", "raw_margin_sigmoid")


def embedding_mlp(prepared: Prepared, settings: Settings) -> DataFrame:
    limit = min(settings.max_features, features.MAX_TOKENS)
    docs = by_key(prepared.docs, "id")
    train = docs.where("split = 'train'")
    vocabulary = features.fit_token_vocabulary(train, settings.min_df, limit)
    encoded = settle(
        features.encode(docs, vocabulary, KEEP), partition_by=["split"]
    )
    model = fit_mlp(encoded.where("split = 'train'"), vocabulary.count(), settings.mlp)
    scored = mlp_scores(encoded.where(HELD_OUT), model)
    return as_predictions(linear.with_probability(scored), "embedding_mlp")


FAMILIES: dict[str, Callable[[Prepared, Settings], DataFrame]] = {
    "logreg_tfidf": logistic,
    "label_smoothing": label_smoothing,
    "bootstrap_ensemble": bootstrap_ensemble,
    "naive_bayes_tfidf": naive_bayes,
    "linear_svm_tfidf": linear_svm,
    "embedding_mlp": embedding_mlp,
}
EXTRA_FAMILIES = {"naive_bayes_tfidf", "linear_svm_tfidf", "embedding_mlp"}
UNCALIBRATED = ("raw", "raw_margin_sigmoid")


def calibrate_variants(
    raw: DataFrame, include_platt: bool = False
) -> tuple[DataFrame, DataFrame]:
    """All test-split variants and the fitted parameters.

    Raw families gain their calibrated variants; smoothing and ensemble stay as they are.
    """
    to_calibrate = raw.where(F.col("method").isin(*UNCALIBRATED))
    fit_rows = to_calibrate.where("split = 'calibration'")
    temperatures = calibrate.fit_temperature(fit_rows)
    blocks = calibrate.isotonic_blocks(fit_rows)
    platt = calibrate.fit_platt(fit_rows) if include_platt else None
    test = "split = 'test'"
    variants = calibrate.calibrated_family(
        to_calibrate.where(test), temperatures, blocks, platt
    ).unionByName(raw.where(~F.col("method").isin(*UNCALIBRATED)).where(test))
    return settle(variants), calibrate.calibration_notes(temperatures, platt)


def evaluation_tables(variants: DataFrame, texts: DataFrame | None = None) -> dict[str, DataFrame]:
    """Every report over the test-split variants, and the chart tables behind them."""
    summary = settle(metrics.leaderboard(variants))
    bins = settle(metrics.reliability_bins(variants))
    curve = settle(metrics.rejection_curve(variants))
    tables = {
        "metrics_summary": summary.orderBy("ece", "log_loss", "model"),
        "reliability_bins": bins,
        "rejection_curves": curve,
        "chart_reliability": chartdata.reliability_series(bins),
        "chart_rejection": chartdata.rejection_series(curve),
        "chart_thresholds": chartdata.threshold_panels(curve),
        "chart_confusion": chartdata.confusion_cells(summary),
    }
    if texts is not None:
        mistakes = settle(errors.error_analysis(variants, texts))
        categories = settle(errors.error_category_summary(mistakes))
        tables |= {
            "high_confidence_errors": errors.high_confidence_errors(variants, texts),
            "error_analysis": mistakes,
            "error_category_summary": categories,
            "error_examples": errors.error_examples(mistakes),
            "chart_categories": chartdata.category_matrix(categories),
        }
    return tables


def run_experiment(docs: DataFrame, settings: Settings = Settings()) -> dict[str, DataFrame]:
    """Main job over split documents (id, target, split, text): all tables by name."""
    prepared = prepare(docs, settings)
    names = [
        name
        for name in FAMILIES
        if (settings.extra_models or name not in EXTRA_FAMILIES)
        and (settings.ensemble_size > 0 or name != "bootstrap_ensemble")
    ]
    parts = side_by_side(
        docs.sparkSession, lambda name: FAMILIES[name](prepared, settings), names
    )
    raw = settle(reduce(DataFrame.unionByName, parts), partition_by=["split"])
    variants, notes = calibrate_variants(raw, settings.include_platt)
    tables = evaluation_tables(variants, docs)
    candidates = conformal.conformal_candidates(
        raw,
        [*UNCALIBRATED, f"label_smoothing_{settings.smoothing:.2f}", "bootstrap_ensemble"],
    )
    coverage = settle(
        conformal.evaluate_conformal(
            candidates.where("split = 'calibration'"), candidates.where("split = 'test'")
        )
    )
    return tables | {
        "conformal_prediction": coverage,
        "chart_conformal": chartdata.conformal_panels(coverage),
        "calibration_notes": notes,
        "split_counts": metrics.split_counts(docs),
    }


def evaluate_external(
    predictions: DataFrame, texts: DataFrame | None = None
) -> dict[str, DataFrame]:
    """External model: raw, temperature and isotonic variants, no conformal sets."""
    variants, notes = calibrate_variants(settle(predictions, partition_by=["split"]))
    return evaluation_tables(variants, texts) | {"calibration_notes": notes}


def recategorize_saved(spark: SparkSession, csv_path: str, folder: str) -> list[str]:
    """Categorise saved errors again and write the analysis, its summary and examples."""
    analysis = settle(errors.recategorize(load_saved_errors(spark, csv_path)))
    summary = errors.error_category_summary(analysis)
    tables = {
        "high_confidence_error_analysis": analysis,
        "high_confidence_error_category_summary": summary,
        "error_examples": errors.error_examples(analysis),
        "chart_categories": chartdata.category_matrix(settle(summary)),
    }
    return write_results(tables, folder, "csv")
