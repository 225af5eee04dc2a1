from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from trustgauge.operators import chartdata, conformal, errors, metrics


def test_ece_is_zero_for_perfect_confident_predictions(predictions):
    rows = predictions([(0, 0.0), (1, 1.0), (0, 0.0), (1, 1.0)])
    assert metrics.expected_calibration_error(rows).first()["ece"] == 0.0


def test_rejection_counts(predictions):
    row = metrics.rejection_curve(predictions([(0, 0.10), (1, 0.60), (1, 0.51)]), [0.70]).first()
    assert (row["answered"], row["rejected"]) == (1, 2)
    assert row["coverage"] == pytest.approx(1 / 3)
    assert row["selective_accuracy"] == 1.0


def test_rejection_at_equality(predictions):
    row = metrics.rejection_curve(predictions([(1, 0.75)]), [0.75]).first()
    assert row["answered"] == 0 and row["selective_accuracy"] is None


def test_coverage_never_rises_with_the_threshold(predictions):
    rows = predictions([(i % 2, i / 99) for i in range(100)])
    coverage = [r["coverage"] for r in metrics.rejection_curve(rows).orderBy("threshold").collect()]
    assert len(coverage) == 10 and coverage == sorted(coverage, reverse=True)


def test_bins(predictions):
    rows = metrics.reliability_bins(predictions([(1, 0.6), (1, 1.0), (0, 0.7)])).orderBy("bin").collect()
    assert [r["count"] for r in rows] == [0, 0, 0, 0, 0, 1, 1, 0, 0, 1]
    assert rows[0]["mean_confidence"] == pytest.approx(0.05) and rows[0]["accuracy"] is None
    assert rows[5]["right"] == 6 * 0.1 and rows[5]["accuracy"] == 1.0
    assert rows[6]["accuracy"] == 0.0
    assert (rows[9]["left"], rows[9]["right"]) == (0.9, 1.0)


def test_metrics_with_empty_denominators(predictions):
    row = metrics.classification_metrics(predictions([(0, 0.2), (0, 0.4)])).first()
    assert (row["precision"], row["recall"], row["f1"], row["accuracy"]) == (0.0, 0.0, 0.0, 1.0)
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (2, 0, 0, 0)
    assert row["brier_score"] == pytest.approx((0.04 + 0.16) / 2)
    assert row["log_loss"] == pytest.approx(-(math.log(0.8) + math.log(0.6)) / 2)


def test_leaderboard_order(predictions):
    good = predictions([(0, 0.0), (1, 1.0)], model="a/raw")
    bad = predictions([(0, 1.0), (1, 0.0)], model="b")
    board = metrics.leaderboard(good.unionByName(bad)).collect()
    assert [r["model"] for r in board] == ["a/raw", "b"]
    assert [r["method"] for r in board] == ["raw", "raw"]


def test_conformal_quantile_is_held_within_the_scores(predictions):
    rows = predictions([(0, 0.1), (1, 0.9), (0, 0.2), (1, 0.8)])
    qhat = conformal.conformal_quantiles(rows, [0.1]).first()["qhat"]
    assert qhat == pytest.approx(0.2)


def test_conformal_evaluation_with_empty_sets(predictions):
    calibration = predictions([(0, 0.1), (1, 0.9), (0, 0.2), (1, 0.8)])
    row = conformal.evaluate_conformal(calibration, predictions([(0, 0.3), (1, 0.7)]), [0.1]).first()
    assert row["empirical_coverage"] == 0.0 and row["avg_set_size"] == 0.0
    assert row["empty_rate"] == 1.0 and row["singleton_accuracy"] is None
    assert row["target_coverage"] == 0.9


@pytest.mark.parametrize("alpha", [0.0, 1.0, float("nan")])
def test_bad_alpha(predictions, alpha):
    with pytest.raises(ValueError):
        conformal.conformal_quantiles(predictions([(0, 0.1)]), [alpha])


def test_quantile_falls_as_alpha_grows(predictions):
    rows = predictions([(i % 2, (i * 37 % 101) / 101) for i in range(101)])
    q = [r["qhat"] for r in conformal.conformal_quantiles(rows).orderBy("alpha").collect()]
    assert len(q) == 5 and q == sorted(q, reverse=True)


def test_top_errors_and_examples(spark, predictions):
    rows = predictions([(0, 0.5 + i / 100) for i in range(20)] + [(1, 0.9)])
    texts = spark.createDataFrame([(i, "x" * 221 + "\n" if i == 19 else f"t\n{i}") for i in range(21)], "id long, text string")
    top = errors.high_confidence_errors(rows, texts, 3).orderBy(F.desc("confidence")).collect()
    assert [r["id"] for r in top] == [19, 18, 17]
    analysis = errors.error_analysis(rows, texts)
    assert analysis.count() == 20
    examples = errors.error_examples(analysis).orderBy(F.desc("confidence")).collect()
    assert len(examples) == 8
    assert examples[0]["example"] == "x" * 217 + "..." and examples[1]["example"] == "t 18"


def test_category_summary_and_matrix(spark, predictions):
    rows = predictions([(0, 0.95), (0, 0.6)], model="a/raw").unionByName(predictions([(1, 0.1)], model="b/raw"))
    texts = spark.createDataFrame([(0, "a movie"), (1, "a movie")], "id long, text string")
    summary = errors.error_category_summary(errors.error_analysis(rows, texts))
    first = summary.first()
    assert (first["category"], first["error_count"], first["high_confidence_error_count"]) == ("fiction_entertainment", 2, 1)
    assert first["max_confidence"] == 0.95
    matrix = {r["category"]: (r["a/raw"], r["b/raw"]) for r in chartdata.category_matrix(summary).collect()}
    assert matrix == {"fiction_entertainment": (1, 0), "short_or_low_context_real_disaster": (0, 1)}


def test_no_errors_give_an_empty_summary(spark, predictions):
    texts = spark.createDataFrame([(0, "x")], "id long, text string")
    summary = errors.error_category_summary(errors.error_analysis(predictions([(1, 0.9)]), texts))
    assert summary.count() == 0
    assert summary.columns == [
        "model", "category", "error_count", "high_confidence_error_count", "mean_confidence", "max_confidence",
    ]
