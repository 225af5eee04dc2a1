from __future__ import annotations

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from trustgauge import __main__ as jobs
from trustgauge.operators.mlp import MlpSettings
from trustgauge.plans import bindings, experiment
from trustgauge.sources import sinks


@pytest.fixture(scope="module")
def labelled_csv(spark, tmp_path_factory):
    docs = bindings.table(spark, SMALL, "documents").join(bindings.table(spark, SMALL, "labels"), "doc_id")
    out = docs.select(
        F.col("doc_id").alias("id"), F.col("source").alias("keyword"), "text", F.col("quality").alias("target")
    )
    path = str(tmp_path_factory.mktemp("labelled") / "train.csv")
    out.coalesce(1).write.csv(path, header=True, quote='"', escape='"')
    return path


def test_main_experiment(spark):
    settings = experiment.Settings(
        max_features=500, ensemble_size=2, include_platt=True, mlp=MlpSettings(embedding_dim=4, hidden_dim=4, epochs=2)
    )
    tables = experiment.run_experiment(bindings.split_documents(spark, SMALL), settings)
    board = tables["metrics_summary"].collect()
    assert len(board) == 18 and len({r["model"] for r in board}) == 18
    assert [r["ece"] for r in board] == sorted(r["ece"] for r in board)
    conformal = tables["conformal_prediction"].collect()
    assert len(conformal) == 30
    assert all(0.0 <= r["empirical_coverage"] <= 1.0 for r in conformal)
    assert tables["reliability_bins"].count() == 180 and tables["rejection_curves"].count() == 180
    assert tables["calibration_notes"].count() == 12
    for name in set(sinks.RESULT_COLUMNS) & set(tables):
        assert set(sinks.RESULT_COLUMNS[name]) <= set(tables[name].columns)
    wrong = sum(r["fp"] + r["fn"] for r in board)
    assert tables["error_analysis"].count() == wrong
    assert sum(r["error_count"] for r in tables["error_category_summary"].collect()) == wrong


def test_small_experiment_from_csv(spark, labelled_csv, tmp_path):
    written = jobs.run(
        spark,
        ["experiment", "--labelled", labelled_csv, "--output-dir", str(tmp_path), "--no-extra-models",
         "--ensemble-size", "0", "--max-features", "200"],
    )
    assert len(written) == 17
    board = spark.read.csv(f"{tmp_path}/metrics_summary", header=True)
    assert board.columns == sinks.RESULT_COLUMNS["metrics_summary"]
    assert {r["method"] for r in board.collect()} == {
        "raw", "temperature_scaling", "isotonic_regression", "label_smoothing_0.10",
    }


def test_external_job(spark, labelled_csv, tmp_path):
    ids = bindings.table(spark, SMALL, "labels").select(F.col("doc_id").alias("id"))
    ids.select("id", F.array(F.lit(0.0), (F.col("id") % 5 - 2).cast("double")).alias("logits")).write.parquet(
        str(tmp_path / "logits")
    )
    jobs.run(
        spark,
        ["external", "--labelled", labelled_csv, "--output-dir", str(tmp_path / "out"), "--logits",
         str(tmp_path / "logits"), "--model-name", "vendor/model", "--limit-test", "10", "--format", "parquet"],
    )
    board = spark.read.parquet(str(tmp_path / "out" / "metrics_summary")).collect()
    assert {r["model"] for r in board} == {
        "vendor_model/raw", "vendor_model/temperature_scaling", "vendor_model/isotonic_regression",
    }
    assert all(r["tn"] + r["fp"] + r["fn"] + r["tp"] == 10 for r in board)
