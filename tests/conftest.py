from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("trustgauge-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def predictions(spark):
    """Build a predictions table from (target, prob) pairs of one model."""

    def build(pairs, model="toy/raw", split="test", score=None):
        rows = [
            (model, model.split("/")[0], "raw", split, i, int(y), score[i] if score else None, float(p))
            for i, (y, p) in enumerate(pairs)
        ]
        return spark.createDataFrame(
            rows,
            "model string, base_model string, method string, split string, id long, target int, "
            "score double, prob double",
        )

    return build


@pytest.fixture
def toy_corpus(spark):
    return spark.createDataFrame(
        [
            (0, "fire explosion rescue", 1),
            (1, "flood evacuation emergency", 1),
            (2, "coffee music movie", 0),
            (3, "homework meeting coffee", 0),
        ],
        "id long, text string, target int",
    )
