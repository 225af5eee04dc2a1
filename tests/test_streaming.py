from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from trustgauge.operators import calibrate
from trustgauge.streaming import apply


def test_stream_gives_the_batch_result(spark, predictions, tmp_path):
    rng = np.random.default_rng(3)
    z = rng.normal(0, 2, 120)
    y = (rng.random(120) < 0.5).astype(int)
    rows = predictions(list(zip(y, 1 / (1 + np.exp(-z)))), score=z.tolist())
    temperatures, blocks = calibrate.fit_temperature(rows), calibrate.isotonic_blocks(rows)
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    query = apply.write_stream(
        apply.calibrated_stream(stream, temperatures, blocks), str(tmp_path / "out"), str(tmp_path / "state")
    )
    query.awaitTermination(60)
    key = ["model", "id", "prob"]
    got = spark.read.parquet(str(tmp_path / "out")).select(*key).collect()
    expected = calibrate.calibrated_family(rows, temperatures, blocks).select(*key).collect()
    assert sorted(got) == sorted(expected) and len(got) == 360


def test_stopped_stream_goes_on_where_it_was(spark, predictions, tmp_path):
    """Stopped after some of its files and started again, a stream gives each row once."""
    rng = np.random.default_rng(4)
    x = rng.random(900)
    rows = predictions(list(zip((rng.random(900) < x).astype(int), x)), score=(x - 0.5).tolist())
    temperatures, blocks = calibrate.fit_temperature(rows), calibrate.isotonic_blocks(rows)
    rows.repartition(6).write.parquet(str(tmp_path / "in"))

    def start(reader):
        stream = reader.schema(rows.schema).parquet(str(tmp_path / "in"))
        return apply.calibrated_stream(stream, temperatures, blocks).writeStream.format("parquet").option(
            "path", str(tmp_path / "out")
        ).option("checkpointLocation", str(tmp_path / "state"))

    one_by_one = start(spark.readStream.option("maxFilesPerTrigger", 1)).start()
    while not (one_by_one.lastProgress and one_by_one.lastProgress["batchId"] >= 1):
        one_by_one.awaitTermination(1)
    one_by_one.stop()
    start(spark.readStream).trigger(availableNow=True).start().awaitTermination(120)
    key = ["model", "id", "prob"]
    got = spark.read.parquet(str(tmp_path / "out")).select(*key).collect()
    expected = calibrate.calibrated_family(rows, temperatures, blocks).select(*key).collect()
    assert sorted(got) == sorted(expected) and len(got) == 2700


def test_categories_on_a_stream(spark, tmp_path):
    df = spark.createDataFrame([("a movie", 0, 0.9)], "text string, target int, prob double")
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    apply.write_stream(
        apply.categorized_stream(stream), str(tmp_path / "out"), str(tmp_path / "state")
    ).awaitTermination(60)
    row = spark.read.parquet(str(tmp_path / "out")).select(F.col("category")).first()
    assert row["category"] == "fiction_entertainment"
