"""Score a stream of raw predictions with calibrators fitted on a batch.

Calibration and error categories need no state: they are projections and joins with small
settled tables, so the batch operators run on a streaming DataFrame as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from trustgauge.functions.scalars import predicted_label
from trustgauge.operators.calibrate import calibrated_family
from trustgauge.operators.errors import with_category


def calibrated_stream(
    predictions: DataFrame,
    temperatures: DataFrame,
    blocks: DataFrame,
    platt: DataFrame | None = None,
) -> DataFrame:
    """All variants of each incoming raw prediction."""
    return calibrated_family(predictions, temperatures, blocks, platt)


def categorized_stream(labelled_predictions: DataFrame) -> DataFrame:
    """Add predicted label and error category to rows with text, target and prob."""
    label = predicted_label(F.col("prob"))
    return with_category(
        labelled_predictions.withColumn("predicted_label", label), "target", "predicted_label"
    )


def write_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to parquet, taking what has arrived and then stopping."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
