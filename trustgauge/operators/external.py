"""Scores of a model that ran elsewhere, or that a user's function runs here."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trustgauge.functions.scalars import logits_probability, logits_score, model_slug
from trustgauge.sources.shipping import ship_package


def external_predictions(truth: DataFrame, logits: DataFrame, model_name: str) -> DataFrame:
    """Join (id, target, split) with (id, logits) and turn logits into score and probability.

    Every row needs its logits: rows without make an error that names their number.
    """
    family = model_slug(model_name)
    keys = ["id", "split"] if "split" in logits.columns else ["id"]
    missing = truth.join(logits.where(F.col("logits").isNotNull()), keys, "left_anti").count()
    if missing:
        raise ValueError(f"{missing} rows have no logits of {model_name}")
    return truth.join(logits, keys).select(
        F.lit(f"{family}/raw").alias("model"),
        F.lit(family).alias("base_model"),
        F.lit("raw").alias("method"),
        "split",
        "id",
        "target",
        logits_score(F.col("logits")).alias("score"),
        logits_probability(F.col("logits")).alias("prob"),
    )


# Bytes of inputs that the scoring function is handed at a time.
BATCH_BYTES = 8 << 20


def score_batches(
    rows: DataFrame,
    load: Callable[[], Callable[[np.ndarray], np.ndarray]],
    width: int,
    inputs_col: str = "inputs",
) -> DataFrame:
    """Add ``logits``, what a user's model gives for an array of ``width`` numbers.

    ``load`` is called once in each Python worker, reads the model there and returns a function from
    a matrix of inputs, one row each, to a matrix of logits. Batches hold BATCH_BYTES of inputs. Rows
    with null inputs, or with another number of them, have null logits, and so have those
    for which the model gives a number that is not finite; ``external_predictions`` refuses them
    with their number.
    """
    ship_package(rows.sparkSession)
    score = predict_batch_udf(
        load,
        return_type=T.ArrayType(T.DoubleType()),
        batch_size=max(1, BATCH_BYTES // (8 * width)),
        input_tensor_shapes=[[width]],
    )
    inputs = F.col(inputs_col).cast("array<double>")
    whole = F.col(inputs_col).isNotNull() & (F.size(inputs_col) == width) & ~F.exists(inputs, lambda x: x.isNull())
    known = F.when(whole, inputs).otherwise(F.array_repeat(F.lit(0.0), width))
    scored = rows.withColumn("_whole", whole).withColumn("_logits", score(known))
    finite = ~F.exists("_logits", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return scored.withColumn("logits", F.when(F.col("_whole") & finite, F.col("_logits"))).drop("_whole", "_logits")
