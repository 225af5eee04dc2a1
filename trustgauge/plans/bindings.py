"""The given tables in the shape the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trustgauge.functions.scalars import base_model, method
from trustgauge.functions.text import compose_text
from trustgauge.operators.features import fit_vocabulary, tfidf
from trustgauge.operators.linear import fit_naive_bayes, linear_scores, with_probability
from trustgauge.operators.sampling import stratified_split
from trustgauge.sources.workspace import by_key, in_place, settle, spread

SEED = 42


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as (id, text), partitioned as it is read unless the files are few."""
    raw = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", "source")
    return spread(raw, "id").select(
        "id", compose_text(F.col("text"), F.col("source")).alias("text")
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as (id, text), the source standing in for the keyword column.

    Cut by id, since the callers widen each text into many terms.
    """
    raw = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", "source")
    return by_key(raw, "id").select(
        "id", compose_text(F.col("text"), F.col("source")).alias("text")
    )


def documents_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as (id, text) like ``documents``, but left where it is read."""
    raw = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", "source")
    return in_place(raw, "id").select(
        "id", compose_text(F.col("text"), F.col("source")).alias("text")
    )


def split_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Composed labelled documents with their split: (id, target, split, text).

    The split is made on the labels alone and joined by id.
    """
    labels = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), F.col("quality").alias("target")
    )
    # A label without a document must not take a place in the split.
    known = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"))
    splits = settle(
        stratified_split(labels.join(known, "id", "left_semi"), seed=SEED).select(
            "id", "target", "split"
        )
    )
    docs = by_key(
        table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text", "source"),
        "id",
    )
    joined = docs.join(splits, "id").select(
        "id", "target", "split", compose_text(F.col("text"), F.col("source")).alias("text")
    )
    return settle(joined, partition_by=["split"])


def as_predictions(scored: DataFrame, family: str, method_name: str = "raw") -> DataFrame:
    return scored.select(
        F.lit(f"{family}/{method_name}").alias("model"),
        F.lit(family).alias("base_model"),
        F.lit(method_name).alias("method"),
        "split",
        "id",
        "target",
        "score",
        "prob",
    )


def naive_bayes_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Naive Bayes trained on the train split, scored on the other two."""
    # Cut by id anew: else every pair of document and term is shuffled, several times.
    docs = by_key(split_documents(spark, sf_dir), "id")
    vocabulary = fit_vocabulary(docs.where("split = 'train'"))
    rows = settle(
        tfidf(docs, vocabulary, keep=("id", "target", "split")), partition_by=["split"]
    )
    model = fit_naive_bayes(rows.where("split = 'train'"), vocabulary)
    scored = with_probability(linear_scores(rows.where("split <> 'train'"), model))
    return settle(as_predictions(scored, "naive_bayes_tfidf"), partition_by=["split"])


def event_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four models' scores from the event values, whole table, without a split.

    score = ln((value + 1) / 51); its sigmoid is (value + 1) / (value + 52), written as that
    division so that every engine gets the same bits.
    """
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    v = F.col("value")
    model = F.concat(F.lit("m"), F.pmod("user_id", F.lit(4)).cast("string"), F.lit("/raw"))
    return events.withColumn("model", model).select(
        "model",
        base_model(F.col("model")).alias("base_model"),
        method(F.col("model")).alias("method"),
        F.col("event_id").alias("id"),
        F.col("event_type").isin("error", "purchase").cast("int").alias("target"),
        F.ln((v + 1.0) / 51.0).alias("score"),
        ((v + 1.0) / (v + 52.0)).alias("prob"),
    )


def event_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event scores with a stratified split, written once, one folder per split."""
    return settle(
        stratified_split(spread(event_scores(spark, sf_dir), "id"), seed=SEED).select(
            "model", "base_model", "method", "split", "id", "target", "score", "prob"
        ),
        partition_by=["split"],
    )


def document_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two models on the labelled documents that judge by text length alone."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "n_chars")
    labels = table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "id")
    sides = F.array(
        F.struct(F.lit("length_quality").alias("base_model"), F.col("quality").alias("target")),
        F.struct(F.lit("length_toxic").alias("base_model"), F.col("toxic").alias("target")),
    )
    size = F.col("n_chars").cast("double")
    return docs.join(labels, "id").select(
        F.explode(sides).alias("_s"), "id", "n_chars"
    ).select(
        F.concat("_s.base_model", F.lit("/raw")).alias("model"),
        "_s.base_model",
        F.lit("raw").alias("method"),
        "id",
        "_s.target",
        F.ln((size + 1.0) / 1500.0).alias("score"),
        ((size + 1.0) / (size + 1501.0)).alias("prob"),
    )
