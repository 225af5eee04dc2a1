"""Named queries over the given tables. Each takes (spark, folder) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trustgauge.functions import scalars, text
from trustgauge.operators import (
    calibrate,
    chartdata,
    conformal,
    errors,
    external,
    features,
    linear,
    metrics,
    mlp,
    phrases,
    svm,
)
from trustgauge.operators.external import external_predictions
from trustgauge.operators.linear import LinearModel, fit_naive_bayes, text_scores
from trustgauge.operators.sampling import (
    bootstrap_multiplicities,
    limit_rows,
    stratified_split,
)
from trustgauge.plans import bindings as b
from trustgauge.plans import experiment
from trustgauge.sources.labelled import load_labelled_csv, load_saved_errors
from trustgauge.sources.sinks import write_table
from trustgauge.sources.workspace import by_key, scratch_path, settle, spread

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values for platt_apply, which checks the formula and not the fit.
PLATT_SLOPE, PLATT_INTERCEPT = 0.75, -0.2


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


# --- text ------------------------------------------------------------------------------------


def labelled_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents written as CSV, with line breaks and quotes, and read back."""
    docs = b.table(spark, sf_dir, "documents").join(b.table(spark, sf_dir, "labels"), "doc_id")
    out = docs.select(
        F.col("doc_id").alias("id"), F.col("source").alias("keyword"), "lang",
        F.concat(F.lit("\n  "), "text", F.lit(" \n")).alias("text"),
        F.col("quality").alias("target"),
    )
    return load_labelled_csv(spark, write_table(out, scratch_path(spark), "labelled", "csv"))


def compose_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.document_texts(spark, sf_dir)


def keyword_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), text.clean_keyword(F.col("source")).alias("keyword")
    )


def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = b.documents(spark, sf_dir).select("id", text.tokens(F.col("text")).alias("t"))
    return cut.select("id", F.size("t").alias("n_tokens"), F.array_join("t", " ").alias("tokens"))


def ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = b.documents(spark, sf_dir).select("id", text.tokens(F.col("text")).alias("t"))
    listed = cut.select("id", text.terms(F.col("t")).alias("g"))
    return listed.select("id", F.size("g").alias("n_terms"), F.array_join("g", "|").alias("terms"))


def raw_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.documents(spark, sf_dir).select(
        "id", text.raw_token_count(F.col("text")).alias("n_tokens")
    )


def keyword_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.document_texts(spark, sf_dir).select(
        "id", text.extract_keyword(F.col("text")).alias("keyword")
    )


def term_doc_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.term_frequencies(features.term_counts(b.documents(spark, sf_dir)))


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(features.fit_vocabulary(b.documents(spark, sf_dir)), 8, "idf")


def vocabulary_unlimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = b.documents(spark, sf_dir)
    return _rounded(features.fit_vocabulary(docs, max_features=0), 8, "idf")


def tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = b.documents(spark, sf_dir)
    rows = features.tfidf(docs, features.fit_vocabulary(docs))
    return _rounded(features.tfidf_long(rows), 8, "w")


def mlp_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = b.documents(spark, sf_dir)
    encoded = features.encode(docs, features.fit_token_vocabulary(docs))
    ids = F.transform("token_ids", lambda i: i.cast("string"))
    return encoded.select("id", F.array_join(ids, " ").alias("token_ids"))


def document_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean vector of each document, the given vectors standing for the most frequent tokens."""
    docs = b.documents_in_place(spark, sf_dir)
    repeats = features.repeated_ids(docs)
    vectors = b.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("idx"), F.col("embedding").alias("vector")
    )
    sizes = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).first()
    tokens = features.fit_token_vocabulary(docs, max_tokens=sizes["n"], repeats=repeats)
    # Tokens are numbered from 0 on: no other vector can be met.
    vectors = vectors.where(F.col("idx") < tokens.count())
    # One row per id, whatever the table holds.
    encoded = features.encode(docs, tokens, repeats=repeats)
    means = mlp.document_embeddings(encoded, vectors, sizes["width"], unique=True)
    return means.select("id", F.posexplode("embedding").alias("dim", "value")).select(
        "id", "dim", F.round("value", 8).alias("value")
    )


# --- sampling --------------------------------------------------------------------------------


def stratified_split_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.split_documents(spark, sf_dir).select("id", "target", "split")


def stratified_split_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stratified_split(
        b.event_scores(spark, sf_dir).select("id", "target"), seed=b.SEED
    ).select("id", "target", "split")


def limited_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return limit_rows(
        b.event_predictions(spark, sf_dir).select("id", "split"), 500, seed=b.SEED
    ).select("id", "split")


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.split_counts(b.event_predictions(spark, sf_dir))


def bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = b.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    drawn = bootstrap_multiplicities(ids, 5, seed=142)
    return drawn.select("id", F.posexplode("multiplicities").alias("member", "multiplicity"))


# --- scalars ---------------------------------------------------------------------------------


def score_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    y, p, s = F.col("target"), F.col("prob"), F.col("score")
    return b.event_scores(spark, sf_dir).select(
        "id",
        F.round(scalars.sigmoid(s), 9).alias("sigmoid"),
        scalars.clip_probability(p).alias("clipped"),
        scalars.predicted_label(p).alias("label"),
        scalars.confidence(p).alias("confidence"),
        scalars.class_probability(p, y).alias("true_class_prob"),
        scalars.nonconformity(y, p).alias("nonconformity"),
        F.round(scalars.log_loss(y, p), 9).alias("log_loss"),
        scalars.smooth_label(y, 0.1).alias("soft_label"),
        scalars.signed_label(y).alias("signed_label"),
        scalars.answered(p, 0.75).alias("answered"),
    )


def variant_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    family = F.concat(F.lit("m"), F.pmod("user_id", F.lit(4)).cast("string"))
    kind = F.col("event_type")
    name = (
        F.when(kind == "click", family)
        .when(kind == "view", F.concat(family, F.lit("/raw")))
        .otherwise(F.concat(family, F.lit("/raw/v2")))
    )
    model = F.col("model")
    return (
        b.table(spark, sf_dir, "events")
        .groupBy(name.alias("model"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "model",
            scalars.base_model(model).alias("base_model"),
            scalars.method(model).alias("method"),
            "n",
        )
    )


def softmax_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One, two and three logits per row, by event type."""
    score = F.ln((F.col("value") + 1.0) / 51.0)
    half, kind = score / 2.0, F.col("event_type")
    logits = (
        F.when(kind == "click", F.array(score))
        .when(kind == "view", F.array(-half, half))
        .otherwise(F.array(-half, half, F.lit(0.25)))
    )
    rows = b.table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), logits.alias("l"))
    return rows.select(
        "id",
        F.round(scalars.logits_score(F.col("l")), 9).alias("score"),
        F.round(scalars.logits_probability(F.col("l")), 9).alias("prob"),
    )


# --- naive Bayes -----------------------------------------------------------------------------


def _trained_naive_bayes(spark: SparkSession, sf_dir: str):
    docs = by_key(b.split_documents(spark, sf_dir).where("split = 'train'"), "id")
    known = features.fit_vocabulary(docs)
    rows = features.tfidf(docs, known, keep=("id", "target"))
    return known, fit_naive_bayes(settle(rows), known)


def nb_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, model = _trained_naive_bayes(spark, sf_dir)
    return _rounded(model.weights, 8, "weight")


def nb_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = b.naive_bayes_predictions(spark, sf_dir)
    return scored.select(
        "id", "split", "target", F.round("score", 7).alias("score"), F.round("prob", 8).alias("prob")
    )


def nb_score_all_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inference: the model trained on labels scores every document."""
    known, model = _trained_naive_bayes(spark, sf_dir)
    scored = text_scores(b.documents(spark, sf_dir), known, model)
    return scored.select("id", F.round("score", 7).alias("score"))


def linear_score_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores and probabilities under weights that follow from the index alone."""
    docs = b.documents(spark, sf_dir)
    known = features.fit_vocabulary(docs)
    weight = (F.pmod(F.col("idx") * 37, F.lit(101)) - 50) / 100.0
    model = LinearModel(known.select("idx", weight.alias("weight")), 0.25, 0)
    scored = text_scores(docs, known, model)
    return scored.select(
        "id", F.round("score", 7).alias("score"),
        F.round(scalars.clip_probability(scalars.sigmoid(F.col("score"))), 8).alias("prob"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TF-IDF rows as MLlib vectors, read back: size, number and sum of the values."""
    docs = b.documents(spark, sf_dir)
    known = features.fit_vocabulary(docs)
    # The vector's own fields: a dense copy has as many numbers as the vocabulary has terms.
    plain = F.unwrap_udt("features")
    rows = features.to_vectors(features.tfidf(docs, known), known.count()).select("id", plain.alias("v"))
    return rows.select(
        "id", F.col("v.size").cast("long").alias("size"),
        F.size(F.filter("v.values", lambda x: x != 0)).cast("long").alias("n_values"),
        F.round(F.aggregate("v.values", F.lit(0.0), lambda s, x: s + x), 8).alias("total"),
    )


def _board(predictions: DataFrame) -> DataFrame:
    return _rounded(
        metrics.leaderboard(predictions), 8,
        "accuracy", "precision", "recall", "f1", "log_loss", "brier_score", "ece",
    )


def nb_leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text to report: naive Bayes, raw and with temperature, evaluated on the test split."""
    predictions = b.naive_bayes_predictions(spark, sf_dir)
    temperatures = calibrate.fit_temperature(predictions.where("split = 'calibration'"))
    test = predictions.where("split = 'test'")
    scaled = calibrate.apply_temperature(test, temperatures).withColumn(
        "model", F.concat_ws("/", "base_model", F.lit(calibrate.TEMPERATURE))
    )
    return _board(test.unionByName(scaled))


# --- calibrators -----------------------------------------------------------------------------


def _calibration(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    predictions = b.event_predictions(spark, sf_dir)
    return predictions.where("split = 'calibration'"), predictions.where("split = 'test'")


def temperature_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = _calibration(spark, sf_dir)
    return _rounded(_rounded(calibrate.temperature_losses(rows), 9, "temperature"), 8, "loss")


def temperature_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = _calibration(spark, sf_dir)
    return _rounded(calibrate.fit_temperature(rows), 9, "temperature")


def temperature_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, test = _calibration(spark, sf_dir)
    scaled = calibrate.apply_temperature(test, calibrate.fit_temperature(rows))
    return scaled.select("model", "id", F.round("prob", 9).alias("prob"))


def platt_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    prob = calibrate.platt_probability(
        F.col("score"), F.lit(PLATT_SLOPE), F.lit(PLATT_INTERCEPT)
    )
    return b.event_scores(spark, sf_dir).select("model", "id", F.round(prob, 9).alias("prob"))


def platt_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = _calibration(spark, sf_dir)
    return _rounded(calibrate.fit_platt(rows), 8, "slope", "intercept")


def isotonic_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = _calibration(spark, sf_dir)
    return calibrate.isotonic_blocks(rows).select("model", "lo", "hi", "last", "value")


def isotonic_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, test = _calibration(spark, sf_dir)
    return calibrate.apply_isotonic(test, calibrate.isotonic_blocks(rows)).select(
        "model", "id", "prob"
    )


def _family(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, test = _calibration(spark, sf_dir)
    return calibrate.calibrated_family(
        test, calibrate.fit_temperature(rows), calibrate.isotonic_blocks(rows)
    )


def calibrated_family_platt(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, test = _calibration(spark, sf_dir)
    family = calibrate.calibrated_family(
        test, calibrate.fit_temperature(rows), calibrate.isotonic_blocks(rows),
        calibrate.fit_platt(rows),
    )
    return family.where(F.col("method") == calibrate.PLATT).select(
        "model", "base_model", "method", "split", "id", "target", F.round("prob", 8).alias("prob")
    )


def calibrated_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _family(spark, sf_dir).select(
        "model", "base_model", "method", "split", "id", "target", F.round("prob", 9).alias("prob")
    )


def saved_errors_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with blanks and line breaks at both ends, written as saved errors and read back."""
    docs = b.table(spark, sf_dir, "documents")
    text = F.concat(F.lit("  "), "text", F.lit(' "q", \n '))
    out = docs.select(
        F.col("source").alias("model"), text.alias("text"), F.lit(0).alias("true_label"),
        F.lit(1).alias("predicted_label"), F.lit(0.5).alias("confidence"),
        F.lit(0.5).alias("prob_positive"), F.col("doc_id").cast("string").alias("keyword"),
    )
    return load_saved_errors(spark, write_table(out, scratch_path(spark), "saved", "csv"))


def metric_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics written as CSV in their fixed column order and read back."""
    board = metrics.leaderboard(b.event_scores(spark, sf_dir))
    path = write_table(board, scratch_path(spark), "metrics_summary", "csv")
    read = spark.read.csv(path, header=True)
    numbers = [c for c in read.columns if c not in ("model", "base_model", "method")]
    counts = {"tn", "fp", "fn", "tp"}
    return read.select(
        "model", "base_model", "method",
        *[
            F.col(c).cast("long").alias(c) if c in counts else F.round(F.col(c).cast("double"), 8).alias(c)
            for c in numbers
        ],
    )


# --- evaluation ------------------------------------------------------------------------------


def classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(
        metrics.classification_metrics(b.event_scores(spark, sf_dir)), 8,
        "accuracy", "precision", "recall", "f1", "log_loss", "brier_score",
    )


def reliability_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(
        metrics.reliability_bins(b.event_scores(spark, sf_dir)), 8, "mean_confidence", "accuracy"
    )


def ece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.expected_calibration_error(b.event_scores(spark, sf_dir)), 8, "ece")


def rejection_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(
        metrics.rejection_curve(b.event_scores(spark, sf_dir)), 8, "coverage", "selective_accuracy"
    )


def leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _board(_family(spark, sf_dir))


def best_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = metrics.best_variant(metrics.leaderboard(_family(spark, sf_dir)))
    return _rounded(best.select("model", "ece", "log_loss"), 8, "ece", "log_loss")


def family_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.family_order(metrics.leaderboard(_family(spark, sf_dir)))


# --- conformal -------------------------------------------------------------------------------


def conformal_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = _calibration(spark, sf_dir)
    return conformal.conformal_quantiles(rows)


def conformal_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, test = _calibration(spark, sf_dir)
    return conformal.prediction_sets(test, conformal.conformal_quantiles(rows)).select(
        "model", "alpha", "id", "include_0", "include_1", "set_size", "contains_true",
        "is_singleton", "is_empty", "is_ambiguous",
    )


def _conformal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw scores next to a recalibrated copy, which must not take part."""
    def mixed(rows: DataFrame) -> DataFrame:
        copy = rows.withColumns(
            {"method": F.lit(calibrate.ISOTONIC), "model": F.concat("base_model", F.lit("/again"))}
        )
        return conformal.conformal_candidates(rows.unionByName(copy))

    rows, test = _calibration(spark, sf_dir)
    return conformal.evaluate_conformal(mixed(rows), mixed(test))


def conformal_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(
        _conformal(spark, sf_dir), 8,
        "empirical_coverage", "avg_set_size", "singleton_rate", "ambiguous_rate", "empty_rate",
        "singleton_accuracy",
    )


# --- errors ----------------------------------------------------------------------------------


def high_confidence_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return errors.high_confidence_errors(
        b.document_predictions(spark, sf_dir), b.document_texts(spark, sf_dir)
    )


def error_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every labelled document as if the model had said the opposite."""
    labels = b.table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), F.col("quality").alias("target")
    )
    rows = b.document_texts(spark, sf_dir).join(labels, "id")
    flipped = rows.withColumn("predicted", 1 - F.col("target"))
    return errors.with_category(flipped, "target", "predicted").select("id", "category")


def _phrase_table(docs: DataFrame) -> DataFrame:
    """10 000 phrases: terms of the documents, dealt to the named lists and to others by their place."""
    known = features.fit_vocabulary(docs).where("idx >= 5000")
    place = F.pmod("idx", F.lit(240))
    name = F.concat(F.lit("list"), F.pmod("idx", F.lit(40)).cast("string"))
    for k, own in enumerate(("real_event", "news", "metaphor", "commerce", "fiction", "false_alarm")):
        name = F.when(place == k, own).otherwise(name)
    return known.select(name.alias("rule_set"), F.col("term").alias("phrase"))


def error_categories_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Categories under a table of 10 000 phrases, and the lists that each text meets."""
    docs = b.documents(spark, sf_dir)
    rules_ = settle(_phrase_table(docs))
    labels = b.table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), F.col("quality").alias("target")
    )
    flipped = docs.join(labels, "id").withColumn("predicted", 1 - F.col("target"))
    rows = phrases.phrase_hits(errors.with_category_by_rules(flipped, "target", "predicted", rules_), rules_)
    return rows.select("id", "category", F.array_join("hits", ",").alias("hits"))


def _errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return errors.error_analysis(
        b.document_predictions(spark, sf_dir), b.document_texts(spark, sf_dir)
    )


def error_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _errors(spark, sf_dir)


def error_category_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(
        errors.error_category_summary(_errors(spark, sf_dir)), 8, "mean_confidence"
    )


def error_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return errors.error_examples(_errors(spark, sf_dir))


def recategorize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors saved as CSV, read back, categorised again and summarised."""
    path = write_table(
        _errors(spark, sf_dir), scratch_path(spark), "high_confidence_errors", "csv"
    )
    saved = load_saved_errors(spark, path)
    return _rounded(
        errors.error_category_summary(errors.recategorize(saved)), 8, "mean_confidence"
    )


# --- chart tables ----------------------------------------------------------------------------


def reliability_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    bins = metrics.reliability_bins(b.event_scores(spark, sf_dir))
    return _rounded(chartdata.reliability_series(bins), 8, "mean_confidence", "accuracy")


def rejection_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = metrics.rejection_curve(b.event_scores(spark, sf_dir))
    return _rounded(chartdata.rejection_series(curve), 8, "coverage", "selective_accuracy")


def threshold_panels(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = settle(metrics.rejection_curve(b.event_scores(spark, sf_dir)))
    return _rounded(chartdata.threshold_panels(curve), 8, "value")


def confusion_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = settle(metrics.classification_metrics(b.event_scores(spark, sf_dir)))
    return _rounded(chartdata.confusion_cells(counts), 8, "intensity")


def conformal_panels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(chartdata.conformal_panels(_conformal(spark, sf_dir)), 8, "value")


def category_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = settle(errors.error_category_summary(_errors(spark, sf_dir)))
    models = ["length_quality/raw", "length_toxic/raw"]
    return chartdata.category_matrix(summary, models).withColumnsRenamed(
        {m: scalars.model_slug(m).removesuffix("_raw") for m in models}
    )


# --- trained models and whole jobs -----------------------------------------------------------


def _outside_net():
    """Stands for a user's model: two logits of 64 numbers, by weights that follow from their place."""
    k = np.arange(64)
    weights = np.stack([((k * 7) % 11 - 5) / 11.0, ((k * 5) % 13 - 6) / 13.0], axis=1)
    return lambda inputs: inputs @ weights


def external_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's function scores every vector inside the job."""
    given = b.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("inputs"))
    logits = settle(external.score_batches(given, _outside_net, 64).select("id", "logits"))
    truth = given.select("id", (F.pmod("id", F.lit(3)) == 0).cast("int").alias("target"), F.lit("test").alias("split"))
    scored = external.external_predictions(truth, logits, "outside-net")
    return scored.select("id", "model", "target", F.round("score", 7).alias("score"), F.round("prob", 8).alias("prob"))


def external_experiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logits of a model run elsewhere, calibrated and evaluated like our own."""
    events = spread(b.table(spark, sf_dir, "events"), "event_id")
    half = F.ln((F.col("value") + 1.0) / 51.0) / 2.0
    target = F.col("event_type").isin("error", "purchase").cast("int")
    truth = stratified_split(
        events.select(F.col("event_id").alias("id"), target.alias("target")), seed=b.SEED
    )
    logits = events.select(
        F.col("event_id").alias("id"), F.array(-half, half).alias("logits")
    )
    predictions = external_predictions(truth, logits, "vendor/model")
    tables = experiment.evaluate_external(predictions)
    return _rounded(
        tables["metrics_summary"], 8,
        "accuracy", "precision", "recall", "f1", "log_loss", "brier_score", "ece",
    )


def ensemble_vocabularies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vocabulary of each of five bootstrap samples of the train split."""
    _, _, known = _samples(spark, sf_dir)
    parts = [v.withColumn("member", F.lit(m)) for m, v in enumerate(known)]
    return _rounded(reduce(DataFrame.unionByName, parts), 8, "idf")


def _trained(part: str) -> Query:
    """Test-split metrics of one trained model family."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        features_once = experiment.prepare(b.split_documents(spark, sf_dir))
        predictions = experiment.FAMILIES[part](features_once, experiment.Settings())
        return _board(predictions.where("split = 'test'"))

    return query


# Enough steps for the optimiser to stop by itself, and how flat the loss must then be.
LONG_FIT, FLAT = 500, 1e-3


def _stationarity(name: str, smoothing: float) -> Query:
    """Is the fitted logistic regression a minimum: does its gradient vanish?"""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepared = experiment.prepare(b.split_documents(spark, sf_dir))
        penalty = linear.LOGISTIC["reg_param"]
        if smoothing:
            model = linear.fit_smoothed_logistic(prepared.train_vectors, smoothing, LONG_FIT, penalty)
        else:
            model = linear.fit_logistic(prepared.train_vectors, LONG_FIT, penalty)
        scored = linear.linear_scores(prepared.rows.where("split = 'train'"), model)
        wanted = scalars.smooth_label(F.col("target").cast("double"), smoothing)
        errors_ = settle(
            scored.select("features", (scalars.sigmoid(F.col("score")) - wanted).alias("error"))
        )
        n = F.lit(errors_.count())
        slopes = (
            errors_.select("error", F.inline("features"))
            .groupBy("idx")
            .agg(F.sum(F.col("error") * F.col("w")).alias("sum"))
        )
        steep = model.weights.join(slopes, "idx", "left").select(
            F.abs(F.coalesce("sum", F.lit(0.0)) / n + penalty * F.col("weight")).alias("slope")
        )
        level = errors_.select(F.avg("error").alias("slope")).select(F.abs("slope").alias("slope"))
        return steep.unionByName(level).agg(
            F.lit(name).alias("model"), (F.max("slope") < FLAT).alias("stationary")
        ).select("model", "stationary")

    return query


def _dual_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = by_key(b.split_documents(spark, sf_dir).where("split = 'train'"), "id")
    known = features.fit_vocabulary(docs)
    return known, settle(features.tfidf(docs, known, keep=("id", "target")))


def svm_objective_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Primal, dual and gap of the SVM at dual values that follow from the id alone."""
    _, rows = _dual_rows(spark, sf_dir)
    found = svm.objective(rows.withColumn("a", F.pmod(F.col("id") * 37, F.lit(101)) / 100.0))
    return _rounded(found, 7, "primal", "dual", "gap")


def svm_duality_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fit is proved by its gap: primal and dual, computed anew from the stored dual values."""
    known, rows = _dual_rows(spark, sf_dir)
    done = svm.fit(rows, known.count(), finish=True)
    anew = svm.objective(rows.join(done.duals, "id"))
    same = (F.abs(F.col("primal") - done.primal) < 1e-6) & (F.abs(F.col("dual") - done.dual) < 1e-6)
    return anew.select(
        "n", (F.col("gap") <= svm.GAP + 1e-6).alias("closed"), same.alias("stored_duals_agree"),
        ((F.col("dual") > 0) & (F.col("primal") < 1)).alias("better_than_nothing"),
    )


# Width of the network whose weights follow from their place, and the most tokens it knows.
FIXED_DIM, FIXED_HIDDEN, FIXED_TOKENS = 6, 5, 10_000


def _place(i: Column, j: Column, a: int, b: int, m: int) -> Column:
    """A weight that follows from its place alone."""
    return (F.pmod(i * a + j * b, F.lit(m)) - m // 2) / float(m)


def _fixed_network(spark: SparkSession, size: int) -> tuple[DataFrame, DataFrame]:
    dims = F.sequence(F.lit(0), F.lit(FIXED_DIM - 1))
    i = F.col("id").cast("int")
    vectors = spark.range(size).select(
        i.alias("idx"), F.transform(dims, lambda k: _place(F.col("id"), k, 7, 13, 101)).alias("vector")
    )
    inner = spark.range(FIXED_HIDDEN).select(
        F.lit(0).alias("layer"), i.alias("unit"),
        F.transform(dims, lambda k: _place(k, F.col("id"), 31, 17, 41)).alias("weights"),
        _place(F.col("id"), F.lit(0), 5, 0, 23).alias("bias"),
    )
    outer = F.transform(F.sequence(F.lit(0), F.lit(FIXED_HIDDEN - 1)), lambda k: _place(k, F.lit(1), 11, 3, 19))
    last = spark.range(1).select(F.lit(1).alias("layer"), i.alias("unit"), outer.alias("weights"), F.lit(0.125).alias("bias"))
    return vectors, inner.unionByName(last)


def mlp_score_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forward pass of a network over all documents, as joins and sums over its weight tables."""
    docs = b.documents(spark, sf_dir)
    tokens = features.fit_token_vocabulary(docs, max_tokens=FIXED_TOKENS)
    vectors, layers = _fixed_network(spark, tokens.count())
    scored = mlp.forward(features.encode(docs, tokens), vectors, layers, FIXED_DIM)
    return scored.select(
        "id", F.round("score", 8).alias("score"),
        F.round(scalars.clip_probability(scalars.sigmoid(F.col("score"))), 8).alias("prob"),
    )


def mlp_gradient(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One backward pass over the train split: the summed gradient of every parameter."""
    docs = by_key(b.split_documents(spark, sf_dir).where("split = 'train'"), "id")
    tokens = features.fit_token_vocabulary(docs, max_tokens=FIXED_TOKENS)
    size = tokens.count()
    encoded = settle(features.encode(docs, tokens, ("id", "target")))
    vectors, layers = _fixed_network(spark, size)
    units = layers.orderBy("layer", "unit").collect()
    w1 = np.array([r["weights"] for r in units[:-1]]).T
    flat = np.zeros(mlp._layer_rows(FIXED_DIM, FIXED_HIDDEN) * FIXED_DIM)
    whole = [*w1.reshape(-1), *[r["bias"] for r in units[:-1]], *units[-1]["weights"], units[-1]["bias"]]
    flat[: len(whole)] = whole
    embeddings = np.array([r["vector"] for r in vectors.orderBy("idx").collect()]).reshape(-1, FIXED_DIM)
    model = mlp.MlpModel(np.vstack([embeddings, flat.reshape(-1, FIXED_DIM)]), size, FIXED_HIDDEN)
    # A rounded sum may be -0.0.
    return mlp.gradient_rows(encoded, model).withColumn("value", F.round("value", 6) + 0.0)


def _samples(spark: SparkSession, sf_dir: str):
    train = by_key(b.split_documents(spark, sf_dir).where("split = 'train'"), "id")
    drawn = settle(bootstrap_multiplicities(train.select("id"), 5, seed=142))
    return train, drawn, linear.member_vocabularies(train, drawn, 5)


def ensemble_stationarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Does the gradient of every member vanish on its sample? Summed anew, without Python."""
    train, drawn, known = _samples(spark, sf_dir)
    docs = train.select("id", "target", "text")
    penalty = linear.ENSEMBLE["reg_param"]
    rows = linear.sample_rows(docs, drawn, known)
    members = linear.fit_rows(rows, known, LONG_FIT, penalty)
    mass = rows.groupBy("member").agg(F.sum("times").alias("mass"))
    found = []
    for m, member in enumerate(members):
        scored = linear.linear_scores(rows.where(F.col("member") == m), member.model)
        error = F.col("times") * (scalars.sigmoid(F.col("score")) - F.col("target"))
        cells = scored.select(F.lit(m).alias("member"), error.alias("error"), F.inline("features"))
        slopes = cells.groupBy("idx").agg(F.sum(F.col("error") * F.col("w")).alias("sum"))
        steep = member.model.weights.join(slopes, "idx", "left").select(
            F.lit(m).alias("member"), F.coalesce("sum", F.lit(0.0)).alias("sum"), (penalty * F.col("weight")).alias("pull")
        )
        level = scored.agg(F.sum(error).alias("sum")).select(F.lit(m).alias("member"), "sum", F.lit(0.0).alias("pull"))
        found.append(steep.unionByName(level))
    slope = F.abs(F.col("sum") / F.col("mass") + F.col("pull"))
    return reduce(DataFrame.unionByName, found).join(mass, "member").groupBy("member").agg(
        (F.max(slope) < FLAT).alias("stationary")
    )


def ensemble_mean_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean probability of five members under weights that follow from index and member."""
    _, _, known = _samples(spark, sf_dir)
    members = []
    for m, v in enumerate(known):
        weight = (F.pmod(F.col("idx") * (37 + m), F.lit(101)) - 50) / 100.0
        members.append(
            linear.EnsembleMember(v, LinearModel(settle(v.select("idx", weight.alias("weight"))), 0.1 * m - 0.2, v.count()))
        )
    held_out = by_key(b.split_documents(spark, sf_dir).where("split <> 'train'"), "id")
    scored = linear.ensemble_scores(held_out, members)
    return scored.select(
        "id", F.round("prob", 8).alias("prob"), F.round(F.array_min("member_probs"), 8).alias("least"),
        F.round(F.array_max("member_probs"), 8).alias("most"),
    )


def training_beats_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For fits without a smooth optimum: is the training loss below that of a constant?"""
    prepared = experiment.prepare(b.split_documents(spark, sf_dir))
    settings = experiment.Settings()
    train = "split = 'train'"
    one = F.avg(F.col("target").cast("double"))
    entropy = -(one * F.log(one) + (1.0 - one) * F.log(1.0 - one))
    chance = F.coalesce(F.when((one > 0) & (one < 1), entropy), F.lit(0.0))
    log_loss = F.avg(scalars.log_loss(F.col("target"), F.col("prob")))

    rows = prepared.rows.where(train)
    margins = linear.linear_scores(rows, svm.fit(rows, prepared.vocabulary.count()).model)
    hinge = F.avg(F.greatest(F.lit(0.0), 1.0 - scalars.signed_label(F.col("target")) * F.col("score")))
    found = [margins.agg((hinge < 2.0 * F.least(one, 1.0 - one)).alias("better"), F.lit("linear_svm_tfidf").alias("model"))]

    docs = by_key(prepared.docs.where(train), "id")
    members = linear.fit_ensemble(
        docs.select("id", "target", "text"), settings.ensemble_size, settings.min_df, settings.max_features,
        ngram_range=settings.ngram_range, seed=settings.seed,
    )
    mean = linear.ensemble_scores(docs, members, settings.ngram_range, experiment.KEEP)
    found.append(mean.agg((log_loss < chance).alias("better"), F.lit("bootstrap_ensemble").alias("model")))

    tokens = features.fit_token_vocabulary(docs, settings.min_df)
    encoded = settle(features.encode(docs, tokens, experiment.KEEP))
    network = mlp.fit_mlp(encoded, tokens.count(), settings.mlp)
    scored = linear.with_probability(mlp.mlp_scores(encoded, network))
    found.append(scored.agg((log_loss < chance).alias("better"), F.lit("embedding_mlp").alias("model")))
    return reduce(DataFrame.unionByName, found).select("model", "better")


def main_experiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole main job; its best-first table of all variants."""
    tables = experiment.run_experiment(b.split_documents(spark, sf_dir))
    return _rounded(
        tables["metrics_summary"], 8,
        "accuracy", "precision", "recall", "f1", "log_loss", "brier_score", "ece",
    )


def registry() -> dict[str, Query]:
    return {
        "labelled_csv": labelled_csv,
        "compose_text": compose_text,
        "keyword_clean": keyword_clean,
        "tokenize": tokenize,
        "ngrams": ngrams,
        "raw_token_count": raw_token_count,
        "keyword_extract": keyword_extract,
        "term_doc_frequency": term_doc_frequency,
        "vocabulary": vocabulary,
        "vocabulary_unlimited": vocabulary_unlimited,
        "tfidf": tfidf,
        "mlp_encode": mlp_encode,
        "document_embeddings": document_embeddings,
        "ensemble_vocabularies": ensemble_vocabularies,
        "stratified_split": stratified_split_documents,
        "stratified_split_events": stratified_split_events,
        "limit_rows": limited_rows,
        "split_counts": split_counts,
        "bootstrap_multiplicities": bootstrap,
        "score_scalars": score_scalars,
        "variant_names": variant_names,
        "softmax_scores": softmax_scores,
        "nb_fit": nb_fit,
        "nb_score": nb_score,
        "nb_score_all_documents": nb_score_all_documents,
        "linear_score_fixed": linear_score_fixed,
        "vectors": vectors,
        "nb_leaderboard": nb_leaderboard,
        "saved_errors_roundtrip": saved_errors_roundtrip,
        "metric_sink": metric_sink,
        "temperature_losses": temperature_losses,
        "temperature_fit": temperature_fit,
        "temperature_apply": temperature_apply,
        "platt_fit": platt_fit,
        "platt_apply": platt_apply,
        "isotonic_fit": isotonic_fit,
        "isotonic_apply": isotonic_apply,
        "calibrated_family": calibrated_family,
        "calibrated_family_platt": calibrated_family_platt,
        "classification_metrics": classification_metrics,
        "reliability_bins": reliability_bins,
        "ece": ece,
        "rejection_curve": rejection_curve,
        "leaderboard": leaderboard,
        "best_variant": best_variant,
        "family_order": family_order,
        "conformal_quantile": conformal_quantile,
        "conformal_sets": conformal_sets,
        "conformal_eval": conformal_eval,
        "high_confidence_errors": high_confidence_errors,
        "error_categories": error_categories,
        "error_categories_rules": error_categories_rules,
        "error_analysis": error_analysis,
        "error_category_summary": error_category_summary,
        "error_examples": error_examples,
        "recategorize": recategorize,
        "reliability_series": reliability_series,
        "rejection_series": rejection_series,
        "threshold_panels": threshold_panels,
        "confusion_cells": confusion_cells,
        "conformal_panels": conformal_panels,
        "category_matrix": category_matrix,
        "external_experiment": external_experiment,
        "external_scoring": external_scoring,
        "logistic_stationarity": _stationarity("logreg_tfidf", 0.0),
        "smoothing_stationarity": _stationarity("label_smoothing", linear.SMOOTHING),
        "svm_objective_fixed": svm_objective_fixed,
        "svm_duality_gap": svm_duality_gap,
        "mlp_score_fixed": mlp_score_fixed,
        "mlp_gradient": mlp_gradient,
        "ensemble_stationarity": ensemble_stationarity,
        "ensemble_mean_fixed": ensemble_mean_fixed,
        "training_beats_constant": training_beats_constant,
        # No SQL for these: iterative fits and the job that holds them.
        "logistic": _trained("logreg_tfidf"),
        "label_smoothing": _trained("label_smoothing"),
        "linear_svm": _trained("linear_svm_tfidf"),
        "bootstrap_ensemble": _trained("bootstrap_ensemble"),
        "embedding_mlp": _trained("embedding_mlp"),
        "main_experiment": main_experiment,
    }
