"""Linear text models: naive Bayes in closed form, logistic regression, bootstrap ensemble.

A fitted model is a :class:`LinearModel`: a settled table (idx, weight) and an intercept.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustgauge.functions.scalars import sigmoid, smooth_label
from trustgauge.operators.features import (
    MAX_FEATURES,
    MIN_DF,
    NGRAMS,
    carried,
    gathered,
    member_frequencies,
    occurrences,
    select_vocabulary,
    shared,
    shared_terms,
    to_vectors,
    weighted_rows,
)
from trustgauge.operators.joint import fit_many
from trustgauge.operators.parallel import side_by_side
from trustgauge.operators.sampling import bootstrap_multiplicities
from trustgauge.sources.workspace import by_key, settle

# Weights travel to the tasks as one array up to this many features (16 MB of doubles).
DENSE_WEIGHTS = 2_000_000

# Defaults of the fits. A few passes with a small penalty stand for the short training that
# keeps a linear text model from growing over-confident on separable text.
LOGISTIC = {"max_iter": 45, "reg_param": 1e-3}
ENSEMBLE = {"max_iter": 33, "reg_param": 1e-3}
SMOOTHING = 0.10


@dataclass(frozen=True)
class LinearModel:
    weights: DataFrame
    intercept: float
    size: int


def fit_naive_bayes(
    rows: DataFrame, vocabulary: DataFrame, alpha: float = 1.0, target_col: str = "target"
) -> LinearModel:
    """Multinomial naive Bayes over TF-IDF weights, as log-odds per feature.

    ``rows`` holds target and features. One pass sums the weights per feature and class.
    """
    is_one = F.col(target_col) == 1
    sums = (
        rows.select(target_col, F.inline("features"))
        .groupBy("idx")
        .agg(
            F.sum(F.when(is_one, F.col("w")).otherwise(0.0)).alias("s1"),
            F.sum(F.when(is_one, 0.0).otherwise(F.col("w"))).alias("s0"),
        )
    )
    sums = settle(
        vocabulary.select("idx")
        .join(sums, "idx", "left")
        .select("idx", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("s1", "s0")])
    )
    totals = sums.agg(
        F.count(F.lit(1)).alias("size"),
        F.coalesce(F.sum("s1"), F.lit(0.0)).alias("t1"),
        F.coalesce(F.sum("s0"), F.lit(0.0)).alias("t0"),
    ).first()
    classes = rows.agg(
        F.count_if(is_one).alias("n1"), F.count_if(~is_one).alias("n0")
    ).select(
        (F.ln(F.col("n1") + F.lit(alpha)) - F.ln(F.col("n0") + F.lit(alpha))).alias("prior")
    ).first()
    mass1 = F.lit(totals["t1"] + alpha * totals["size"])
    mass0 = F.lit(totals["t0"] + alpha * totals["size"])
    weight = F.ln((F.col("s1") + alpha) / mass1) - F.ln((F.col("s0") + alpha) / mass0)
    return LinearModel(
        sums.select("idx", weight.alias("weight")), classes["prior"], totals["size"]
    )


def linear_scores(rows: DataFrame, model: LinearModel, id_col: str = "id") -> DataFrame:
    """Add ``score`` = intercept + sum of weight * w to TF-IDF rows.

    Within DENSE_WEIGHTS the weights are one array by position and scoring is a projection.
    Beyond it the features are joined with the weight table and summed per id.
    """
    if model.size <= DENSE_WEIGHTS:
        ordered = F.sort_array(F.collect_list(F.struct("idx", "weight")))
        dense = model.weights.agg(F.transform(ordered, lambda cell: cell.weight)).scalar()
        return rows.withColumn("_weights", dense).withColumn(
            "score",
            F.aggregate(
                "features",
                F.lit(model.intercept),
                lambda total, cell: total + cell.w * F.get(F.col("_weights"), cell.idx),
            ),
        ).drop("_weights")
    parts = rows.select(id_col, F.inline_outer("features")).join(model.weights, "idx", "left")
    sums = parts.groupBy(id_col).agg(F.sum(F.col("w") * F.col("weight")).alias("_sum"))
    return rows.join(sums, id_col).withColumn(
        "score", F.lit(model.intercept) + F.coalesce("_sum", F.lit(0.0))
    ).drop("_sum")


def text_scores(
    docs: DataFrame,
    vocabulary: DataFrame,
    model: LinearModel,
    ngram_range: tuple[int, int] = NGRAMS,
    keep: tuple[str, ...] = ("id",),
) -> DataFrame:
    """Score documents straight from their text: (keep..., score).

    The weights travel with the vocabulary, so a term finds both in one lookup and a document
    is two sums: that of weight times tf-idf over the length of its tf-idf vector. No array of
    weights or features is built, whatever the size of the vocabulary.
    """
    keys = list(keep)
    known = settle(vocabulary.select("term", "idx", "idf").join(model.weights, "idx"))
    met = occurrences(docs, keys, ngram_range).join(shared_terms(known), "term", "left")
    counted = met.groupBy(*keys, "idx", "idf", "weight").agg(F.count(F.lit(1)).alias("_c"))
    w = F.when(
        F.col("idx").isNotNull(),
        (F.lit(1.0) + F.ln(F.col("_c").cast("double"))) * F.col("idf"),
    )
    sums = counted.withColumn("_w", w).groupBy(*keys).agg(
        F.sum(F.col("_w") * F.col("weight")).alias("_dot"),
        F.sqrt(F.sum(F.col("_w") * F.col("_w"))).alias("_norm"),
    )
    score = F.coalesce(F.try_divide(F.col("_dot"), F.col("_norm")), F.lit(0.0))
    return sums.select(*keys, (F.lit(model.intercept) + score).alias("score"))


def _weight_table(spark, coefficients) -> DataFrame:
    """Fitted coefficients as (idx, weight), at most DENSE_WEIGHTS of them."""
    values = coefficients.toArray()
    return settle(
        spark.createDataFrame(
            [(i, float(v)) for i, v in enumerate(values)], "idx int, weight double"
        )
    )


def fit_logistic(
    vectors: DataFrame,
    max_iter: int = LOGISTIC["max_iter"],
    reg_param: float = LOGISTIC["reg_param"],
    target_col: str = "target",
    weight_col: str | None = None,
) -> LinearModel:
    estimator = LogisticRegression(
        labelCol=target_col,
        featuresCol="features",
        maxIter=max_iter,
        regParam=reg_param,
        elasticNetParam=0.0,
        standardization=False,
        family="binomial",
    )
    if weight_col:
        estimator = estimator.setWeightCol(weight_col)
    head = vectors.select("features").first()
    if head and head["features"].size > DENSE_WEIGHTS:
        raise ValueError(f"weights of {head['features'].size} features exceed {DENSE_WEIGHTS}; limit the vocabulary")
    fitted = estimator.fit(vectors)
    return LinearModel(
        _weight_table(vectors.sparkSession, fitted.coefficients),
        float(fitted.intercept),
        len(fitted.coefficients),
    )


def fit_smoothed_logistic(
    vectors: DataFrame,
    smoothing: float = SMOOTHING,
    max_iter: int = LOGISTIC["max_iter"],
    reg_param: float = LOGISTIC["reg_param"],
    target_col: str = "target",
) -> LinearModel:
    """Logistic regression on soft labels: each row counts as both classes, in part."""
    soft = smooth_label(F.col(target_col).cast("double"), smoothing)
    both = vectors.select(
        "features",
        F.explode(
            F.array(
                F.struct(F.lit(1).alias("target"), soft.alias("_share")),
                F.struct(F.lit(0).alias("target"), (F.lit(1.0) - soft).alias("_share")),
            )
        ).alias("_side"),
    ).select("features", "_side.target", "_side._share")
    return fit_logistic(both, max_iter, reg_param, "target", "_share")


def with_probability(scored: DataFrame) -> DataFrame:
    return scored.withColumn("prob", sigmoid(F.col("score")))


@dataclass(frozen=True)
class EnsembleMember:
    vocabulary: DataFrame
    model: LinearModel


def member_vocabularies(
    docs: DataFrame,
    drawn: DataFrame,
    members: int,
    min_df: int = MIN_DF,
    max_features: int = MAX_FEATURES,
    ngram_range: tuple[int, int] = NGRAMS,
) -> list[DataFrame]:
    """Vocabulary of every bootstrap sample; a document drawn twice counts as two.

    Text is cut into terms once: a task sums the term and document counts of all members side by
    side, and one grouping by term adds them up.
    """
    found = gathered(docs, ["id"]).join(by_key(drawn, "id"), "id")
    frequencies = settle(member_frequencies(found.withColumnRenamed("multiplicities", "times"), members, ngram_range))
    n_docs = F.lit(drawn.count())

    def select_member(m: int) -> DataFrame:
        mine = frequencies.select(
            "term", F.col(f"tf{m}").alias("tf"), F.col(f"df{m}").alias("df")
        ).where("df > 0")
        return settle(select_vocabulary(mine, n_docs, min_df, max_features))

    return side_by_side(docs.sparkSession, select_member, range(members))


def fit_ensemble(
    train: DataFrame,
    members: int = 5,
    min_df: int = MIN_DF,
    max_features: int = MAX_FEATURES,
    max_iter: int = ENSEMBLE["max_iter"],
    reg_param: float = ENSEMBLE["reg_param"],
    ngram_range: tuple[int, int] = NGRAMS,
    seed: int = 142,
) -> list[EnsembleMember]:
    """Logistic regressions on bootstrap samples, each with its own vocabulary.

    A sample is a column of multiplicities, used as row weights.
    """
    drawn = settle(bootstrap_multiplicities(train, members, seed=seed))
    docs = by_key(train, "id")
    vocabularies = member_vocabularies(docs, drawn, members, min_df, max_features, ngram_range)
    return fit_members(docs, drawn, vocabularies, max_iter, reg_param, ngram_range)


def fit_members(
    docs: DataFrame,
    drawn: DataFrame,
    vocabularies: Sequence[DataFrame],
    max_iter: int = ENSEMBLE["max_iter"],
    reg_param: float = ENSEMBLE["reg_param"],
    ngram_range: tuple[int, int] = NGRAMS,
) -> list[EnsembleMember]:
    """All members in one optimiser over the rows that ``sample_rows`` writes once."""
    return fit_rows(sample_rows(docs, drawn, vocabularies, ngram_range), vocabularies, max_iter, reg_param)


def fit_rows(
    rows: DataFrame, vocabularies: Sequence[DataFrame], max_iter: int, reg_param: float
) -> list[EnsembleMember]:
    """All members in one optimiser over the rows of ``sample_rows``."""
    sizes = [v.count() for v in vocabularies]
    fits = fit_many(rows, sizes, max_iter, reg_param)
    return [
        EnsembleMember(v, LinearModel(weights, intercept, size))
        for v, size, (weights, intercept) in zip(vocabularies, sizes, fits, strict=True)
    ]


def sample_rows(
    docs: DataFrame, drawn: DataFrame, vocabularies: Sequence[DataFrame], ngram_range: tuple[int, int] = NGRAMS
) -> DataFrame:
    """Every draw of every member, with how often: (id, target, member, times, features)."""
    rows = ensemble_rows(docs, vocabularies, ngram_range, ("id", "target"))
    times = F.get("multiplicities", F.col("member"))
    return settle(
        rows.join(by_key(drawn, "id"), "id").withColumn("times", times).where("times > 0").drop("multiplicities"),
        partition_by=["member"],
    )


def ensemble_rows(
    docs: DataFrame,
    vocabularies: Sequence[DataFrame],
    ngram_range: tuple[int, int] = NGRAMS,
    keep: tuple[str, ...] = ("id",),
) -> DataFrame:
    """TF-IDF rows of every document under every vocabulary: (..., member, features).

    The text is cut and counted once, against the terms of all vocabularies; each counted term
    then stands for its entries in the vocabularies that hold it.
    """
    tables = carried(vocabularies)
    if tables is not None:
        return weighted_rows(docs, tables, ngram_range, keep)
    keys = list(keep)
    entries = reduce(
        DataFrame.unionByName,
        [
            v.select("term", F.lit(m).alias("member"), "idx", "idf")
            for m, v in enumerate(vocabularies)
        ],
    )
    known = entries.groupBy("term").agg(
        F.collect_list(F.struct("member", "idx", "idf")).alias("_entries")
    )
    # Settled: the term numbers are fixed then.
    known = settle(known.withColumn("_term", F.monotonically_increasing_id()))
    counted = (
        occurrences(docs, keys, ngram_range)
        .join(shared_terms(known.select("term", "_term")), "term", "left")
        .groupBy(*keys, "_term")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    places = shared(known.select("_term", "_entries"), F.size("_entries") * 32 + 32)
    expanded = counted.join(places, "_term", "left").select(
        *keys, "_c", F.inline_outer("_entries")
    )
    weight = (F.lit(1.0) + F.ln(F.col("_c").cast("double"))) * F.col("idf")
    weighted = expanded.select(*keys, "member", "idx", weight.alias("w"))
    columns = []
    for m in range(len(vocabularies)):
        mine = F.col("member") == m
        cells = F.collect_list(F.when(mine, F.struct("idx", "w")))
        columns += [
            F.sort_array(cells).alias(f"_cells{m}"),
            F.sqrt(F.sum(F.when(mine, F.col("w") * F.col("w")))).alias(f"_norm{m}"),
        ]
    sides = F.array(
        *[
            F.struct(
                F.lit(m).alias("member"),
                F.col(f"_cells{m}").alias("cells"),
                F.col(f"_norm{m}").alias("norm"),
            )
            for m in range(len(vocabularies))
        ]
    )
    rows = weighted.groupBy(*keys).agg(*columns).select(*keys, F.inline(sides))
    return rows.select(
        *keys,
        "member",
        F.transform(
            "cells", lambda cell: F.struct(cell.idx.alias("idx"), (cell.w / F.col("norm")).alias("w"))
        ).alias("features"),
    )


def ensemble_scores(
    docs: DataFrame,
    members: Sequence[EnsembleMember],
    ngram_range: tuple[int, int] = NGRAMS,
    keep: tuple[str, ...] = ("id",),
) -> DataFrame:
    """Mean member probability per document, with the member probabilities as an array."""
    keys = list(keep)
    rows = settle(
        ensemble_rows(docs, [m.vocabulary for m in members], ngram_range, keep),
        partition_by=["member"],
    )
    parts = [
        with_probability(linear_scores(rows.where(F.col("member") == number), member.model))
        for number, member in enumerate(members)
    ]
    scored = reduce(DataFrame.unionByName, parts)
    listed = F.sort_array(F.collect_list(F.struct("member", "prob")))
    return scored.groupBy(*keys).agg(
        F.avg("prob").alias("mean"), F.transform(listed, lambda cell: cell.prob).alias("member_probs")
    ).withColumnRenamed("mean", "prob")
