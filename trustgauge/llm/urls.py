"""URL filters: rules by host and path first, boosted trees on lexical features for the rest."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustgauge.llm.common import UPPER, store, unit_hash

FEATURES = (
    "url_length", "host_length", "path_length", "depth", "host_labels", "digit_ratio", "hyphens",
    "entropy", "params", "suffix2_rate", "suffix3_rate",
)


@dataclass(frozen=True)
class Rule:
    """Fits its host and all subdomains if the path starts with the rule's."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Settings:
    """Size and seed of the model, and how many different labelled URLs it is fitted on at most.

    Suffix rates are shrunk towards the overall rate as if ``prior`` more rows had it.
    """

    train_rows: int = 50_000
    trees: int = 12
    depth: int = 4
    seed: int = 3
    prior: float = 20.0


def host_of(url: Column) -> Column:
    """After the first :// up to the next / ? #, with A-Z lower-cased; else empty."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(rest, F.lit("")), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host, up to the next ? or #; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(rule, verdict) of the longest rule that fits, null if none does.

    The rules are a list on the driver and travel with the plan. Of two fitting rules of equal
    length the one with the longer host wins.
    """
    if not rules:
        return F.lit(None).cast("struct<rule: string, verdict: string>")
    listed = F.array(
        *[
            F.struct(
                F.lit(len(r.text)).alias("size"), F.lit(len(r.host)).alias("host_size"),
                F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"),
                F.lit(r.host).alias("host"), F.lit(r.path).alias("path"),
            )
            for r in rules
        ]
    )
    fits = F.filter(
        listed,
        lambda r: ((host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"])))
        & F.startswith(path, r["path"]),
    )
    best = F.array_max(fits)
    return F.when(best.isNotNull(), F.struct(best["rule"].alias("rule"), best["verdict"].alias("verdict")))


def _suffix(host: Column, labels: int) -> Column:
    return F.substring_index(host, ".", -labels)


def _entropy(text: Column) -> Column:
    """Shannon entropy in nats of a short string's characters."""
    shares = F.transform(
        F.array_distinct(F.split(text, "")),
        lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / F.length(text),
    )
    return F.coalesce(
        F.aggregate(shares, F.lit(0.0), lambda s, p: s - F.when(p > 0, p * F.log(p)).otherwise(0.0)),
        F.lit(0.0),
    )


def lexical(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """Add host, path and all features that come from the URL alone."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    cut = urls.withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))})
    number = lambda c: c.cast("double")
    return cut.withColumns(
        {
            "url_length": number(F.length(url)),
            "host_length": number(F.length("host")),
            "path_length": number(F.length("path")),
            "depth": number(F.regexp_count("path", F.lit("/[^/]"))),
            "host_labels": number(F.size(F.split("host", r"\."))),
            "digit_ratio": F.regexp_count(url, F.lit("[0-9]")) / F.greatest(F.length(url), F.lit(1)),
            "hyphens": number(F.regexp_count("host", F.lit("-"))),
            "entropy": F.when(F.col("host") != "", _entropy(F.col("host"))).otherwise(0.0),
            "params": number(F.regexp_count(query, F.lit("[^&]+"))),
            "suffix2": _suffix(F.col("host"), 2),
            "suffix3": _suffix(F.col("host"), 3),
        }
    )


@dataclass(frozen=True)
class UrlModel:
    """Fitted trees, and how often each host suffix is labelled bad, as a table."""

    trees: GBTClassificationModel | None
    rates: DataFrame
    overall: float


def _with_rates(rows: DataFrame, rates: DataFrame, overall: float, fold: bool) -> DataFrame:
    """Join the suffix rates; with ``fold`` a row sees those of the other half only."""
    for level in (2, 3):
        name = f"suffix{level}_rate"
        side = rates.where(F.col("level") == level).select(
            F.col("suffix").alias(f"suffix{level}"),
            *([F.col("rate0"), F.col("rate1")] if fold else [F.col("rate").alias(name)]),
        )
        rows = rows.join(side, f"suffix{level}", "left")
        if fold:
            value = F.when(F.col("half") == 0, F.col("rate1")).otherwise(F.col("rate0"))
            rows = rows.withColumn(name, value).drop("rate0", "rate1")
        rows = rows.withColumn(name, F.coalesce(name, F.lit(overall)))
    return rows


def fit_urls(
    labelled: DataFrame, settings: Settings = Settings(), url_col: str = "url", label_col: str = "bad"
) -> UrlModel:
    """Fit on (url, bad 0/1): suffix rates on all rows, trees on ``train_rows`` URLs at most.

    The sample is the first by a hash of the URL, each URL and label once, weighed by its number of
    rows, so that a URL with a third of all rows is one row of the fit. Suffix rates of a
    training row come from the other half of the URLs, so that the trees do not learn to trust
    rates that hold the row's own label. With fewer than two classes there are no trees and
    every URL passes. Rows without URL or label are left out; a table without rows gives no trees.
    """
    rows = labelled.where(F.col(label_col).isNotNull() & F.col(url_col).isNotNull()).select(
        F.col(url_col).alias("url"), F.col(label_col).cast("double").alias("label")
    )
    rows = lexical(rows.groupBy("url", "label").agg(F.count(F.lit(1)).cast("double").alias("times")))
    rows = store(rows.withColumn("half", (unit_hash("url", seed=settings.seed) < 0.5).cast("int")))
    sums = rows.agg(F.coalesce(F.sum("times"), F.lit(0.0)).alias("n"), F.sum(F.col("times") * F.col("label")).alias("bad")).first()
    n, bad = sums["n"], sums["bad"] or 0.0
    overall = bad / n if n else 0.0
    ends = F.array(
        *[F.struct(F.lit(k).alias("level"), F.col(f"suffix{k}").alias("suffix")) for k in (2, 3)]
    )
    half = lambda h, c: F.sum(F.when(F.col("half") == h, c * F.col("times")).otherwise(0.0))
    counted = (
        rows.select(F.explode(ends).alias("e"), "label", "half", "times")
        .groupBy("e.level", "e.suffix")
        .agg(*[half(h, F.lit(1.0)).alias(f"n{h}") for h in (0, 1)], *[half(h, F.col("label")).alias(f"b{h}") for h in (0, 1)])
    )
    rate = lambda b, n: (b + settings.prior * overall) / (n + settings.prior)
    rates = store(
        counted.select(
            "level", "suffix", rate(F.col("b0") + F.col("b1"), F.col("n0") + F.col("n1")).alias("rate"),
            rate(F.col("b0"), F.col("n0")).alias("rate0"), rate(F.col("b1"), F.col("n1")).alias("rate1"),
        )
    )
    if not 0 < bad < n:
        return UrlModel(None, rates, overall)
    sample = store(rows.orderBy(unit_hash("url", seed=settings.seed + 1), "url", "label").limit(settings.train_rows))
    train = _with_rates(sample, rates, overall, fold=True)
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    ready = store(train.select(*FEATURES, "label", "times"))
    trees = GBTClassifier(
        maxIter=settings.trees, maxDepth=settings.depth, seed=settings.seed, stepSize=0.3, weightCol="times"
    ).fit(vectors.transform(ready).coalesce(8).select("features", "label", "times"))
    return UrlModel(trees, rates, overall)


def score_urls(urls: DataFrame, model: UrlModel, url_col: str = "url") -> DataFrame:
    """Add host, path and ``bad``, the probability by the trees."""
    rows = _with_rates(lexical(urls, url_col), model.rates, model.overall, fold=False)
    if model.trees is None:
        return rows.withColumn("bad", F.lit(0.0))
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    scored = model.trees.transform(vectors.transform(rows))
    return scored.withColumn("bad", vector_to_array("probability")[1])


def judge_urls(
    urls: DataFrame, model: UrlModel, rules: Sequence[Rule], url_col: str = "url", limit: float = 0.5
) -> DataFrame:
    """Add host, path, rule, verdict and bad to every row.

    The longest fitting rule decides, else the trees: block from ``limit`` on. A null URL or one
    without :// has an empty host and path, fits no rule and is left to the trees; repeated
    rows are judged alike; columns of ``urls`` other than the URL are carried unless they share
    the name of a column added here.
    """
    added = {"host", "path", "rule", "verdict", "bad", *FEATURES, "suffix2", "suffix3", "features"}
    own = [c for c in urls.columns if c == url_col or c not in added]
    scored = score_urls(urls.select(*own), model, url_col)
    hit = matching_rule(F.col("host"), F.col("path"), rules)
    verdict = F.when(F.col("_hit").isNotNull(), F.col("_hit.verdict")).otherwise(
        F.when(F.col("bad") >= limit, "block").otherwise("allow")
    )
    return scored.withColumn("_hit", hit).select(
        *own, "host", "path", F.col("_hit.rule").alias("rule"), verdict.alias("verdict"), "bad"
    )
