"""Mixing sources to target weights with Efraimidis-Spirakis sampling."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustgauge.llm.common import WORD, running, store, unit_hash


@dataclass(frozen=True)
class Settings:
    """Weights by place of the source in code point order, repeating; null comes last.

    The mix holds ``share`` times the words of all documents, and of no source more than
    ``most`` times its own.
    """

    weights: Sequence[float] = (5.0, 2.0, 1.0)
    share: float = 1.5
    most: float = 2.0
    seed: int = 7


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column, size: Column) -> Column:
    """Chance weight of a document: 1 for plain prose, less the more symbols it has per word."""
    symbols = F.coalesce(F.regexp_count(text, F.lit("[#*$%&|<>{}]")), F.lit(0))
    return F.lit(1.0) / (F.lit(1.0) + 4.0 * symbols / F.greatest(size, F.lit(1)))


def source_targets(sizes: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Words to take from each source: (source, source_size, target).

    ``sizes`` has (source, source_size), a row per source. What a source cannot give is shared
    among the others by weight until none is above its limit; each round is one sum over the
    sources, and their number is at most that of the sources that reach their limit.
    """
    ranked = running(sizes, [F.col("source").asc_nulls_last()])
    weights = F.array(*[F.lit(float(w)) for w in settings.weights])
    state = store(
        ranked.select(
            "source", "source_size",
            F.get(weights, (F.col("rank") % len(settings.weights)).cast("int")).alias("weight"),
            (F.col("source_size") * F.lit(float(settings.most))).alias("limit"),
        )
    )
    whole = state.agg(F.sum("source_size")).first()[0] or 0
    budget, scale = settings.share * whole, 0.0
    # A source is full when its share at the present scale passes its limit. The scale only
    # rises, so full sources stay full.
    while True:
        full = F.col("limit") <= F.col("weight") * F.lit(scale)
        row = state.agg(
            F.sum(F.when(full, F.col("limit"))).alias("given"),
            F.sum(F.when(~full, F.col("weight"))).alias("open"),
        ).first()
        if not row["open"]:
            break
        rising = (budget - (row["given"] or 0.0)) / row["open"]
        if rising <= scale:
            break
        scale = rising
    return state.select(
        "source", "source_size",
        F.least(F.col("limit"), F.col("weight") * F.lit(scale)).alias("target"),
    )


def plan_mix(rows: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Add source_size, target, epochs, chosen and taken to rows of (id, source, size, quality).

    Each row draws an exponential key over its quality, -ln(u) / quality, from its id; within
    a source, rows in the order of keys are a weighted sample without replacement at every
    length. A source first gives every row as many times as its target holds whole epochs;
    of the rest it gives the rows whose place in the order, by summed words, lies within it:
    the row at the edge goes in when more than half of it does. So a source misses its target
    by half a document at most. Only narrow rows are ordered, in ranges, whatever the source.
    """
    targets = store(
        source_targets(
            store(rows.groupBy("source").agg(F.sum("size").alias("source_size"))), settings
        )
    ).withColumnRenamed("source", "_source")
    key = -F.log(unit_hash("id", seed=settings.seed)) / F.col("quality")
    ordered = store(
        running(
            rows.withColumn("_key", key),
            [F.col("source"), F.col("_key"), F.col("id"), F.col("size")],
            {"_before": "size"},
        )
    )
    begins = store(ordered.groupBy("source").agg(F.min("_before").alias("_begin")))
    begins = begins.withColumnRenamed("source", "_from")
    epochs = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(0).cast("long")
    met = ordered.join(targets, F.col("source").eqNullSafe(F.col("_source"))).join(
        begins, F.col("source").eqNullSafe(F.col("_from"))
    )
    left = F.col("target") - F.col("epochs") * F.col("source_size")
    inside = F.col("_before") - F.col("_begin") + F.col("size") / 2 <= left
    return (
        met.withColumn("epochs", epochs)
        .withColumn("chosen", inside & (F.col("size") > 0))
        .withColumn("taken", F.col("size") * (F.col("epochs") + F.col("chosen").cast("long")))
        .drop("_source", "_from", "_begin", "rank")
    )


def measured(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """Narrow rows (id, source, size, quality) of all documents, written once."""
    text = F.col(text_col)
    size = word_count(text)
    return store(
        docs.select(
            F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"),
            quality_weight(text, size).alias("quality"),
        )
    )


def mix_plan_of(docs: DataFrame, settings: Settings = Settings(), **columns: str) -> DataFrame:
    """How many words the mix takes of each row: (id, source, size, source_size, target, epochs, chosen, taken).

    A null text has no words, and a row without words is never taken; null sources form one source, after all others; rows equal in
    id, source and size share their draw; an empty table gives an empty result.
    """
    return plan_mix(measured(docs, **columns), settings)


def draw_mix(
    docs: DataFrame,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as it is taken, all columns kept.

    The last chosen place of each source decides, so rows are told apart where they are and
    texts don't shuffle: a source's row with (epochs, last key, id and size) meets its rows.
    A null text has no words and is taken as often as its place in the order says; a null source is one
    of its own. Rows equal in source, key, id and size share one fate. An empty table gives an empty mix.
    """
    planned = mix_plan_of(docs, settings, id_col=id_col, text_col=text_col, source_col=source_col)
    # Rows without words stand at some place too, but are never taken.
    last = F.max(F.when(F.col("chosen"), F.struct("_key", "id", "size")))
    cuts = store(planned.groupBy("source").agg(F.max("epochs").alias("_epochs"), last.alias("_last")))
    cuts = cuts.withColumnRenamed("source", "_source")
    text = F.col(text_col)
    size = word_count(text)
    key = -F.log(unit_hash(F.col(id_col), seed=settings.seed)) / quality_weight(text, size)
    place = F.struct(key.alias("_key"), F.col(id_col).alias("id"), size.alias("size"))
    chosen = F.coalesce(F.col("_place") <= F.col("_last"), F.lit(False))
    times = F.when(F.col("_place.size") > 0, F.col("_epochs") + chosen.cast("long")).otherwise(0)
    met = docs.withColumn("_place", place).join(
        cuts, F.col(source_col).eqNullSafe(F.col("_source")), "left"
    )
    copies = F.array_repeat(F.lit(1), times.cast("int"))
    return met.withColumn("_copy", F.explode(copies)).select(*docs.columns)
