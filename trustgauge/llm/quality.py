"""Quality rules as a bitmask ledger: measure once, then apply policies by bit operations."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustgauge.llm.common import BLANK, BLANKS

WINDOW = 3

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
)

# Rule names in the order of their bits. A rule fails when its condition holds.
RULES: Mapping[str, str] = {
    "few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 20 * n_words",
    "repeated_lines": "n_lines >= 10 and 100 * n_dup_lines > 50 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 30 * n_words",
}


@dataclass(frozen=True)
class Policy:
    """A named version of the set of rules that reject a document."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        names = list(RULES)
        return sum(1 << names.index(r) for r in self.rules)


BASE = Policy("base-1", ("few_words", "repeated_windows"))
DEFAULT = Policy("full-1", tuple(RULES))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _windows(hashes: Column) -> Column:
    return F.transform(
        F.slice(hashes, 1, F.size(hashes) - (WINDOW - 1)),
        lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, WINDOW)]),
    )


def _covered(starts: Column) -> Column:
    """Words under windows that begin at these ascending places."""
    gaps = F.zip_with(
        starts,
        F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1))),
        lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))).cast("long"),
    )
    return F.aggregate(gaps, F.lit(0).cast("long"), lambda s, x: s + x)


def _repeated_starts(windows: Column) -> Column:
    """Places, ascending, of the windows whose hash occurs more than once."""

    def neighbours(s: Column) -> Column:
        hit = F.filter(
            s,
            lambda x, j: (F.get(s, j - 1)["h"] == x["h"]).eqNullSafe(True)
            | (F.get(s, j + 1)["h"] == x["h"]).eqNullSafe(True),
        )
        return F.sort_array(F.transform(hit, lambda x: x["i"]))

    keyed = F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return _let(F.sort_array(keyed), neighbours)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and MEASURES, from one pass over its whole text.

    Windows are compared as 64-bit hashes inside their document. A null text has no words.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    cut = docs.select(
        F.col(id_col).alias("_id"), text.alias("_text"),
        F.split(F.btrim(text, F.lit(BLANKS)), f"{BLANK}+").alias("_words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
    )
    # A text without words is cut into one empty string.
    none = (F.size("_words") == 1) & (F.element_at("_words", 1) == "")
    counted = cut.select(
        "_id",
        F.when(none, 0).otherwise(F.size("_words")).cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
    )
    windows = counted.select(
        "_id", *MEASURES[:-1],
        F.when(
            F.col("n_words") >= WINDOW,
            _let(F.col("_hashes"), _windows),
        ).alias("_windows"),
    )
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    return windows.select(
        F.col("_id").alias(id_col), *MEASURES[:-1],
        F.when(repeats, _let(_repeated_starts(F.col("_windows")), _covered))
        .otherwise(0).cast("long").alias("n_repeat_words"),
    )


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measurements of every document and ``failed``, one bit per broken rule."""
    failed = F.lit(0).cast("long")
    for bit, condition in enumerate(RULES.values()):
        failed = failed.bitwiseOR(F.when(F.expr(condition), F.lit(1 << bit)).otherwise(0))
    return measure(docs, id_col, text_col).withColumn("failed", failed)


def passes(policy: Policy) -> Column:
    return F.col("failed").bitwiseAND(F.lit(policy.mask)) == 0


def apply_policy(ledgers: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """Add ``kept``: no rule of the policy failed."""
    return ledgers.withColumn("kept", passes(policy))


def ablation(ledgers: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """Per rule of the policy: documents failing it, failing it alone, kept without it.

    Documents are first counted per bit pattern (at most 2^rules rows, combined per task);
    every figure then comes from the patterns.
    """
    mask = F.col("failed").bitwiseAND(F.lit(policy.mask))
    patterns = ledgers.groupBy(mask.alias("mask")).agg(F.count(F.lit(1)).alias("n"))
    names = list(RULES)
    rules = F.array(
        *[F.struct(F.lit(r).alias("rule"), F.lit(1 << names.index(r)).alias("bit")) for r in policy.rules]
    )
    each = patterns.withColumn("r", F.explode(rules))
    bit = F.col("r.bit")
    total = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        total(F.col("mask").bitwiseAND(bit) != 0).alias("n_failed"),
        total(F.col("mask") == bit).alias("n_failed_alone"),
        total(F.col("mask").bitwiseAND(F.bitwise_not(bit)) == 0).alias("n_kept_without"),
    )


def keep_good(
    docs: DataFrame, policy: Policy = DEFAULT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows of ``docs`` that pass the policy, all columns kept, judged in place.

    A null or empty text has no words and fails; equal rows share one fate; the id is not looked
    at, so it may be null or repeated; an empty table stays empty.
    """
    carried = docs.select(F.struct(*docs.columns).alias("_row"), F.col(text_col).alias("_text"))
    # Spark would otherwise move the condition below the measurements and repeat them in it.
    judged = ledger(carried, "_row", "_text").select(
        "_row", F.explode(F.array(F.struct("failed", *MEASURES))).alias("_ledger")
    )
    return judged.where(F.col("_ledger.failed").bitwiseAND(F.lit(policy.mask)) == 0).select("_row.*")
