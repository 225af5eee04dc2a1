"""Source divergence audit: how far the sources of a language differ, and by which terms."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trustgauge.llm.common import by_bytes, store
from trustgauge.sources.shipping import ship_package

# Distinct (group, term) pairs that a task holds before it hands its counts on.
HELD = 200_000
# Rows of kept terms that one task compares at a time, and sources held against all others there.
BUCKET_ROWS = 20_000
SOURCE_BLOCK = 256
DENSE_CELLS = 1 << 20


@dataclass(frozen=True)
class Settings:
    """Documents a term must be in, the smoothing of counts, the scale of shares, ranks listed."""

    min_docs: int = 30
    smoothing: int = 5
    scale: int = 1_000_000_000
    top: int = 50


def _letters() -> bytes:
    """Byte by byte: A-Z lowered, letters and bytes of longer characters kept, the rest blank."""
    kept = bytearray(b" " * 256)
    for b in range(256):
        if 97 <= b <= 122 or b >= 128:
            kept[b] = b
        elif 65 <= b <= 90:
            kept[b] = b + 32
    return bytes(kept)


LETTERS = _letters()
COUNTED = "lang string, source string, term string, n long, d long"


def _flush(held: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), (counts, documents) in held.items():
        terms = list(counts)
        for at in range(0, len(terms), 50_000):
            part = terms[at : at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(part), pa.string()),
                    pa.array([source] * len(part), pa.string()),
                    pa.array(part, pa.binary()).cast(pa.string()),
                    pa.array([counts[t] for t in part], pa.int64()),
                    pa.array([documents[t] for t in part], pa.int64()),
                ],
                ["lang", "source", "term", "n", "d"],
            )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of every term by group, combined over many documents."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0
    for batch in batches:
        for part in by_bytes(batch, "text"):
            groups = zip(part.column("lang").to_pylist(), part.column("source").to_pylist(), strict=True)
            for group, text in zip(groups, part.column("text").to_pylist(), strict=True):
                terms = text.translate(LETTERS).split()
                counts, documents = held.setdefault(group, (Counter(), Counter()))
                size -= len(counts)
                counts.update(terms)
                documents.update(set(terms))
                size += len(counts)
                if size >= HELD:
                    yield from _flush(held)
                    held, size = {}, 0
    yield from _flush(held)


def term_counts(docs: DataFrame, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    """Counts of every term by group: (lang, source, term, n, total, documents).

    ``n`` counts occurrences in the group, ``total`` those in the language, ``documents`` the
    language's documents with the term. Tasks combine their documents first, so what is
    shuffled follows the vocabulary; one exchange by (lang, term) serves all three sums.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(
        F.coalesce(F.col(lang_col), F.lit("")).alias("lang"),
        F.coalesce(F.col(source_col), F.lit("")).alias("source"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
    )
    counted = rows.mapInArrow(_count, COUNTED).repartition("lang", "term")
    own = Window.partitionBy("lang", "term")
    return (
        counted.groupBy("lang", "source", "term")
        .agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
        .select(
            "lang", "source", "term", "n",
            F.sum("n").over(own).alias("total"),
            F.sum("d").over(own).alias("documents"),
            (F.min("source").over(own) == F.col("source")).cast("long").alias("head"),
        )
    )


def _share(count: Column, total: Column, terms: Column, settings: Settings) -> Column:
    """1 + floor(scale * (count + smoothing) / (total + smoothing * terms)), exactly."""
    wide = "decimal(19,0)"
    part = ((count + settings.smoothing).cast(wide) * F.lit(settings.scale).cast(wide)).cast("decimal(38,0)")
    whole = (total + settings.smoothing * terms).cast("decimal(38,0)")
    return F.lit(1).cast("long") + F.call_function("div", part, whole)


def _groups(docs: DataFrame, kept: DataFrame, lang_col: str, source_col: str) -> DataFrame:
    """Every group: (lang, source, size, lang_size, terms, rows, sources); sizes count kept terms."""
    found = docs.select(
        F.coalesce(F.col(lang_col), F.lit("")).alias("lang"),
        F.coalesce(F.col(source_col), F.lit("")).alias("source"),
    ).distinct()
    sums = kept.groupBy("lang", "source").agg(
        F.sum("n").alias("size"), F.sum("head").alias("heads"), F.count(F.lit(1)).alias("kept_rows")
    )
    zero = F.lit(0).cast("long")
    found = store(
        found.join(sums, ["lang", "source"], "left").select(
            "lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("size", "heads", "kept_rows")]
        ),
        narrow=True,
    )
    langs = found.groupBy("lang").agg(
        F.sum("size").alias("lang_size"), F.sum("heads").alias("terms"),
        F.sum("kept_rows").alias("rows"), F.count(F.lit(1)).alias("sources"),
    )
    return store(found.drop("heads", "kept_rows").join(langs, "lang"), narrow=True)


def _compare(left: pa.Table, right: pa.Table) -> pa.Table:
    """Sums of |p - q| over the terms of one bucket, for a block of sources against all others."""
    lang, block = right.column("lang")[0].as_py(), right.column("block")[0].as_py()
    sources = right.column("source").combine_chunks()
    none = right.column("none").to_numpy()
    first = block * SOURCE_BLOCK
    own = np.arange(first, min(first + SOURCE_BLOCK, len(sources)))
    total = np.zeros((len(own), len(sources)), dtype=np.int64)
    if left.num_rows:
        left = left.sort_by("term")
        term = left.column("term").combine_chunks()
        fresh = pc.not_equal(term.slice(1), term.slice(0, len(term) - 1)).to_numpy(zero_copy_only=False)
        row = np.append(0, np.cumsum(fresh))
        at = pc.index_in(left.column("source").combine_chunks(), sources).to_numpy()
        p = left.column("p").to_numpy()
        step = max(1, DENSE_CELLS // len(sources))
        for lo in range(0, int(row[-1]) + 1, step):
            a, b = np.searchsorted(row, [lo, lo + step])
            dense = np.tile(none, (int(row[b - 1]) - lo + 1, 1))
            dense[row[a:b] - lo, at[a:b]] = p[a:b]
            for k, i in enumerate(own):
                total[k] += np.abs(dense - dense[:, i : i + 1]).sum(axis=0)
    i, j = np.nonzero(own[:, None] != np.arange(len(sources))[None, :])
    return pa.table(
        {
            "lang": pa.array([lang] * len(i), pa.string()),
            "source": sources.take(pa.array(own[i])),
            "item": sources.take(pa.array(j)),
            "value": pa.array(total[i, j]),
        }
    )


def _pairs(kept: DataFrame, groups: DataFrame, settings: Settings) -> DataFrame:
    """Distance of any two sources of a language: (lang, source, item, value).

    Terms are dealt into buckets of a bounded size by their hash, and a task holds the shares
    of one bucket's terms in all sources of the language; a source without the term has the
    share of a count of zero. Only sums by pair of sources leave it.
    """
    buckets = (F.col("rows") / BUCKET_ROWS).cast("long") + 1
    blocks = ((F.col("sources") - 1) / SOURCE_BLOCK).cast("long")
    block = F.explode(F.sequence(F.lit(0).cast("long"), blocks)).alias("block")
    zero = F.lit(0).cast("long")
    every = (
        groups.select("*", block)
        .select(
            "lang", "source", "block",
            F.explode(F.sequence(zero, buckets - 1)).alias("bucket"),
            F.when(F.col("terms") > 0, _share(zero, F.col("size"), F.greatest("terms", F.lit(1)), settings))
            .otherwise(zero).alias("none"),
        )
    )
    seen = kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", F.pmod(F.xxhash64("term"), buckets).alias("bucket"),
        _share(F.col("n"), F.col("size"), F.col("terms"), settings).alias("p"), block,
    )
    keys = ["lang", "bucket", "block"]
    sums = seen.groupBy(*keys).cogroup(every.groupBy(*keys)).applyInArrow(
        _compare, "lang string, source string, item string, value long"
    )
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def _marking(kept: DataFrame, groups: DataFrame, settings: Settings) -> DataFrame:
    """Terms a source has more of than its language: (lang, source, item, value, rank).

    Terms are grouped into cells by (count in the group, count in the language), which alone
    decide a value. Cells of equal value are merged; a value's ranks begin after the terms of
    all larger values. Only values that begin within the top ranks are expanded into terms.
    """
    keys = ["lang", "source"]
    cells = kept.groupBy(*keys, "n", "total").agg(F.count(F.lit(1)).alias("m"))
    p = _share(F.col("n"), F.col("size"), F.col("terms"), settings)
    q = _share(F.col("total"), F.col("lang_size"), F.col("terms"), settings)
    cells = store(
        cells.join(groups, keys).withColumn("value", p - q).where("value > 0")
        .select(*keys, "n", "total", "m", "value"),
        narrow=True,
    )
    largest = Window.partitionBy(*keys).orderBy(F.desc("value"))
    before = F.sum("m").over(largest.rowsBetween(Window.unboundedPreceding, -1))
    chosen = (
        cells.groupBy(*keys, "value").agg(F.sum("m").alias("m"))
        # Any value holds a term, so no more than the top values can matter.
        .withColumn("turn", F.row_number().over(largest)).where(F.col("turn") <= settings.top)
        .withColumn("before", F.coalesce(before, F.lit(0)))
        .where(F.col("before") < settings.top)
        .select(*keys, "value", "before")
    )
    chosen = store(cells.drop("m").join(chosen, [*keys, "value"]), narrow=True)
    inside = Window.partitionBy(*keys, "value", "before").orderBy("term")
    return (
        kept.join(chosen, [*keys, "n", "total"])
        .select(*keys, "value", "before", "term")
        .withColumn("turn", F.row_number().over(inside)).where(F.col("turn") <= settings.top)
        .withColumn("rank", (F.col("before") + F.col("turn")).cast("int"))
        .where(F.col("rank") <= settings.top)
        .select(*keys, F.col("term").alias("item"), "value", "rank")
    )


def audit(
    docs: DataFrame,
    settings: Settings = Settings(),
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """Divergence of the sources within each language: (lang, source, part, item, value, rank).

    A term is a run of letters A-Z, lowered, and of characters beyond ASCII. A language keeps
    the terms of at least ``min_docs`` of its documents. Each source, and the language as a
    whole, gives a kept term a smoothed share of ``scale``, in whole numbers. Part ``pair`` ranks
    the other sources of the language by the sum of differences over all kept terms, part
    ``term`` the terms that the source has more of than its language, to rank ``top``.

    A null language, source or text is empty. A row counts as a document, so repeated rows
    count again. Equal values rank by item in UTF-8 order. A language without kept terms has
    pairs of value 0 and no terms; one with a single source has no pairs; an empty table gives an
    empty result. Other columns of ``docs`` are not read.
    """
    kept = store(
        term_counts(docs, lang_col, source_col, text_col).where(F.col("documents") >= settings.min_docs)
        .drop("documents")
    )
    groups = _groups(docs, kept, lang_col, source_col)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = _pairs(kept, groups, settings).withColumn("rank", F.row_number().over(order))
    parts = [(pairs, "pair"), (_marking(kept, groups, settings), "term")]
    one, two = (
        df.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank") for df, name in parts
    )
    return one.unionByName(two)
