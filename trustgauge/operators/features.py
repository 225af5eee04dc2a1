"""Vocabulary, TF-IDF rows and token ids from text.

Every function takes documents as (id, ..., text) and expects ids to be unique. Cut the text
with :func:`by_key` on the id first: all per-document groupings then run without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trustgauge.functions.text import terms, token_words, tokens
from trustgauge.operators import counting
from trustgauge.operators.ranking import ordered_rank
from trustgauge.sources.shipping import ship_package
from trustgauge.sources.workspace import settle

MAX_FEATURES = 15_000
MAX_TOKENS = 10_000
MIN_DF = 2
NGRAMS = (1, 2)

# Up to this many terms the most frequent ones are ranked in one task.
RANKED_AT_ONCE = 500_000
# Bytes of a lookup table that go to every task.
SHARED_BYTES = 64_000_000
CELLS = T.StructField(
    "features", T.ArrayType(T.StructType().add("idx", T.IntegerType()).add("w", T.DoubleType()))
)


def shared(table: DataFrame, row_bytes: Column) -> DataFrame:
    """A written table as the small side of a lookup: sent to every task while it is small.

    The rows that look something up, one per term of every text, then stay where they are.
    """
    size = table.agg(F.coalesce(F.sum(row_bytes), F.lit(0)).cast("long")).first()[0]
    return F.broadcast(table) if size <= SHARED_BYTES else table


def shared_terms(vocabulary: DataFrame) -> DataFrame:
    """``vocabulary`` for a lookup by term."""
    return shared(vocabulary, F.octet_length("term") + 32)


def occurrences(docs: DataFrame, keep: list[str], ngram_range: tuple[int, int]) -> DataFrame:
    """One row per term occurrence; a document without terms keeps one row with a null term.

    The outer explode also stops Catalyst from adding a size filter that would run the whole
    token expression a second time.
    """
    cut = docs.select(*keep, tokens(F.col("text")).alias("_tokens"))
    listed = cut.select(*keep, terms(F.col("_tokens"), ngram_range).alias("_terms"))
    return listed.select(*keep, F.explode_outer("_terms").alias("term"))


def term_counts(
    docs: DataFrame, ngram_range: tuple[int, int] = NGRAMS, id_col: str = "id"
) -> DataFrame:
    """How often each document holds each term: (id, term, c)."""
    return (
        occurrences(docs, [id_col], ngram_range)
        .where(F.col("term").isNotNull())
        .groupBy(id_col, "term")
        .agg(F.count(F.lit(1)).alias("c"))
    )


def term_frequencies(counts: DataFrame) -> DataFrame:
    """Total and document frequency of every term: (term, tf, df)."""
    return counts.groupBy("term").agg(
        F.sum("c").alias("tf"), F.count(F.lit(1)).alias("df")
    )


def repeated_ids(docs: DataFrame, id_col: str = "id") -> DataFrame | None:
    """The ids, null among them, that several rows of ``docs`` share; None if they are too many to be sent about."""
    ids = settle(docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(id_col))
    size = F.coalesce(F.sum(F.coalesce(F.octet_length(F.col(id_col).cast("string")), F.lit(0)) + 32), F.lit(0))
    return ids if ids.agg(size.cast("long")).first()[0] <= SHARED_BYTES else None


def gathered(docs: DataFrame, keys: list[str], repeats: DataFrame | None = None) -> DataFrame:
    """One row per document, its tokens as one string: (keys..., words). See :mod:`counting`.

    With the ``repeated_ids`` of the documents only the texts that share an id are brought together;
    all others stay where they are.
    """
    if repeats is None:
        cut = docs.select(*keys, token_words(F.col("text")).alias("_words"))
        return cut.groupBy(*keys).agg(F.concat_ws(f" {counting.BREAK} ", F.collect_list("_words")).alias("words"))

    def alone(some: DataFrame) -> DataFrame:
        return some.select(*keys, F.coalesce(token_words(F.col("text")), F.lit("")).alias("words"))

    if repeats.isEmpty():
        return alone(docs)
    id_col = repeats.columns[0]
    known = F.broadcast(repeats.withColumnRenamed(id_col, "_id"))
    shares = F.col(id_col).eqNullSafe(F.col("_id"))
    return alone(docs.join(known, shares, "left_anti")).unionByName(gathered(docs.join(known, shares, "left_semi"), keys))


def member_frequencies(found: DataFrame, members: int, ngram_range: tuple[int, int] = NGRAMS) -> DataFrame:
    """Counts of every term over documents (words, times): (term, tf0, df0, tf1, ...).

    A document counts ``times[m]`` times for member m. Its terms are cut and added up in the task,
    so a term leaves it once for all documents of a slice.
    """
    ship_package(found.sparkSession)
    names = [f"{k}{m}" for m in range(members) for k in ("tf", "df")]
    job = counting.frequencies(max(1, ngram_range[0]), ngram_range[1], members)
    parts = found.select("words", "times").mapInArrow(job, "term string, " + ", ".join(f"{n} long" for n in names))
    return parts.groupBy("term").agg(*[F.sum(n).alias(n) for n in names])


def carried(vocabularies: Sequence[DataFrame]) -> Sequence[pa.Table] | None:
    """Vocabularies as tables for the tasks, while they are small together."""
    size = F.coalesce(F.sum(F.octet_length("term") + 32), F.lit(0)).cast("long").alias("size")
    if sum(v.agg(size).first()[0] for v in vocabularies) > SHARED_BYTES:
        return None
    return [v.select("term", *[c for c in ("idx", "idf") if c in v.columns]).toArrow() for v in vocabularies]


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def weighted_rows(
    docs: DataFrame, tables: Sequence[pa.Table], ngram_range: tuple[int, int], keep: tuple[str, ...]
) -> DataFrame:
    """TF-IDF rows under every vocabulary of ``carried``: (keep..., member, features)."""
    spark, keys = docs.sparkSession, list(keep)
    ship_package(spark)
    known = pa.chunked_array([c for t in tables for c in t.column("term").chunks], pa.string()).combine_chunks().unique()
    members = []
    for table in tables:
        numbers, idfs = np.full(len(known), -1, dtype=np.int64), np.zeros(len(known))
        at = pc.index_in(table.column("term"), value_set=known).to_numpy()
        numbers[at], idfs[at] = _column(table, "idx"), _column(table, "idf")
        members.append((numbers, idfs))
    sent = spark.sparkContext.broadcast((known, members))
    found = gathered(docs, keys)
    schema = T.StructType([*found.schema.fields[:-1], T.StructField("member", T.IntegerType()), CELLS])
    return found.mapInArrow(counting.weighted(sent, len(keys), max(1, ngram_range[0]), ngram_range[1]), schema)


def smoothed_idf(df: Column, n_docs: Column) -> Column:
    """ln((1 + n) / (1 + df)) + 1 with n at least one."""
    n = F.greatest(n_docs.cast("double"), F.lit(1.0))
    return F.ln((F.lit(1.0) + n) / (F.lit(1.0) + df)) + 1.0


def select_vocabulary(
    frequencies: DataFrame,
    n_docs: Column,
    min_df: int = MIN_DF,
    max_features: int = MAX_FEATURES,
) -> DataFrame:
    """Most frequent terms, ties in term order: (term, idx, tf, df, idf). 0 keeps all terms."""
    known = frequencies.where(F.col("df") >= min_df)
    order = [F.desc("tf"), F.asc("term")]
    if 0 < max_features <= RANKED_AT_ONCE:
        # A bounded top-k; ranking at most max_features rows in one task.
        top = known.orderBy(*order).limit(max_features)
        ranked = top.withColumn("idx", F.row_number().over(Window.orderBy(*order)) - 1)
    else:
        ranked = ordered_rank(known, order)
        if max_features > 0:
            ranked = ranked.where(F.col("idx") < max_features)
    return ranked.select(
        "term", "idx", "tf", "df", smoothed_idf(F.col("df"), n_docs).alias("idf")
    )


def text_frequencies(
    docs: DataFrame, ngram_range: tuple[int, int] = NGRAMS, id_col: str = "id", repeats: DataFrame | None = None
) -> DataFrame:
    """Total and document frequency of every term: (term, tf, df). ``repeats`` as in ``gathered``."""
    found = gathered(docs, [id_col], repeats).withColumn("times", F.array(F.lit(1)))
    return member_frequencies(found, 1, ngram_range).withColumnsRenamed({"tf0": "tf", "df0": "df"})


def fit_vocabulary(
    docs: DataFrame,
    min_df: int = MIN_DF,
    max_features: int = MAX_FEATURES,
    ngram_range: tuple[int, int] = NGRAMS,
    id_col: str = "id",
) -> DataFrame:
    """Vocabulary of the documents, written once so that later steps know its size."""
    frequencies = text_frequencies(docs, ngram_range, id_col)
    n_docs = docs.agg(F.count(F.lit(1))).scalar()
    return settle(select_vocabulary(frequencies, n_docs, min_df, max_features))


def fit_token_vocabulary(
    docs: DataFrame, min_df: int = MIN_DF, max_tokens: int = MAX_TOKENS, id_col: str = "id",
    repeats: DataFrame | None = None,
) -> DataFrame:
    """Single-token vocabulary of the embedding model; here 0 means no tokens at all."""
    frequencies = text_frequencies(docs, (1, 1), id_col, repeats)
    n_docs = docs.agg(F.count(F.lit(1))).scalar()
    if max_tokens <= 0:
        frequencies = frequencies.limit(0)
    return settle(select_vocabulary(frequencies, n_docs, min_df, max(1, max_tokens)))


def tfidf(
    docs: DataFrame,
    vocabulary: DataFrame,
    ngram_range: tuple[int, int] = NGRAMS,
    keep: tuple[str, ...] = ("id",),
) -> DataFrame:
    """One row per document with ``features``: array of (idx, w), sorted by idx.

    w = (1 + ln count) * idf, scaled to unit length. Unknown terms are dropped and a document
    without known terms has an empty array. ``keep`` names the id and the columns that travel
    with it.
    """
    keys = list(keep)
    known = occurrences(docs, keys, ngram_range).join(
        shared_terms(vocabulary.select("term", "idx", "idf")), "term", "left"
    )
    counted = known.groupBy(*keys, "idx", "idf").agg(F.count(F.lit(1)).alias("_c"))
    weight = (F.lit(1.0) + F.ln(F.col("_c").cast("double"))) * F.col("idf")
    weighted = counted.select(*keys, "idx", F.when(F.col("idx").isNotNull(), weight).alias("w"))
    cells = F.collect_list(F.when(F.col("idx").isNotNull(), F.struct("idx", "w")))
    rows = weighted.groupBy(*keys).agg(
        F.sort_array(cells).alias("_cells"),
        F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("_norm"),
    )
    return rows.select(
        *keys,
        F.transform(
            "_cells",
            lambda cell: F.struct(cell.idx.alias("idx"), (cell.w / F.col("_norm")).alias("w")),
        ).alias("features"),
    )


def tfidf_long(rows: DataFrame, id_col: str = "id") -> DataFrame:
    """Long form of TF-IDF rows: (id, idx, w)."""
    return rows.select(id_col, F.inline("features"))


def encode(
    docs: DataFrame,
    vocabulary: DataFrame,
    keep: tuple[str, ...] = ("id",),
    repeats: DataFrame | None = None,
) -> DataFrame:
    """Known tokens of each document as indices, in text order with repeats. ``repeats`` as in ``gathered``."""
    keys = list(keep)
    tables = carried([vocabulary.select("term", "idx")])
    if tables is not None:
        spark = docs.sparkSession
        ship_package(spark)
        known = pa.chunked_array(tables[0].column("term").chunks, pa.string()).combine_chunks()
        sent = spark.sparkContext.broadcast((known, _column(tables[0], "idx").astype(np.int64)))
        found = gathered(docs, keys, repeats)
        schema = T.StructType([*found.schema.fields[:-1], T.StructField("token_ids", T.ArrayType(T.IntegerType()))])
        return found.mapInArrow(counting.encoded(sent, len(keys)), schema)
    placed = docs.select(*keys, tokens(F.col("text")).alias("_tokens")).select(
        *keys, F.posexplode_outer("_tokens").alias("_pos", "term")
    )
    known = placed.join(shared_terms(vocabulary.select("term", "idx")), "term", "left")
    cells = F.collect_list(F.when(F.col("idx").isNotNull(), F.struct("_pos", "idx")))
    return known.groupBy(*keys).agg(F.sort_array(cells).alias("_cells")).select(
        *keys, F.transform("_cells", lambda cell: cell.idx).alias("token_ids")
    )


def to_vectors(rows: DataFrame, size: int, keep: tuple[str, ...] = ("id",)) -> DataFrame:
    """TF-IDF rows as MLlib sparse vectors, in a table of their own.

    The parquet layout of a sparse vector is (type 0, size, indices, values), so the rows are
    written in that layout and read back as vectors: no row passes through Python.
    """
    struct = F.struct(
        F.lit(0).cast("byte").alias("type"),
        F.lit(size).alias("size"),
        F.transform("features", lambda cell: cell.idx).alias("indices"),
        F.transform("features", lambda cell: cell.w).alias("values"),
    )
    plain = rows.select(*keep, struct.alias("features"))
    fields = [f for f in plain.schema.fields if f.name != "features"]
    return settle(plain, schema=T.StructType([*fields, T.StructField("features", VectorUDT())]))
