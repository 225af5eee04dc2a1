"""Exact deduplication: a two-pass Bloom filter decides which rows have to shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trustgauge.llm.common import lower_ascii, store

# Filter bits per row; two probes then mark about 1.4 % of the unrepeated rows in vain.
BITS_PER_ROW = 16
PROBES = 2
# A filter has at most this many bits (32 MB), since it travels to every executor. Beyond 16 million
# rows it clears fewer of them, bit by bit; what it does not clear is counted exactly anyway.
MOST_BITS = 1 << 28
LEAST_BITS = 1 << 15


def digest(text: Column) -> Column:
    """SHA-256 of the text with A-Z lower-cased, null being the empty text."""
    return F.sha2(lower_ascii(F.coalesce(text, F.lit(""))).cast("binary"), 256)


def filter_bits(rows: int, bits_per_row: int = BITS_PER_ROW) -> int:
    return min(MOST_BITS, max(LEAST_BITS, 1 << (max(rows, 1) * bits_per_row - 1).bit_length()))


def _cell(key: str, probe: int, bits: int) -> Column:
    """One-based cell of the filter, as the bitmap functions count them."""
    return F.pmod(F.xxhash64(F.col(key), F.lit(probe)), F.lit(bits)) + 1


def repeat_filter(rows: DataFrame, key: str, bits: int) -> DataFrame:
    """The second filter: bitmaps of the cells that two or more rows fall on in the first.

    Cells are counted through a shuffle of two numbers per row, so the filter moves more narrow
    rows than a grouping by digest would; it spares the digests and texts. One row of 4 KB
    per 32 768 cells: (bucket, bitmap).
    """
    cells = rows.select(
        F.explode(F.array(*[_cell(key, p, bits) for p in range(PROBES)])).alias("cell")
    )
    twice = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return _bitmaps(twice)


def member_filter(rows: DataFrame, key: str, bits: int) -> DataFrame:
    """Bitmaps of the cells of all rows; tasks combine theirs, so that only bitmaps move."""
    return _bitmaps(rows.select(F.explode(F.array(*[_cell(key, p, bits) for p in range(PROBES)])).alias("cell")))


def _bitmaps(cells: DataFrame) -> DataFrame:
    return cells.groupBy(F.bitmap_bucket_number("cell").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bitmap")
    )


def mark_members(rows: DataFrame, key: str, bitmaps: DataFrame, bits: int) -> DataFrame:
    """Add ``maybe``: false only for rows whose key certainly is not in the filter."""
    maybe = F.lit(True)
    for p in range(PROBES):
        side = bitmaps.select(
            F.col("bucket").alias(f"_bucket{p}"), F.col("bitmap").alias(f"_bitmap{p}")
        )
        cell = _cell(key, p, bits)
        rows = rows.withColumn(f"_cell{p}", cell)
        # At most MOST_BITS / 8 bytes.
        rows = rows.join(
            F.broadcast(side), F.bitmap_bucket_number(f"_cell{p}") == F.col(f"_bucket{p}"), "left"
        )
        at = F.bitmap_bit_position(f"_cell{p}")
        byte = F.conv(
            F.hex(F.substring(F.col(f"_bitmap{p}"), (at / 8).cast("int") + 1, F.lit(1))), 16, 10
        ).cast("long")
        maybe = maybe & F.coalesce(F.getbit(byte, at % 8) == 1, F.lit(False))
    spare = [f"{c}{p}" for p in range(PROBES) for c in ("_cell", "_bucket", "_bitmap")]
    return rows.withColumn("maybe", maybe).drop(*spare)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Group of equal texts of every row: (id, keep_id, group_size, kept, text_sha256).

    Texts are read once and turned into digests; rows whose digest the filter knows to be
    single keep their place, the others are counted per digest (combined per task first) and
    joined back, where the optimizer splits a group of many copies. The largest id of a group
    stays. A null text is an empty one; a null id stays only if its whole group has none;
    equal rows share one fate; an empty table gives an empty result; other columns are ignored.
    """
    rows = store(
        docs.select(F.col(id_col).alias("doc_id"), digest(F.col(text_col)).alias("text_sha256"))
    )
    bits = filter_bits(rows.count())
    bitmaps = store(repeat_filter(rows, "text_sha256", bits), narrow=True)
    marked = mark_members(rows, "text_sha256", bitmaps, bits)
    single = marked.where(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        "text_sha256",
    )
    maybe = store(marked.where("maybe").drop("maybe"))
    # Written apart, so that the join has two exchanges and a hot digest can be split.
    groups = store(
        maybe.groupBy("text_sha256").agg(
            F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
        )
    )
    repeated = maybe.join(groups, "text_sha256").select(
        "doc_id", "keep_id", "group_size", "text_sha256"
    )
    return single.unionByName(repeated).select(
        F.col("doc_id").alias(id_col), "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` without repeated texts, all columns kept; the largest id stays.

    Which rows go is found on ids and digests alone, as in :func:`exact_groups`. A second filter, of
    the rows that go or have a twin, is held against the texts: rows that it clears never leave
    their task, and only the others shuffle, once, to meet the list of those that go. Rows
    equal in id and text count as one row. Nulls as in :func:`exact_groups`.
    """
    key = digest(F.col(text_col))
    rows = store(docs.select(F.col(id_col).alias("_id"), key.alias("_sha")))
    bits = filter_bits(rows.count())
    bitmaps = store(repeat_filter(rows, "_sha", bits), narrow=True)
    counted = mark_members(rows, "_sha", bitmaps, bits).where("maybe").groupBy("_sha", "_id").agg(
        F.count(F.lit(1)).alias("_c")
    )
    counted = store(counted)
    stays = store(counted.groupBy("_sha").agg(F.max("_id").alias("_keep")))
    fate = store(
        counted.join(stays, "_sha").select(
            "_sha", "_id", (~F.col("_id").eqNullSafe(F.col("_keep"))).alias("_goes"), "_c"
        ).where("_goes or _c > 1").select("_sha", "_id", "_goes", _pair("_id", "_sha").alias("_pair"))
    )
    bits = filter_bits(fate.count())
    bitmaps = store(member_filter(fate, "_pair", bits), narrow=True)
    own = docs.withColumn("_sha", key).withColumn("_pair", _pair(id_col, "_sha"))
    marked = mark_members(own, "_pair", bitmaps, bits)
    goes = fate.where("_goes").select(F.col("_id").alias("_id2"), F.col("_sha").alias("_sha2"))
    met = (F.col("_sha") == F.col("_sha2")) & F.col(id_col).eqNullSafe(F.col("_id2"))
    left = marked.where("maybe").join(goes, met, "left_anti").dropDuplicates([id_col, "_sha"])
    return marked.where(~F.col("maybe")).unionByName(left).select(*docs.columns)


def _pair(id_col: str, sha: str) -> Column:
    return F.concat_ws(":", F.col(id_col).cast("string"), F.col(sha))
