"""Substring deduplication: windows of words that occur earlier are removed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustgauge.llm import wordhash as wh
from trustgauge.llm.common import store
from trustgauge.sources.shipping import ship_package
from trustgauge.sources.workspace import shuffle_width

WINDOW = 20
# Text hashed together: windows that repeat within it are told apart before any shuffle.
SLICE_BYTES = 8 << 20
# Words in the runs that say which bucket a window belongs to.
ANCHOR = 3
# An anchor with more than this part of a bucket's even share of windows is dealt by whole windows;
# in a slice, anchors of fewer windows are not counted.
HOT_SHARE, COUNTED = 0.25, 64
BASES = (0xB5297A4D2F1C9E37, 0x68E31DA4C3A5B1D9)

BLOCK_SCHEMA = (
    "bucket int, settled boolean, ids binary, tags binary, counts binary, starts binary, "
    "high binary, low binary"
)
MARK_SCHEMA = "id long, tag long, starts binary"
RESULT = "n_words long, n_removed long, removed array<struct<start: long, end: long>>, kept_text string"


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Cut a batch where its text passes SLICE_BYTES; one longer text stays whole."""
    sizes = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        seen = int(sizes[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, seen + SLICE_BYTES, "right")))
        yield batch.slice(at, to - at)
        at = to


def _anchors(words: np.ndarray, width: int) -> np.ndarray:
    """The least hash among the short runs of the window that begins at each word."""
    least = wh.windows(words, min(ANCHOR, width), BASES[1])
    count, have = width - min(ANCHOR, width) + 1, 1
    while have < count:
        step = min(have, count - have)
        least = np.minimum(least[: len(least) - step], least[step:])
        have += step
    return least


def _homes(anchors: np.ndarray, high: np.ndarray, hot: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each window: by its anchor, or by its own hash if the anchor is a hot one.

    Neighbouring windows mostly share their anchor and so a bucket, which keeps the pieces of a
    document together; equal windows always do, hot or not.
    """
    key = anchors
    if len(hot):
        at = np.minimum(np.searchsorted(hot, anchors), len(hot) - 1)
        key = np.where(hot[at] == anchors, high, anchors)
    return (wh.mix(key, 5) % np.uint64(buckets)).astype(np.int32)


def _first_words(part: pa.RecordBatch, width: int) -> tuple[np.ndarray, ...]:
    """Words of a slice, and of each window its text, its start there and its place among the words."""
    words, first = wh.hash_words(part.column("text").combine_chunks() if isinstance(part, pa.Table) else part.column("text"))
    n = np.maximum(np.diff(first) - width + 1, 0)
    doc = np.repeat(np.arange(len(n)), n)
    start = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return words, doc, start, first[doc] + start


def _count_anchors(width: int):
    """Windows per anchor, of those that many windows of a slice share; anchor null counts all windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                words, _, _, at = _first_words(part, width)
                found = np.sort(_anchors(words, width)[at])
                edges = np.append(np.flatnonzero(np.append(True, found[1:] != found[:-1])), len(found)) if len(found) else np.zeros(1, int)
                counts = np.diff(edges)
                many = counts >= COUNTED
                anchors = pa.array(found[edges[:-1]][many].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([pa.nulls(1, pa.int64()), anchors]), pa.array(np.append(len(found), counts[many]))],
                    ["anchor", "n"],
                )

    return run


def hot_anchors(docs: DataFrame, width: int, buckets: int, share: float | None = None) -> np.ndarray:
    """Anchors with more windows than a part of a bucket's even share, sorted.

    Counted over all texts. An anchor that is left out though it has as many is met by fewer than
    COUNTED windows in every slice. There are fewer than ``buckets / share`` of them.
    """
    share = share or HOT_SHARE
    sums = docs.select("text").mapInArrow(_count_anchors(width), "anchor long, n long").groupBy("anchor").agg(
        F.sum("n").alias("n")
    )
    sums = store(sums, narrow=True)
    total = (sums.where("anchor IS NULL").select("n").first() or [0])[0]
    bound = total * share / buckets
    found = sums.where(F.col("anchor").isNotNull() & (F.col("n") > bound)).select("anchor").toPandas()
    return np.sort(found["anchor"].to_numpy(dtype=np.int64).view(np.uint64))


def _deal(bucket, settled, doc, start, ids, tags, high=None, low=None) -> Iterator[dict]:
    """One row per bucket; the windows come ordered by document and start."""
    order = np.argsort(bucket, kind="stable")
    b, d, s = bucket[order], doc[order], start[order]
    edges = np.append(np.flatnonzero(np.append(True, b[1:] != b[:-1])), len(b)) if len(b) else [0]
    for lo, hi in zip(edges[:-1], edges[1:], strict=True):
        dd, ss = d[lo:hi], s[lo:hi]
        new = np.append(True, dd[1:] != dd[:-1])
        at = np.flatnonzero(new)
        gaps = np.where(new, ss, ss - np.append(0, ss[:-1])).astype(np.uint32)
        which = order[lo:hi]
        yield {
            "bucket": int(b[lo]), "settled": settled,
            "ids": wh.planes(ids[dd[at]]), "tags": wh.planes(tags[dd[at]].astype(np.uint32)),
            "counts": wh.planes(np.diff(np.append(at, hi - lo)).astype(np.uint32)),
            "starts": wh.planes(gaps),
            "high": b"" if high is None else high[which].tobytes(),
            # 24 bits next to the other 64.
            "low": b"" if low is None else wh.planes(low[which].astype(np.uint32))[: 3 * (hi - lo)],
        }


def _undeal(row: dict) -> tuple[np.ndarray, ...]:
    counts = wh.from_planes(row["counts"], np.uint32).astype(np.int64)
    gaps = wh.from_planes(row["starts"], np.uint32).astype(np.int64)
    first = np.cumsum(counts) - counts
    run = np.cumsum(gaps)
    start = run - np.repeat(run[first] - gaps[first], counts)
    ids = np.repeat(wh.from_planes(row["ids"], np.int64), counts)
    tags = np.repeat(wh.from_planes(row["tags"], np.uint32).astype(np.int64), counts)
    high = np.frombuffer(row["high"], dtype=np.uint64)
    low = wh.from_planes(row["low"] + bytes(len(high)), np.uint32)
    return ids, tags, start, high, low


def _later(high, low, *place) -> tuple[np.ndarray, np.ndarray]:
    """Indices of windows that repeat an earlier one, and of that first one for each.

    Only windows whose first hash is shared are put in full order.
    """
    if not len(high):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    order = np.argsort(high)
    h = high[order]
    same = h[1:] == h[:-1]
    shared = order[np.append(same, False) | np.append(False, same)]
    keys = [p[shared] for p in reversed(place)] + [low[shared], high[shared]]
    shared = shared[np.lexsort(keys)]
    if not len(shared):
        return shared, shared
    new = np.append(
        True, (high[shared][1:] != high[shared][:-1]) | (low[shared][1:] != low[shared][:-1])
    )
    first = shared[np.flatnonzero(new)][np.cumsum(new) - 1]
    return shared[~new], first[~new]


def _map_windows(width: int, buckets: int, hot):
    schema = pa.schema(
        [("bucket", pa.int32()), ("settled", pa.bool_())]
        + [(c, pa.binary()) for c in ("ids", "tags", "counts", "starts", "high", "low")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                rows = pa.Table.from_batches([part]).sort_by([("id", "ascending"), ("tag", "ascending")])
                ids = rows.column("id").to_numpy()
                tags = rows.column("tag").to_numpy()
                # The same document listed twice is looked at once.
                fresh = np.append(True, (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1]))
                if not fresh.all():
                    rows, ids, tags = rows.filter(pa.array(fresh)), ids[fresh], tags[fresh]
                words, doc, start, at = _first_words(rows, width)
                high = wh.windows(words, width, BASES[0])[at]
                bucket = _homes(_anchors(words, width)[at], high, hot.value, buckets)
                low = (wh.windows(wh.mix(words, 1), width, BASES[1])[at] >> np.uint64(40)).astype(np.uint32)
                del words, at
                again, _ = _later(high, low, np.arange(len(high)))
                sent = np.ones(len(high), dtype=bool)
                sent[again] = False
                found = list(
                    _deal(bucket[sent], False, doc[sent], start[sent], ids, tags, high[sent], low[sent])
                )
                again = np.sort(again)
                home = (wh.mix(ids.astype(np.uint64), 3) % np.uint64(buckets)).astype(np.int32)
                found += _deal(home[doc[again]], True, doc[again], start[again], ids, tags)
                for lo in range(0, len(found), 64):
                    yield pa.RecordBatch.from_pylist(found[lo : lo + 64], schema=schema)

    return run


def _judge_bucket(table: pa.Table) -> pa.Table:
    """Later windows of one bucket, gathered per document."""
    rows = table.to_pylist()
    parts = [_undeal(r) for r in rows if not r["settled"]]
    done = [_undeal(r)[:3] for r in rows if r["settled"]]
    del rows
    if parts:
        ids, tags, starts, high, low = (np.concatenate(p) for p in zip(*parts, strict=True))
        del parts
        again, first = _later(high, low, ids, tags, starts)
        other = (ids[again] != ids[first]) | (tags[again] != tags[first]) | (starts[again] != starts[first])
        again = again[other]
        done.append((ids[again], tags[again], starts[again]))
    ids, tags, starts = (np.concatenate(p) for p in zip(*done, strict=True))
    order = np.lexsort((starts, tags, ids))
    ids, tags, starts = ids[order], tags[order], starts[order].astype(np.int32)
    new = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1]))) if len(ids) else []
    edges = np.append(new, len(ids)).astype(int)
    return pa.table(
        {
            "id": pa.array(ids[new] if len(ids) else [], pa.int64()),
            "tag": pa.array(tags[new] if len(ids) else [], pa.int64()),
            "starts": pa.array(
                [starts[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)], pa.binary()
            ),
        }
    )


def repeated_windows(docs: DataFrame, width: int = WINDOW, buckets: int | None = None) -> DataFrame:
    """Starts of all windows that also start earlier: (id, tag, starts).

    ``docs`` has (id, tag, text) without nulls. Every window's hash (64 and 24 bits) goes to
    one of ``buckets`` groups, by default four times spark.sql.shuffle.partitions, packed with the
    places of other windows; of windows that repeat within a slice of a task only the first
    is sent, so a passage that a third of all documents share meets as few rows as there are
    slices. Windows with a frequent short run spread over all groups. Memory of a group is about
    40 bytes per window of its share.
    """
    spark = docs.sparkSession
    ship_package(spark)
    buckets = buckets or 4 * shuffle_width(spark)
    hot = spark.sparkContext.broadcast(hot_anchors(docs, width, buckets))
    blocks = docs.select("id", "tag", "text").mapInArrow(_map_windows(width, buckets, hot), BLOCK_SCHEMA)
    return blocks.groupBy("bucket").applyInArrow(_judge_bucket, MARK_SCHEMA)


def _cut_out(width: int):
    kept_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def one(text: str, marks: list[bytes] | None):
        words = text.encode().split()
        if not marks:
            return len(words), 0, [], b" ".join(words).decode()
        starts = np.unique(np.frombuffer(b"".join(marks), dtype=np.int32)).astype(np.int64)
        far = np.flatnonzero(np.diff(starts) > width)
        lo = starts[np.append(0, far + 1)]
        hi = starts[np.append(far, len(starts) - 1)] + width
        gone = np.zeros(len(words) + 1, dtype=np.int64)
        gone[lo] += 1
        gone[hi] -= 1
        keep = np.cumsum(gone[:-1]) == 0
        kept = [words[i] for i in np.flatnonzero(keep)]
        spans = [{"start": int(a), "end": int(b)} for a, b in zip(lo, hi, strict=True)]
        return len(words), len(words) - len(kept), spans, b" ".join(kept).decode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                texts, marks = part.column("text").to_pylist(), part.column("marks").to_pylist()
                n, gone, spans, kept = zip(*map(one, texts, marks), strict=True)
                rest = [part.column(i) for i, c in enumerate(part.schema.names) if c not in ("text", "marks")]
                names = [c for c in part.schema.names if c not in ("text", "marks")]
                yield pa.RecordBatch.from_arrays(
                    [*rest, pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                     pa.array(spans, kept_type), pa.array(kept, pa.string())],
                    [*names, "n_words", "n_removed", "removed", "kept_text"],
                )

    return run


def remove_repeats(
    docs: DataFrame, width: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Documents without words covered by a repeated window of ``width`` words.

    Gives (id, n_words, n_removed, removed, kept_text): ``removed`` lists the maximal intervals of
    word places, end exclusive, and the kept words are joined by one space. A window is
    repeated when the same words also start earlier, in a smaller id or earlier in the same
    document; all windows are judged on the input. A null text is empty; a null id comes before all others; rows equal in id
    and text are the same document and share their result; rows that share only the id are told
    apart by a checksum of the text. Texts shuffle once, to meet their marks.
    """
    ship_package(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(
        F.col(id_col).cast("long").alias("_given"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("id"),
        F.crc32(text.cast("binary")).alias("tag"), text.alias("text"),
    )
    marks = store(repeated_windows(keyed, width))
    per_doc = marks.groupBy("id", "tag").agg(F.collect_list("starts").alias("marks"))
    met = keyed.join(per_doc, ["id", "tag"], "left").select("_given", "text", "marks")
    done = met.mapInArrow(_cut_out(width), f"_given long, {RESULT}")
    return done.withColumnRenamed("_given", id_col)
