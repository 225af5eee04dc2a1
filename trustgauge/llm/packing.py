"""Best-fit packing: token pieces into sequences by minimum bin slack."""

from __future__ import annotations

import struct
import sys
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustgauge.llm.common import running, store
from trustgauge.sources.shipping import ship_package

CAPACITY = 4096
END_ID = 1
SLICE_BYTES = 16 << 20
# Bytes of runs of text and their ids that a worker remembers from task to task, and the longest
# run, in characters, that it remembers: text without blanks is one run, which seldom comes again.
REMEMBERED_BYTES, REMEMBERED_RUN = 64_000_000, 64

# Below this, letters are composed and lower-cased one by one.
LATIN_END = "\u0250"
# Marks that make one unit together.
MARKS = ".,!?;:#$%&*"

_encoders: dict[str, "_Encoder"] = {}


def _ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class _Memory(dict):
    """Remembers what ``make`` gives for a short key, as long as all of it fits into ``room`` bytes."""

    # What an entry takes in the table itself.
    ENTRY = 104

    def __init__(self, make, room: int = REMEMBERED_BYTES):
        super().__init__()
        self.make, self.room = make, room

    def __missing__(self, key: str) -> bytes:
        ids = self.make(key)
        if len(key) <= REMEMBERED_RUN and self.room > 0:
            self.room -= sys.getsizeof(key) + sys.getsizeof(ids) + self.ENTRY
            self[key] = ids
        return ids


class _Encoder:
    """Token ids of texts, each distinct run of characters between blanks encoded once.

    The tokenizer drops white space and never looks across it, so a text's ids are those of
    its runs in a row. A run of Latin letters, with punctuation after it or not, is cut here;
    any other is normalised and cut by the tokenizer itself. Every unit goes to its model.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.units = _Memory(self._unit, REMEMBERED_BYTES // 2)
        self.runs = _Memory(self._run)

    def _unit(self, unit: str) -> bytes:
        """Ids of one unit of normalised text."""
        spelled = unit if unit.isascii() else self.tokenizer.pre_tokenizer.pre_tokenize_str(unit)[0][0]
        return _ids([t.id for t in self.tokenizer.model.tokenize(spelled)])

    def _run(self, run: str) -> bytes:
        letters = run.rstrip(MARKS)
        lower = letters.lower()
        # The dotted I lower-cases to a letter and a mark, which may join the marks after it.
        if letters.isalpha() and lower.isalpha() and max(letters) < LATIN_END:
            marks = run[len(letters) :]
            ids = self.units[lower]
            return ids + self.units[marks] if marks else ids
        # Special tokens in a text are found by the whole tokenizer only.
        return _ids(self.tokenizer.encode(run, add_special_tokens=False).ids)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit numbers."""
        return b"".join(map(self.runs.__getitem__, text.replace("\n", " ").split(" ")))


def _encoder(path: str) -> _Encoder:
    if path not in _encoders:
        _encoders[path] = _Encoder(path)
    return _encoders[path]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    sizes = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        seen = int(sizes[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, seen + SLICE_BYTES, "right")))
        yield batch.slice(at, to - at)
        at = to


def _cut(path: str, capacity: int, end_id: int, with_ids: bool):
    tail = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in batches:
            for part in _slices(batch):
                which, piece, size, crc, held = [], [], [], [], []
                for k, text in enumerate(part.column("text").to_pylist()):
                    ids = encoder.encode(text) + tail
                    for p, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at : at + 4 * capacity]
                        which.append(k)
                        piece.append(p)
                        size.append(len(own) // 4)
                        crc.append(zlib.crc32(own))
                        if with_ids:
                            held.append(np.frombuffer(own, dtype="<u4").astype(np.int32))
                piece = np.array(piece, dtype=np.int32)
                columns = {
                    "id": part.column("id").take(pa.array(which, pa.int64())),
                    "piece": pa.array(piece),
                    "start": pa.array(piece.astype(np.int64) * capacity),
                    "length": pa.array(size, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array(held, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)

    return run


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Token pieces of every document: (id, piece, start, length, ids_crc32[, ids]).

    A document is its ids followed by ``end_id``; a null text is empty. Only a document of more
    than ``capacity`` ids is cut, into pieces of that length and a rest.
    """
    ship_package(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    schema = "id long, piece int, start long, length long, ids_crc32 long"
    schema += ", ids array<int>" if with_ids else ""
    return rows.mapInArrow(_cut(tokenizer_path, capacity, end_id, with_ids), schema)


def fullest(lengths: list[int], counts: dict[int, int], room: int) -> list[int]:
    """Lengths, each used as often as there are pieces of it, whose sum comes nearest to ``room``.

    ``lengths`` ascends. Bit s of ``reach`` says that some combination adds up to s; a step adds
    one length, its count split into powers of two, until the room can be filled, and the steps
    are walked back from the fullest sum.
    """
    reach, steps = 1, []
    limit = (1 << (room + 1)) - 1
    for k in range(bisect_right(lengths, room) - 1, -1, -1):
        length = lengths[k]
        left, times = min(counts[length], room // length), 1
        while left:
            times = min(times, left)
            grown = (reach | (reach << (length * times))) & limit
            if grown != reach:
                steps.append((length, times, reach))
                reach = grown
            left -= times
            times *= 2
        if reach >> room & 1:
            break
    at, used = reach.bit_length() - 1, []
    for length, times, before in reversed(steps):
        if not before >> at & 1:
            used += [length] * times
            at -= length * times
    return used


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Bins as (lengths, how many bins are alike), filled one kind after the other.

    Each bin starts with the longest piece left and takes the fullest feasible combination of
    the rest, which is then removed as often as the pieces allow. Work and result follow the
    number of distinct lengths, at most ``capacity``, not the number of pieces.
    """
    left = {length: n for length, n in histogram.items() if n}
    lengths = sorted(left)
    bins = []
    while lengths:
        longest = lengths[-1]
        left[longest] -= 1
        need = Counter([longest, *fullest(lengths, left, capacity - longest)])
        left[longest] += 1
        times = min(left[x] // k for x, k in need.items())
        for x, k in need.items():
            left[x] -= k * times
            if not left[x]:
                del lengths[bisect_left(lengths, x)]
        bins.append((sorted(need.elements(), reverse=True), times))
    return bins


def _slots(bins: list[tuple[list[int], int]], capacity: int) -> dict[str, np.ndarray]:
    """Where the r-th piece of each length goes: runs sorted by length and first rank."""
    rows, used, sequence = [], {}, 0
    for lengths, times in bins:
        offset = 0
        for x in dict.fromkeys(lengths):
            k = lengths.count(x)
            rows.append((x * (1 << 40) + used.get(x, 0), used.get(x, 0), k, sequence, offset))
            used[x] = used.get(x, 0) + k * times
            offset += k * x
        sequence += times
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 5)
    return dict(zip(("key", "rank", "each", "sequence", "offset"), table.T, strict=True))


def _place(slots):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = slots.value
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank_in_length").to_numpy()
            run_ = np.searchsorted(table["key"], length * (1 << 40) + rank, "right") - 1
            bin_, inside = np.divmod(rank - table["rank"][run_], table["each"][run_])
            sequence = table["sequence"][run_] + bin_
            offset = table["offset"][run_] + inside * length
            keep = [i for i, c in enumerate(batch.schema.names) if c != "rank_in_length"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in keep), pa.array(sequence), pa.array(offset)],
                [*(batch.schema.names[i] for i in keep), "sequence_id", "offset"],
            )

    return run


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces with (id, piece, ..., length).

    The number of pieces per length, at most ``capacity`` rows, decides on the driver which
    lengths share a sequence; each piece then finds its place from its rank within its
    length. Ranks come from an order cut into ranges, so no length, however common, meets in
    one task. Plan and lookup are bounded by the capacity and go to every task.
    """
    spark = pieces.sparkSession
    ship_package(spark)
    pieces = store(pieces)
    order = [F.col(c) for c in pieces.columns if c not in ("length", "ids")]
    ranked = store(running(pieces, [F.col("length"), *order]))
    by_length = ranked.groupBy("length").agg(F.count(F.lit(1)).alias("n"), F.min("rank").alias("first"))
    lengths = by_length.orderBy("length").limit(capacity).collect()
    bins = plan_bins({r["length"]: r["n"] for r in lengths}, capacity)
    slots = spark.sparkContext.broadcast(_slots(bins, capacity))
    firsts = F.broadcast(spark.createDataFrame(
        [(r["length"], r["first"]) for r in lengths], "length long, first long"
    ))
    met = ranked.join(firsts, "length").withColumn("rank_in_length", F.col("rank") - F.col("first"))
    met = met.select(*pieces.columns, "rank_in_length")
    fields = ", ".join(f"{c} {t}" for c, t in pieces.dtypes)
    return met.mapInArrow(_place(slots), f"{fields}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, **settings
) -> DataFrame:
    """Pieces of all documents with their places: token_pieces, then pack.

    Equal rows are packed each on its own; a null id is an id; an empty table gives an empty
    result.
    """
    return pack(token_pieces(docs, tokenizer_path, capacity, **settings), capacity)
