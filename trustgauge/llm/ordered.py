"""Order-preserving packing: window cuts in a run of documents by dynamic programming."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trustgauge.llm.common import by_bytes
from trustgauge.sources.shipping import ship_package


@dataclass(frozen=True)
class Settings:
    """Room of a window, the id that ends a document, and what a plan pays for.

    A padding token costs ``padding``, a window ``window``; a cut inside a document costs
    ``sentence`` at the end of a sentence or line, ``word`` before a blank and ``token`` elsewhere.
    A run of ``stride`` ids without the end of a sentence offers a cut before a word, other places
    do only where that leaves ``far`` ids without.
    ``block`` ids are planned at a time; the last ``ahead`` windows of a block are planned again
    with the next.
    """

    capacity: int = 1024
    end_id: int = 0
    padding: int = 4
    window: int = 16
    sentence: int = 4
    word: int = 8
    token: int = 32
    stride: int = 8
    far: int = 64
    block: int = 1 << 19
    ahead: int = 16


class _Encoder:
    """Ids of a byte-level vocabulary, and which of them end a sentence or begin with a blank."""

    def __init__(self, path: str):
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            stated = json.load(file)
        vocab = stated["model"]["vocab"]
        special = {t["content"]: t["id"] for t in stated["added_tokens"]}
        spelled = _byte_letters()
        ranks = {bytes(spelled[c] for c in t): i for t, i in vocab.items() if t not in special}
        self.whole = Tokenizer.from_file(path)
        self.quick = tiktoken.Encoding(
            "vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special
        )
        size = max(*ranks.values(), *special.values()) + 1
        self.stop, self.line, self.blank = (np.zeros(size, dtype=bool) for _ in range(3))
        for token, i in ranks.items():
            self.stop[i] = token.rstrip(b"\"')]").endswith((b".", b"!", b"?"))
            self.line[i] = token.endswith(b"\n")
            self.blank[i] = token[:1].isspace()

    def ids(self, text: str) -> np.ndarray:
        """Ids of a text; its special tokens are found, none are added.

        Both encoders give the same ids; one gives up on very long runs of blanks.
        """
        try:
            return self.quick.encode_to_numpy(text, allowed_special="all").astype("<u4")
        except ValueError:
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4")


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


_encoders: dict[str, _Encoder] = {}


def _encoder(path: str) -> _Encoder:
    if path not in _encoders:
        _encoders[path] = _Encoder(path)
    return _encoders[path]


def cut_places(ids: np.ndarray, encoder, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Places where a document may be cut, its end included, and what a cut there costs.

    ``ids`` ends in the document's end id. No two neighbouring places are further than ``far``
    apart.
    """
    price = np.full(len(ids) + 1, -1, dtype=np.int64)
    if len(ids) > 2:
        own = ids[:-1]
        blank = encoder.blank[own[1:]]
        sentence = np.flatnonzero(encoder.line[own[:-1]] | (encoder.stop[own[:-1]] & blank)) + 1
        word = np.flatnonzero(blank) + 1
        cell, taken = word // settings.stride, np.zeros(len(own) // settings.stride + 1, dtype=bool)
        taken[sentence // settings.stride] = True
        free = ~taken[cell]
        free[1:] &= cell[1:] != cell[:-1]
        price[word[free]] = settings.word
        price[sentence] = settings.sentence
    price[len(ids)] = 0
    places = np.flatnonzero(price >= 0)
    gaps = places.copy()
    gaps[1:] -= places[:-1]
    if gaps.max() > settings.far:
        for k in np.flatnonzero(gaps > settings.far).tolist():
            inner = np.arange(places[k] - gaps[k] + settings.far, places[k], settings.far)
            price[inner] = settings.token
        places = np.flatnonzero(price >= 0)
    return places, price[places]


def padded(length: int, capacity: int) -> int:
    """Padding tokens of a window: none at a power of two, else up to the capacity."""
    return 0 if length & (length - 1) == 0 else capacity - length


def plan_cuts(places: np.ndarray, prices: np.ndarray, settings: Settings) -> list[int]:
    """Indices of the places to cut at, the last one included, for the least total cost.

    ``keys[j]`` is the least cost of windows that end at place j, plus ``padding`` times the place:
    a padded window adds the same to the key of any start, so among starts within reach that
    of the least key is best. A queue that rises in the key holds the candidates, and each place
    enters and leaves it once. Windows of a power of two, which need no padding, are tried
    besides, where a place lies that far back.
    """
    room, pad, each = settings.capacity, settings.padding, settings.window
    at = np.append(0, places)
    index = np.full(int(at[-1]) + 1, -1, dtype=np.int64)
    index[at] = np.arange(len(at))
    ends, starts, saved = [], [], []
    size = 1
    while size < room:
        back = at - size
        j = np.flatnonzero(back >= 0)
        i = index[back[j]]
        ends.append(j[i >= 0])
        starts.append(i[i >= 0])
        saved.append(np.full(len(starts[-1]), pad * (room - size)))
        size *= 2
    ends, starts, saved = map(np.concatenate, (ends, starts, saved))
    order = np.argsort(ends, kind="stable")
    # Where the windows without padding that end at each place begin in the lists.
    stops = np.searchsorted(ends[order], np.arange(len(at)), "right").tolist()
    starts, saved = starts[order].tolist(), saved[order].tolist()
    first = np.searchsorted(at, at - room).tolist()
    price = [0, *(prices + (each + pad * room)).tolist()]
    keys, back = [0] * len(at), [0] * len(at)
    queue, head, hit, key = [0] * len(at), 0, 0, 0
    tail = -1
    for j in range(1, len(at)):
        while tail >= head and keys[queue[tail]] > key:
            tail -= 1
        tail += 1
        queue[tail] = j - 1
        reach = first[j]
        while queue[head] < reach:
            head += 1
        start = queue[head]
        key = keys[start]
        stop = stops[j]
        while hit < stop:
            i = starts[hit]
            other = keys[i] - saved[hit]
            if other < key:
                key, start = other, i
            hit += 1
        key += price[j]
        keys[j] = key
        back[j] = start
    cuts, j = [], len(at) - 1
    while j:
        cuts.append(j)
        j = back[j]
    return [k - 1 for k in reversed(cuts)]


class _Run:
    """Documents of a task in their order, planned and given out block by block."""

    def __init__(self, encoder, settings: Settings, with_ids: bool):
        self.encoder, self.settings, self.with_ids = encoder, settings, with_ids
        self.sequence = TaskContext.get().partitionId() << 40
        self.tokens = np.empty(0, dtype="<u4")
        self.places = self.prices = np.empty(0, dtype=np.int64)
        # Of each document in the buffer: its row, its length, and where its first id would lie.
        self.rows, self.totals, self.origins = [], [], []
        self.waiting: list[tuple] = []
        self.size = 0

    def add(self, row, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        places, prices = cut_places(ids, self.encoder, self.settings)
        self.rows.append(row)
        self.totals.append(len(ids))
        self.origins.append(self.size)
        at = 0
        while at < len(ids):
            to = min(len(ids), at + self.settings.block)
            a, b = np.searchsorted(places, [at, to], "right")
            self.waiting.append((ids[at:to], places[a:b] - at + self.size, prices[a:b]))
            self.size += to - at
            at = to
            if self.size >= self.settings.block:
                yield self.give(False)

    def give(self, last: bool) -> pa.RecordBatch:
        """Pieces of all windows, but for the last ones as long as more documents may come."""
        tokens, places, prices = (
            np.concatenate([x, *new])
            for x, new in zip(
                (self.tokens, self.places, self.prices), zip(*self.waiting, strict=True) if self.waiting else ((),) * 3,
                strict=True,
            )
        )
        self.waiting = []
        cuts = np.append(0, places[plan_cuts(places, prices, self.settings)]) if len(places) else np.zeros(1, np.int64)
        if not last:
            cuts = cuts[: max(2, len(cuts) - self.settings.ahead)]
        done = int(cuts[-1])
        origins = np.array(self.origins, dtype=np.int64)
        begins = np.unique(np.concatenate([cuts[:-1], origins[(origins >= 0) & (origins < done)]]))
        ends = np.append(begins[1:], done)[: len(begins)]
        which = np.searchsorted(origins, begins, "right") - 1
        window = np.searchsorted(cuts, begins, "right") - 1
        held = [tokens[a:b] for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
        columns = {
            "id": pa.array([self.rows[k] for k in which], pa.int64()),
            "start": pa.array(begins - origins[which] if len(which) else begins),
            "length": pa.array(ends - begins),
            "ids_crc32": pa.array([zlib.crc32(h) for h in held], pa.int64()),
            "doc_tokens": pa.array([self.totals[k] for k in which], pa.int64()),
            "sequence_id": pa.array(window + self.sequence),
            "offset": pa.array(begins - cuts[window] if len(which) else begins),
        }
        if self.with_ids:
            columns["ids"] = pa.array([h.astype(np.int32) for h in held], pa.list_(pa.int32()))
        self.sequence += len(cuts) - 1
        self.tokens, kept = tokens[done:], places > done
        self.places, self.prices = places[kept] - done, prices[kept]
        self.size -= done
        first = max(0, int(np.searchsorted(origins, done, "right")) - 1)
        if last:
            first = len(origins)
        self.rows, self.totals = self.rows[first:], self.totals[first:]
        self.origins = (origins[first:] - done).tolist()
        return pa.RecordBatch.from_pydict(columns)


def _pack(path: str, settings: Settings, with_ids: bool):
    tail = np.array([settings.end_id], dtype="<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        held = _Run(encoder, settings, with_ids)
        for batch in batches:
            for part in by_bytes(batch, "text"):
                for row, text in zip(part.column("id").to_pylist(), part.column("text"), strict=True):
                    yield from held.add(row, np.append(encoder.ids(text.as_py()), tail))
        yield held.give(True)

    return run


def pack_in_order(
    docs: DataFrame,
    tokenizer_path: str,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
    order_by: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents in windows of up to ``capacity`` ids, the order of rows kept:
    (id, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]).

    A document is its ids by the tokenizer followed by ``end_id``; ``tokenizer_path`` names a
    byte-level vocabulary. Each task plans the windows over its rows in their order, or in that
    of ``order_by`` after a sort by range. A window's padding fills it up to the capacity, unless
    its length is a power of two. Cuts are chosen for the least sum of padding and penalties for
    cut documents, sentences and words, so a document may span windows and a window may hold
    pieces of many documents. Nothing is shuffled, and a task holds one block of ids and one
    document at a time, whatever the length of either table or text. Only its last window
    cannot look for company beyond the task. Sequence ids tell windows apart and have no other
    meaning; a task that runs again gives the same rows.

    A null or empty text is its end id alone. Equal rows and rows that share an id are packed
    each on its own; a null id stays null. Other columns are not read. An empty table gives
    an empty result.
    """
    ship_package(docs.sparkSession)
    if order_by:
        docs = docs.repartitionByRange(order_by).sortWithinPartitions(order_by)
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    schema = "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return rows.mapInArrow(
        _pack(tokenizer_path, settings, with_ids), schema + (", ids array<int>" if with_ids else "")
    )
