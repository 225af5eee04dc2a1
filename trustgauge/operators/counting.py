"""Terms of many documents counted together inside a task: Arrow and numpy over slices of a batch.

A document comes as its tokens with a blank between them. Rows that share their keys are one document
of several texts, which BREAK stands between: no term reaches from one text into the next.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# No token holds it.
BREAK = "\n"
# Bytes of tokens that are cut into terms at once, or one longer document.
SLICE_BYTES = 4 << 20


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about SLICE_BYTES of words each."""
    ends = np.cumsum(pc.binary_length(batch.column("words")).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        seen = int(ends[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(ends, seen + SLICE_BYTES, "right")))
        yield batch.slice(at, to - at)
        at = to


def cut(words: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Row and code of every token, the tokens by code, and where two neighbours are of one text."""
    lists = pc.split_pattern(words, " ")
    flat = lists.flatten().dictionary_encode()
    rows = np.repeat(np.arange(len(words)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    codes = flat.indices.to_numpy().astype(np.int64)
    known = flat.dictionary
    void = pc.is_in(known, value_set=pa.array(["", BREAK], known.type)).to_numpy(zero_copy_only=False)
    real = ~void[codes]
    joint = (rows[1:] == rows[:-1]) & real[1:] & real[:-1]
    # Places of tokens; a break between two of them has ended the neighbourhood already.
    places = np.flatnonzero(real)
    after = np.zeros(len(places), dtype=bool)
    if len(places) > 1:
        after[:-1] = (np.diff(places) == 1) & joint[places[:-1]]
    return rows[places], codes[places], known, after


def grams(words: pa.Array, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """For each width: the row and code of every n-gram in text order, and the n-grams by code."""
    rows, codes, known, after = cut(words)
    tokens, singles = codes, known
    # Whether the n-gram at a token is followed by one more token of its text.
    more = after
    places = np.arange(len(codes))
    for width in range(1, high + 1):
        if width > 1:
            keep = more[places + width - 2] if len(places) else np.zeros(0, dtype=bool)
            places, heads = places[keep], codes[keep]
            pairs = heads * len(singles) + tokens[places + width - 1]
            found, codes = np.unique(pairs, return_inverse=True)
            known = pc.binary_join_element_wise(
                known.take(pa.array(found // max(1, len(singles)))), singles.take(pa.array(found % max(1, len(singles)))), " "
            )
        if width >= low:
            yield rows[places], codes, known


def pair_counts(rows: np.ndarray, codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of row and code, by row, then code, and how often each occurs."""
    found, counts = np.unique(rows * max(1, size) + codes, return_counts=True)
    return found // max(1, size), found % max(1, size), counts


def frequencies(low: int, high: int, members: int):
    """Per slice: every term with its occurrences and documents, each counted ``times`` per member."""
    names = ["term"] + [f"{k}{m}" for m in range(members) for k in ("tf", "df")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                times = part.column("times").flatten().to_numpy(zero_copy_only=False).reshape(-1, members)
                for rows, codes, known in grams(part.column("words"), low, high):
                    row, code, count = pair_counts(rows, codes, len(known))
                    # The break and the empty token never occur.
                    met = np.bincount(code, minlength=len(known)) > 0
                    columns = [known.cast(pa.string()).filter(pa.array(met))]
                    for m in range(members):
                        own = times[row, m]
                        for value in (count * own, own):
                            sums = np.bincount(code, value, len(known))
                            columns.append(pa.array(np.rint(sums[met]).astype(np.int64)))
                    yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _matched(part: pa.RecordBatch, low: int, high: int, terms: pa.Array):
    """Row and vocabulary place of every known occurrence."""
    rows, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for row, code, known in grams(part.column("words"), low, high):
        place = pc.fill_null(pc.index_in(known, value_set=terms), -1).to_numpy().astype(np.int64)[code]
        rows.append(row[place >= 0])
        places.append(place[place >= 0])
    return np.concatenate(rows), np.concatenate(places)


def _lists(row: np.ndarray, rows: int, values: pa.Array) -> pa.Array:
    """Values that are sorted by row, as one list a row."""
    ends = np.searchsorted(row, np.arange(rows), "right").astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(np.append(np.int32(0), ends).astype(np.int32)), values)


def weighted(shared, keys: int, low: int, high: int):
    """Documents as their tf-idf cells under each vocabulary of ``shared``: (keys..., member, features)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, members = shared.value
        for batch in batches:
            for part in slices(batch):
                row, place, count = pair_counts(*_matched(part, low, high, terms), len(terms))
                damped = 1.0 + np.log(count)
                for m, (numbers, idfs) in enumerate(members):
                    mine = numbers[place] >= 0
                    at, idx = row[mine], numbers[place[mine]]
                    w = damped[mine] * idfs[place[mine]]
                    order = np.lexsort((idx, at))
                    at, idx, w = at[order], idx[order], w[order]
                    norm = np.sqrt(np.bincount(at, w * w, part.num_rows))
                    cells = pa.StructArray.from_arrays(
                        [pa.array(idx.astype(np.int32)), pa.array(w / norm[at])], ["idx", "w"]
                    )
                    columns = [part.column(k) for k in range(keys)]
                    columns += [pa.array(np.full(part.num_rows, m, dtype=np.int32)), _lists(at, part.num_rows, cells)]
                    names = [*part.schema.names[:keys], "member", "features"]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return run


def encoded(shared, keys: int):
    """Documents as the places of their known tokens: (keys..., token_ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, numbers = shared.value
        for batch in batches:
            for part in slices(batch):
                row, code, known, after = cut(part.column("words"))
                place = pc.fill_null(pc.index_in(known, value_set=terms), -1).to_numpy().astype(np.int64)[code]
                # Texts of one document side by side: position first.
                at = np.arange(len(row))
                first = np.ones(len(row), dtype=bool)
                first[1:] = ~after[:-1]
                at -= np.maximum.accumulate(np.where(first, at, 0)) if len(at) else at
                # Tokens of one text are in their order already.
                several = np.count_nonzero(first) > np.count_nonzero(np.diff(row)) + 1
                mine = place >= 0
                row, at, idx = row[mine], at[mine], numbers[place[mine]]
                if several:
                    order = np.lexsort((idx, at, row))
                    row, idx = row[order], idx[order]
                columns = [part.column(k) for k in range(keys)]
                columns.append(_lists(row, part.num_rows, pa.array(idx.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names[:keys], "token_ids"])

    return run
