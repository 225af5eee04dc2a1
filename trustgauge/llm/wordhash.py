"""Hashes of the words of many texts at once, and Rabin-Karp hashes of their windows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
# Bytes hashed in one go: the working arrays take some forty times as much.
BLOCK = 1 << 20

_ODD = 0x9E3779B97F4A7C15
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection for each seed)."""
    x = (x + U((seed * _ODD + 0x632BE59BD9B4E019) % (1 << 64))) * U(0xFF51AFD7ED558CCD)
    x ^= x >> U(32)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(29)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U)
    out[0] = 1
    return np.cumprod(out, dtype=U)


_VALUES = mix(np.arange(256, dtype=U), 7)
_LOWERED = _VALUES.copy()
_LOWERED[65:91] = _VALUES[97:123]
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False
_tables: list[np.ndarray] = [_powers(_BASE, BLOCK), _powers(_INVERSE, BLOCK)]


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse; longer than a block only for a longer word."""
    if n > len(_tables[0]):
        return [_powers(_BASE, n), _powers(_INVERSE, n)]
    return _tables


def _cuts(data: np.ndarray, starts: np.ndarray, end: int) -> list[int]:
    """Ends of blocks, each at a blank or at the start of a text."""
    cuts, at = [], int(starts[0]) if len(starts) else end
    while at < end:
        to = at + BLOCK
        while to < end and _IS_WORD[data[to]]:
            near = np.flatnonzero(~_IS_WORD[data[to : to + 4096]])
            to += int(near[0]) if len(near) else 4096
        to = min(to, end)
        cuts.append(to)
        at = to
    return cuts


def hash_words(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, and the index of each text's first word.

    Words are runs of bytes other than white space; the second array has one entry more than
    there are texts. Texts must not be null. ``lower`` folds A-Z.
    """
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if not len(texts) or offsets[0] == offsets[-1]:
        return np.empty(0, dtype=U), np.zeros(len(texts) + 1, dtype=np.int64)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)
    values = _LOWERED if lower else _VALUES
    starts, end = offsets[:-1], int(offsets[-1])
    hashes, places, at = [], [], int(offsets[0])
    for to in _cuts(data, starts, end):
        block = data[at:to]
        word = _IS_WORD[block]
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1]
        last[:-1] &= ~word[1:]
        inner = starts[np.searchsorted(starts, at, "right") : np.searchsorted(starts, to)] - at
        first[inner] = word[inner]
        last[inner - 1] = word[inner - 1]
        s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
        power, inverse = _power_tables(to - at)
        total = np.zeros(len(block) + 1, dtype=U)
        np.cumsum(values[block] * power[: len(block)], out=total[1:])
        hashes.append(mix((total[e] - total[s]) * inverse[s] + (e - s).astype(U)))
        places.append(s + at)
        at = to
    place = np.concatenate(places)
    return np.concatenate(hashes), np.append(np.searchsorted(place, starts), len(place))


def windows(hashes: np.ndarray, width: int, base: int) -> np.ndarray:
    """Rabin-Karp hash of every ``width`` consecutive values, by doubling.

    The hash is sum(h[i + k] * base^(width - 1 - k)) mod 2^64; windows that cross from one text
    into the next are computed too and left to the caller.
    """
    if len(hashes) < width:
        return np.empty(0, dtype=U)
    run, size, out, done = hashes, 1, None, 0
    while True:
        if width & size:
            # The finished part covers the first ``done`` values of what is left to cover.
            out = run if out is None else (
                run[: len(run) - done] * U(pow(base, done, 1 << 64)) + out[size : size + len(run) - done]
                if len(out) - size >= len(run) - done
                else run[: len(out) - size] * U(pow(base, done, 1 << 64)) + out[size:]
            )
            done += size
        if size * 2 > width:
            return mix(out[: len(hashes) - width + 1], width)
        run = run[:-size] * U(pow(base, size, 1 << 64)) + run[size:]
        size *= 2


def planes(values: np.ndarray) -> bytes:
    """Values byte by byte, all lowest bytes first, which lets zeros compress away."""
    little = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1)
    return np.ascontiguousarray(little.T).tobytes()


def from_planes(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(
        np.frombuffer(data, dtype=np.uint8).reshape(width, -1).T
    ).view(kind).reshape(-1)
