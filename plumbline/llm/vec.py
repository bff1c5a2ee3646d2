"""Words of whole Arrow string columns as 64-bit hashes, by numpy over the column's bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes looked at together; a longer word gets a block of its own length.
BLOCK = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits (xor-shift and multiply rounds), so equal hashes stay equal and others spread."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def _table(fold: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=np.uint64) * _ODD) | np.uint64(1)
    if fold:
        values[65:91] = values[97:123]
    return values


_VALUES = {fold: _table(fold) for fold in (False, True)}
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers modulo 2**64 of an odd base and of its inverse."""
    if not _powers or len(_powers[0]) < n:
        n = max(n, BLOCK)
        base = int(_ODD)
        _powers[:] = [_cumpow(base, n), _cumpow(pow(base, -1, 1 << 64), n)]
    return _powers[0], _powers[1]


def _cumpow(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def string_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and n + 1 offsets of a string column; nulls are empty."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), at


def word_hashes(column: pa.Array, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word, and n + 1 offsets of the rows into them. fold: A-Z count as a-z."""
    data, offsets = string_parts(column)
    begin, end = (int(offsets[0]), int(offsets[-1])) if len(offsets) else (0, 0)
    hashes, starts, at, size = [], [], begin, BLOCK
    values = _VALUES[fold]
    while at < end:
        stop = min(at + size, end)
        block = data[at:stop]
        here = _IS_WORD[block]
        inner = offsets[np.searchsorted(offsets, at, "right") : np.searchsorted(offsets, stop, "left")] - at
        before = np.empty_like(here)
        before[0], before[1:] = False, here[:-1]
        before[inner] = False
        start = np.flatnonzero(here & ~before)
        after = np.empty_like(here)
        after[-1], after[:-1] = False, here[1:]
        after[inner - 1] = False
        last = np.flatnonzero(here & ~after)
        if stop < end and len(start) and last[-1] == len(block) - 1:  # this word may go on
            if len(start) == 1 and start[0] == 0:
                size *= 2
                continue
            stop = at + int(start[-1])
            start, last, block = start[:-1], last[:-1], block[: start[-1]]
        if len(start):
            up, down = powers(len(block))
            sums = np.cumsum(values[block] * up[: len(block)])
            below = np.where(start > 0, sums[start - 1], np.uint64(0))
            hashes.append(mix((sums[last] - below) * down[start] + (last - start + 1).astype(np.uint64) * _ODD))
            starts.append(start + at)
        at, size = stop, BLOCK
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets).astype(np.int64)


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of n words; of fewer words, one for all of them together; of none, none."""
    if not len(words):
        return words
    n = min(n, len(words))
    out = np.full(len(words) - n + 1, np.uint64(n), dtype=np.uint64)
    for i in range(n):
        out = mix(out * _ODD + words[i : len(words) - n + 1 + i])
    return out
