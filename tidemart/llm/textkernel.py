"""Word and shingle hashes of whole texts, in numpy over Arrow buffers.

Words are runs of bytes other than space and 0x09-0x0D; A-Z hash like a-z if
``fold`` is set.  A word's 64-bit hash mixes two independent sums over its
bytes, so unequal words collide with a chance of about 2**-64.
"""

from __future__ import annotations

import numpy as np

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: All bytes but ASCII letters and those of other scripts: separates runs of letters.
NO_LETTER = np.ones(256, bool)
NO_LETTER[65:91] = NO_LETTER[97:123] = NO_LETTER[128:] = False
_U = np.uint64
# Odd 64-bit multipliers (fixed values): golden ratio and two of its mixes.
_ODD = [_U(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
_BASES = (_U(0xD6E8FEB86659FD93), _U(0xA0761D6478BD642F))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> _U(30))
    x *= _ODD[1]
    x ^= x >> _U(27)
    x *= _ODD[2]
    return x ^ (x >> _U(31))


def _byte_table(seed: int, fold: bool) -> np.ndarray:
    table = mix(np.arange(1, 257, dtype=_U) * _ODD[0] + _U(seed))
    if fold:
        table[65:91] = table[97:123]
    return table


_TABLES = {fold: (_byte_table(11, fold), _byte_table(77, fold)) for fold in (False, True)}


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, _U)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_bounds(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the index of each row's first word (one
    more entry than rows).  No word spans two rows."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~space[data]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    full = offsets[1:] > offsets[:-1]
    first, last = offsets[:-1][full], offsets[1:][full] - 1
    start[first], end[last] = inside[first], inside[last]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True,
                limit: int = 1 << 21, space: np.ndarray = SPACE) -> np.ndarray:
    """One 64-bit hash a word; a few million bytes are worked on at a time."""
    out, lengths = np.empty(len(starts), _U), ends - starts
    i, tables = 0, _TABLES[fold]
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + limit, "right")))
        block = data[starts[i] : ends[j - 1]]
        block, size = block[~space[block]], lengths[i:j]
        at = np.cumsum(size) - size
        place = np.arange(len(block)) - np.repeat(at, size)
        longest = int(size.max())
        sums = [np.add.reduceat(t[block] * powers(b, longest)[place], at) for t, b in zip(tables, _BASES)]
        out[i:j] = mix(sums[0] + mix(sums[1]) + size.astype(_U))
        i = j
    return out


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words (rows are cut out by the caller)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, _U)
    factors = mix(np.arange(k, dtype=_U) * _ODD[0] + _U(k)) | _U(1)
    total = np.zeros(n, _U)
    for j in range(k):
        total += words[j : j + n] * factors[j]
    return mix(total)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """Of each row the sorted distinct hashes of its ``k``-word shingles; fewer
    words count as one shingle, no words give an empty set."""
    starts, ends, first = word_bounds(data, offsets)
    words = word_hashes(data, starts, ends)
    whole = window_hashes(words, k)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(whole[a : b - k + 1]))
        else:
            out.append(window_hashes(words[a:b], b - a) if b > a else whole[:0])
    return out


def word_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Exact numbers of the words (equal if and only if their bytes are) and the distinct words, as Arrow binary."""
    import pyarrow as pa

    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[~SPACE[data]].copy())])
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
