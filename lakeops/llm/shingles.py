"""Sets of word shingles as sorted 64-bit hashes, computed for many texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Bytes of text that are hashed at once.
SEGMENT = 1 << 18
#: Longer words are hashed by themselves: a polynomial modulo a power of two has words that
#: anyone can write down with the same value, but only long ones.
LONG_WORD = 64

_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93 | 5  # odd, and not near 1 modulo a power of two
_rng = np.random.default_rng(20240229)
_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_VALUE[65:91] = _VALUE[97:123]  # A-Z count as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_powers: list[np.ndarray] = []


def _power_tables() -> list[np.ndarray]:
    if not _powers:
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(SEGMENT + 1, np.uint64(base))
            steps[0] = 1
            _powers.append(np.multiply.accumulate(steps))
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of all texts in order, and the first word of each text (and the end).

    Words are runs without ASCII white space; A-Z are lower-cased. A word's hash is a
    polynomial of its bytes, from sums over the whole buffer; above LONG_WORD bytes it is xxh3.
    """
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = offsets[1:-1]
    cuts = cuts[cuts < len(data)]
    first[cuts] = inside[cuts]  # a text begins a new word
    starts = np.nonzero(first)[0]
    last = np.zeros(len(data) + 1, bool)
    last[1:] = inside
    last[1:-1] &= ~inside[1:] | first[1:]
    ends = np.nonzero(last)[0]
    hashes = np.empty(len(starts), np.uint64)
    up, down = _power_tables()
    w = 0
    while w < len(starts):
        lo = starts[w]
        e = max(int(np.searchsorted(ends, lo + SEGMENT, "right")), w + 1)
        if ends[w] - lo <= SEGMENT:
            part = data[lo : ends[e - 1]]
            total = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_VALUE[part] * up[: len(part)], out=total[1:])
            s, t = starts[w:e] - lo, ends[w:e] - lo
            hashes[w:e] = (total[t] - total[s]) * down[s] + (t - s).astype(np.uint64) * _ODD
        w = e
    for w in np.flatnonzero(ends - starts > LONG_WORD):
        hashes[w] = xxhash.xxh3_64_intdigest(data[starts[w] : ends[w]].tobytes().translate(_LOWER))
    return mix(hashes), np.searchsorted(starts, offsets)


def shingle_sets(column: pa.Array, words: int, each=None) -> list:
    """Sorted distinct shingle hashes of each text.

    Texts with fewer than ``words`` words have their whole sequence as one shingle; texts
    without words have none. ``each`` is called with the hashes of all words in order; if it
    returns a whole number for each word, a text's result is (hashes, sums of a shingle's
    numbers).
    """
    hashes, bounds = word_hashes(column)
    numbers = each(hashes) if each else None
    total = None if numbers is None else np.r_[0, np.cumsum(numbers)]

    def joined(parts: list[np.ndarray]) -> np.ndarray:
        out = mix(parts[0] + np.uint64(len(parts)))
        for p in parts[1:]:
            out = mix(out * _ODD + p)
        return out

    n = len(hashes) - words + 1
    grams = joined([hashes[i : n + i] for i in range(words)]) if n > 0 else hashes[:0]
    out = []
    for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if e - s >= words:
            own, size = grams[s : e - words + 1], words
        elif e > s:
            own, size = joined([hashes[i : i + 1] for i in range(s, e)]), e - s
        else:
            own, size = hashes[:0], 0
        if total is None:
            own = np.sort(own)
            out.append(own[_fresh(own)])
        else:
            order = np.argsort(own, kind="stable")
            own = own[order]
            first = _fresh(own)
            at = s + order[first]
            out.append((own[first], total[at + size] - total[at]))
    return out


def _fresh(ordered: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before."""
    first = np.ones(len(ordered), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    return first


def set_id(own: np.ndarray) -> int:
    """A hash of the whole set, as a signed long."""
    return xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63)
