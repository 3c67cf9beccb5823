"""Words and runs of words as 64-bit hashes, over whole Arrow buffers at a time.

Words are ``[^\\x20\\x09-\\x0D]+``.  Polynomial hashes come from running sums, so a batch costs a few passes over its
bytes and no Python object a word.
"""

from __future__ import annotations

import numpy as np

from .common import worker_cache

PIECE = 1 << 18  # bytes or words hashed at a time; a worker keeps as many powers
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64 bits."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= _MIX[0]
    x ^= x >> np.uint64(27)
    x *= _MIX[1]
    x ^= x >> np.uint64(31)
    return x


class Powers:
    """Powers of an odd number and of its inverse, modulo 2**64, as far as they were needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(1 << 16, n + n // 8)
            self.up, self.down = (
                np.multiply.accumulate(np.r_[np.uint64(1), np.full(size - 1, b, np.uint64)], dtype=np.uint64)
                for b in (self.base, self.inverse)
            )
        return self.up[:n], self.down[:n]


def _tables():
    rng = np.random.default_rng(20240601)
    separator = np.zeros(256, bool)
    separator[[9, 10, 11, 12, 13, 32]] = True
    values = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    other = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    powers = Powers(0x9E3779B97F4A7C15 | 3), Powers(0xC2B2AE3D27D4EB4F)
    return separator, (values, other), lower, powers, {}


def tables():
    return worker_cache("word_tables", _tables)


def _hash_piece(data: np.ndarray, cuts: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, hashes) of the words of some bytes; a word also ends where a row begins (``cuts``)."""
    separator, values, _, powers, _ = tables()
    values, powers = values[salt], powers[salt]
    space = separator[data]
    begins = np.zeros(len(data), bool)
    begins[cuts[cuts < len(data)]] = True
    begins[0] = True
    inside = ~space
    start = inside.copy()
    start[1:] &= space[:-1] | begins[1:]
    end = inside.copy()
    end[:-1] &= space[1:] | begins[1:]
    first, last = np.flatnonzero(start), np.flatnonzero(end)
    up, down = powers.upto(len(data) + 1)
    sums = np.cumsum(values[data] * up[: len(data)], dtype=np.uint64)
    total = sums[last] - np.where(first > 0, sums[np.maximum(first, 1) - 1], np.uint64(0))
    length = (last - first + 1).astype(np.uint64)
    return first, mix(total * down[first] ^ (length << np.uint64(40)))


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, lower: bool = False, salt: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, number of words of every row) of an Arrow text buffer, in pieces of about ``PIECE``
    bytes that end at a separator or a row's end.  ``salt`` is 0 or 1, for two hashes that know nothing of each other."""
    separator, _, small, _, _ = tables()
    hashes, counts = [], np.zeros(len(offsets) - 1, np.int64)
    at, total = 0, int(offsets[-1]) if len(offsets) else 0
    while at < total:
        stop = min(total, at + PIECE)
        if stop < total:
            k = int(np.searchsorted(offsets, stop, "right")) - 1
            if offsets[k] > at:
                stop = int(offsets[k])
            else:  # a long row: cut before its next separator
                rest = int(offsets[k + 1])
                while stop < rest and not separator[data[stop]]:
                    stop += 1
        part = data[at:stop]
        if lower:
            part = small[part]
        row_at = np.searchsorted(offsets, [at, stop])
        first, h = _hash_piece(part, offsets[row_at[0] : row_at[1]] - at, salt)
        hashes.append(h)
        rows = np.searchsorted(offsets, first + at, "right") - 1
        counts += np.bincount(rows, minlength=len(counts))
        at = stop
    return np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), counts


def run_hashes(words: np.ndarray, counts: np.ndarray, n: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every run of ``n`` words inside a row, place of its first word)."""
    if len(words) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    powers = tables()[4].setdefault(salt, Powers((0xD1342543DE82EF95 + 8 * salt) | 3))
    step = PIECE
    rows = np.repeat(np.arange(len(counts), dtype=np.int64), counts)
    valid = rows[: len(words) - n + 1] == rows[n - 1 :]
    out = np.empty(len(words) - n + 1, np.uint64)
    for at in range(0, len(out), step):
        part = words[at : at + step + n - 1]
        scrambled = mix(part + np.uint64(salt)) if salt else part
        up, down = powers.upto(len(part) + 1)
        sums = np.cumsum(scrambled * up[: len(part)], dtype=np.uint64)
        before = np.concatenate([np.zeros(1, np.uint64), sums[: len(part) - n]])
        out[at : at + len(part) - n + 1] = (sums[n - 1 :] - before) * down[: len(part) - n + 1]
    places = np.flatnonzero(valid)
    return mix(out[places]), places
