"""Words of many texts at once in numpy: where they are, a 64-bit hash of each, hashes of word ranges.

Hashes are polynomials modulo 2**64 over mixed values, taken from prefix sums, so that a range of any length costs
two look-ups. They are the same in every process. Operators that must be exact compare the words behind equal hashes.
"""

from __future__ import annotations

from functools import cache

import numpy as np

BLOCK = 1 << 20
_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD6E8FEB86659FD93


def word_table(separators: bytes, lower: bool) -> tuple[np.ndarray, bytes]:
    """A mask of the bytes that belong to words, and a translation that lower-cases A-Z if asked for.

    All separators are ASCII, so bytes of longer UTF-8 sequences are never split.
    """
    mask = np.ones(256, dtype=bool)
    mask[list(separators)] = False
    return mask, bytes(b + 32 if lower and 65 <= b <= 90 else b for b in range(256))


SPACES = bytes([*range(9, 14), 32])
SPACED, KEEP_CASE = word_table(SPACES, lower=False)
_, LOWER = word_table(SPACES, lower=True)
ALNUM, _ = word_table(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]), lower=True)


@cache
def _byte_values() -> np.ndarray:
    return np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and ``base**-i`` modulo 2**64 for i below n."""
    have = _tables.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, BLOCK // 4)
        made = []
        for b in (base, pow(base, -1, 2**64)):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        have = made[0], made[1]
        if size <= 8 * BLOCK:
            _tables[base] = have
    return have[0][:n], have[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit over all others."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """Words of a list of texts. ``start`` and ``end`` are byte positions in ``data``; the words of text k
    are those from ``first[k]`` up to ``first[k + 1]``; ``doc`` is the text of each word."""

    def __init__(self, texts: list[bytes], mask: np.ndarray = SPACED, translate: bytes = KEEP_CASE, hashes: bool = True):
        self.data = b"\n".join(texts)
        if translate is not KEEP_CASE:
            self.data = self.data.translate(translate)
        buf = np.frombuffer(self.data, dtype=np.uint8)
        starts, ends, values, at = [], [], [], 0
        while at < len(buf):
            stop = min(len(buf), at + BLOCK)
            while stop < len(buf) and mask[buf[stop]]:  # a block ends at a separator
                gap = np.flatnonzero(~mask[buf[stop : stop + BLOCK]])
                stop = stop + int(gap[0]) if len(gap) else min(len(buf), stop + BLOCK)
            s, e, h = self._block(buf[at:stop], mask, hashes)
            starts.append(s + at)
            ends.append(e + at)
            values.append(h)
            at = stop
        none = np.zeros(0, dtype=np.int64)
        self.start = np.concatenate(starts) if starts else none
        self.end = np.concatenate(ends) if ends else none
        self.hash = np.concatenate(values) if values else none.astype(np.uint64)
        begin = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.first = np.searchsorted(self.start, begin)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))
        self._sums: np.ndarray | None = None

    @staticmethod
    def _block(buf, mask, hashes):
        inside = np.zeros(len(buf) + 2, dtype=np.int8)
        inside[1:-1] = mask[buf]
        edges = np.flatnonzero(np.diff(inside))
        s, e = edges[::2], edges[1::2]
        if not hashes:
            return s, e, np.zeros(0, dtype=np.uint64)
        p, q = powers(_BYTE_BASE, len(buf) + 1)
        sums = np.zeros(len(buf) + 1, dtype=np.uint64)
        np.cumsum(_byte_values()[buf] * p[:-1], out=sums[1:])
        return s, e, mix((sums[e] - sums[s]) * q[s] + (e - s).astype(np.uint64))

    def __len__(self) -> int:
        return len(self.start)

    def ranges(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """A hash of the words of each range [start, stop)."""
        if self._sums is None:
            p, _ = powers(_WORD_BASE, len(self) + 1)
            self._sums = np.zeros(len(self) + 1, dtype=np.uint64)
            np.cumsum(self.hash * p[:-1], out=self._sums[1:])
        _, q = powers(_WORD_BASE, len(self) + 1)
        return mix((self._sums[stop] - self._sums[start]) * q[start] + (stop - start).astype(np.uint64))

    def runs_of(self, k: int) -> np.ndarray:
        """Positions at which k words of one text start."""
        if len(self) < k or k < 1:
            return np.zeros(0, dtype=np.int64)
        return np.flatnonzero(self.doc[: len(self) - k + 1] == self.doc[k - 1 :])

    def bytes_of(self, i: int, j: int) -> bytes:
        """Words i to j - 1, joined by one space."""
        return b" ".join(
            self.data[a:b] for a, b in zip(self.start[i:j].tolist(), self.end[i:j].tolist(), strict=True)
        )


def covered(n: int, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A mask of the n positions that some range [start, stop) holds."""
    steps = np.zeros(n + 1, dtype=np.int64)
    np.add.at(steps, start, 1)
    np.add.at(steps, stop, -1)
    return np.cumsum(steps[:-1]) > 0
