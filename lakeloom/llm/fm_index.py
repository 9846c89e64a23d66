"""A compressed full-text index of word sequences.

The Burrows-Wheeler transform of a shard is kept as a wavelet matrix: one
packed bit vector per bit of the alphabet, with a rank count per 64 bits.
Backward search narrows an interval of the sorted suffixes word by word, for
many patterns at once. Suffixes are sorted by their first ``depth`` words,
which is enough for patterns up to that length.
"""

from __future__ import annotations

import numpy as np


class BitVector:
    """Packed bits with ranks of ones."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros(-(-(n + 1) // 64) * 64, dtype=np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(counts)])[:-1]
        self.ones = int(counts.sum())

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones among the first ``at`` bits."""
        block = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[block] + np.bitwise_count(self.words[block] & mask)


class WaveletMatrix:
    """Rank of any symbol in any prefix of a sequence of small integers."""

    def __init__(self, seq: np.ndarray, sigma: int):
        self.bits = max(1, int(sigma - 1).bit_length())
        self.levels: list[tuple[BitVector, int]] = []
        cur = seq
        for shift in range(self.bits - 1, -1, -1):
            bit = ((cur >> shift) & 1).astype(np.uint8)
            vec = BitVector(bit)
            self.levels.append((vec, len(cur) - vec.ones))
            cur = np.concatenate([cur[bit == 0], cur[bit == 1]])

    def ranks(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of each symbol before ``lo`` and before ``hi``."""
        first = np.zeros(len(symbol), dtype=np.int64)
        for level, (vec, zeros) in enumerate(self.levels):
            one = ((symbol >> (self.bits - 1 - level)) & 1).astype(bool)
            ranked = vec.rank(np.concatenate([first, lo, hi])).reshape(3, -1)
            first = np.where(one, zeros + ranked[0], first - ranked[0])
            lo = np.where(one, zeros + ranked[1], lo - ranked[1])
            hi = np.where(one, zeros + ranked[2], hi - ranked[2])
        return lo - first, hi - first


def sorted_suffixes(seq: np.ndarray, depth: int) -> np.ndarray:
    """Start positions in the order of their first ``depth`` symbols (a power
    of two; prefix doubling), ties by position."""
    n = len(seq)
    rank = np.unique(seq, return_inverse=True)[1].astype(np.int64) + 1
    done = 1
    while True:
        key = rank * (n + 2)
        key[:n - done] += rank[done:]
        order = np.argsort(key, kind="stable")
        done *= 2
        if done >= depth:
            return order
        new = np.empty(n, dtype=np.int64)
        ordered = key[order]
        new[order] = np.cumsum(np.concatenate([[1], (ordered[1:] != ordered[:-1]).astype(np.int64)]))
        rank = new
        if rank[order[-1]] == n:
            return order


class FmIndex:
    """Index of several word sequences.

    ``pieces``: integer words; ``order``: a number for each word that says
    which of two places is the earlier one.
    """

    def __init__(self, pieces: list[np.ndarray], order: list[np.ndarray], depth: int = 32):
        self.depth = 1 << max(0, depth - 1).bit_length()
        flat = np.concatenate(pieces)
        self.alphabet = np.unique(flat)
        size = np.array([len(p) for p in pieces], dtype=np.int64)
        self.start = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
        n = int(size.sum()) + len(pieces)
        at = np.arange(len(flat)) + np.repeat(np.arange(len(pieces)), size)
        self.text = np.zeros(n, dtype=np.int64)          # 0 closes every piece
        self.text[at] = np.searchsorted(self.alphabet, flat) + 1
        place = np.full(n, np.iinfo(np.int64).max)
        place[at] = np.concatenate(order)
        suffix = sorted_suffixes(self.text, self.depth)
        sigma = len(self.alphabet) + 1
        self.tree = WaveletMatrix(self.text[suffix - 1], sigma)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(self.text, minlength=sigma))])
        # smallest place of any interval: sparse table over the suffix order
        self.place = place
        self.least = [place[suffix]]
        step = 1
        while 2 * step <= n:
            prev = self.least[-1]
            self.least.append(np.minimum(prev[:-step], prev[step:]))
            step *= 2

    def symbols(self, words: np.ndarray) -> np.ndarray:
        """Symbols of words, 0 for words that are not in the index."""
        at = np.minimum(np.searchsorted(self.alphabet, words), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == words, at + 1, 0)

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: the intervals of ``symbol + pattern``."""
        a, b = self.tree.ranks(symbol, lo, hi)
        return self.first[symbol] + a, self.first[symbol] + b

    def earliest(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Smallest place in each non-empty interval."""
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        out = np.empty(len(lo), dtype=np.int64)
        for k in np.unique(level):
            mine = level == k
            row = self.least[k]
            out[mine] = np.minimum(row[lo[mine]], row[hi[mine] - (1 << int(k))])
        return out

    def matching_statistics(self, words: np.ndarray, ends: np.ndarray, limit: int,
                            own: np.ndarray | None = None, room: np.ndarray | None = None) -> np.ndarray:
        """For each ``end``: length, up to ``limit``, of the longest run of
        ``words`` that ends there (inclusive), reaches back at most ``room``
        words, and occurs in the index; with ``own`` (the place of every
        streamed word) it must occur at an earlier place than itself."""
        if limit > self.depth:
            raise ValueError("limit is beyond the depth of the index")
        sym = self.symbols(words)
        room = ends + 1 if room is None else room
        out = np.zeros(len(ends), dtype=np.int64)
        live = np.arange(len(ends))
        lo = np.zeros(len(ends), dtype=np.int64)
        hi = np.full(len(ends), len(self.text), dtype=np.int64)
        for step in range(limit):
            live_ok = room[live] > step
            live, lo, hi = live[live_ok], lo[live_ok], hi[live_ok]
            s = sym[ends[live] - step]
            lo, hi = self.extend(s, lo, hi)
            ok = (hi > lo) & (s > 0)
            if own is not None:
                at = np.flatnonzero(ok)
                ok[at] = self.earliest(lo[at], hi[at]) < own[ends[live[at]] - step]
            live, lo, hi = live[ok], lo[ok], hi[ok]
            if not len(live):
                break
            out[live] = step + 1
        return out
