"""FM-index over a locally consistent parse of text, in numpy.

A text (code points) is cut into phrases where the hash of two neighbouring characters is a local minimum; a cut
depends only on REACH characters around it, so a run shared by two texts is cut alike in both, but for its edges. The
sequence of phrases is the text of the index: suffix array by prefix doubling, its last column in a wavelet matrix,
every SAMPLE-th suffix position kept. Patterns are searched backward, all at once; a row is located by stepping back
to a sampled one. Indexing phrases instead of characters makes the index about a fifth as large.
"""

from __future__ import annotations

import numpy as np

WINDOW = 2
#: A cut at i depends on the characters i - WINDOW .. i + WINDOW + 1.
BEFORE, AFTER = WINDOW, WINDOW + 1
SAMPLE = 8
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64, at least n of them."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(12, n - 1).bit_length() if n < 1 << 12 else 1 << (n - 1).bit_length()
        factors = np.full(size, base, dtype=np.uint64)
        factors[0] = 1
        have = _powers[base] = np.cumprod(factors)
    return have[:n]


def cuts(codes: np.ndarray) -> np.ndarray:
    """Positions where a phrase begins, but for the first."""
    n = len(codes)
    if n < 2:
        return np.zeros(0, dtype=np.int64)
    h = codes[:-1] * np.uint32(0x9E3779B1) + codes[1:] * np.uint32(0x85EBCA77)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0xC2B2AE3D)
    h ^= h >> np.uint32(13)
    low = np.ones(n - 1, dtype=bool)
    for d in range(1, WINDOW + 1):
        low[d:] &= h[d:] < h[:-d]
        low[:-d] &= h[:-d] <= h[d:]
    low[0] = False
    return np.flatnonzero(low)


def phrase_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of codes[start:end] for each phrase; equal phrases have equal hashes."""
    sums = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(codes)), out=sums[1:])
    mixed = (sums[ends] - sums[starts]) * _power(_INVERSE, len(codes) + 1)[starts]
    return mixed ^ ((ends - starts).astype(np.uint64) << np.uint64(1))


def _short(hashes: np.ndarray) -> np.ndarray:
    return ((hashes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; each round sorts only the suffixes that still tie."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    first = np.concatenate(([True], np.diff(symbols[order]) != 0))
    slots = np.arange(n)
    rank = np.empty(n, dtype=np.int64)
    starts = np.maximum.accumulate(np.where(first, slots, 0))
    rank[order] = starts
    tied = ~(first & np.concatenate((first[1:], [True])))
    todo, step = slots[tied], 1
    while len(todo):
        own = order[todo]
        ahead = own + step
        key = rank[own] * (n + 1)
        inside = ahead < n
        key[inside] += rank[ahead[inside]] + 1
        by = np.argsort(key, kind="stable")
        key, own = key[by], own[by]
        order[todo] = own
        first = np.concatenate(([True], np.diff(key) != 0))
        rank[own] = todo[np.maximum.accumulate(np.where(first, np.arange(len(todo)), 0))]
        todo = todo[~(first & np.concatenate((first[1:], [True])))]
        step *= 2
    return order


class Bits:
    """A bit vector with rank in constant time."""

    def __init__(self, bits: np.ndarray | None, words: np.ndarray | None = None):
        if words is None:
            packed = np.zeros((len(bits) // 64 + 1) * 8, dtype=np.uint8)
            bytes_ = np.packbits(bits, bitorder="little")
            packed[: len(bytes_)] = bytes_
            words = packed.view(np.uint64)
        self.words = words
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))[:-1]

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before i."""
        word, bit = i >> 6, (i & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)

    def at(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)


class WaveletMatrix:
    """Ranks of symbols of a large alphabet: one bit vector for each bit of a symbol."""

    def __init__(self, values: np.ndarray, n_symbols: int, levels: list[tuple[Bits, int]] | None = None):
        self.depth = max(1, int(n_symbols - 1).bit_length())
        self.levels: list[tuple[Bits, int]] = levels or []
        if levels:
            return
        for level in range(self.depth - 1, -1, -1):
            ones = (values >> level) & 1 == 1
            self.levels.append((Bits(ones), int(len(values) - ones.sum())))
            values = np.concatenate((values[~ones], values[ones]))

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each i."""
        start = np.zeros(len(i), dtype=np.int64)
        for k, (bits, zeros) in enumerate(self.levels):
            one = (symbol >> (self.depth - 1 - k)) & 1 == 1
            a, b = bits.rank(start), bits.rank(i)
            start = np.where(one, zeros + a, start - a)
            i = np.where(one, zeros + b, i - b)
        return i - start

    def access(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbol at i, its rank before i)."""
        start, symbol = np.zeros(len(i), dtype=np.int64), np.zeros(len(i), dtype=np.int64)
        for bits, zeros in self.levels:
            one = bits.at(i) == 1
            a, b = bits.rank(start), bits.rank(i)
            start = np.where(one, zeros + a, start - a)
            i = np.where(one, zeros + b, i - b)
            symbol = symbol << 1 | one
        return symbol, i - start


class FMIndex:
    """Index of one shard of text, given as code points in which 0 parts the documents.

    Symbols are told apart by 32 bits of the phrase hash: phrases that share them count as one, which makes candidates, not
    results, as places are compared with the text. ``stored`` is what ``dump`` gave for the same text.
    """

    def __init__(self, codes: np.ndarray, stored: bytes | None = None):
        self.codes = codes
        n = len(codes)
        self.cuts = cuts(codes)
        gaps = np.flatnonzero(codes == 0)
        mark = np.zeros(n + 1, dtype=bool)
        mark[self.cuts] = True
        mark[gaps] = mark[gaps + 1] = mark[0] = True
        mark[n] = False
        self.starts = np.flatnonzero(mark)
        self.size = len(self.starts) + 1
        if stored is not None:
            self._load(stored)
            return
        hashes = _short(phrase_hashes(codes, self.starts, np.concatenate((self.starts[1:], [n]))))
        self.alphabet, symbols = np.unique(hashes, return_inverse=True)
        symbols = np.concatenate((symbols.astype(np.int64) + 1, [0]))  # 0 ends the text
        order = suffix_array(symbols)
        n_symbols = len(self.alphabet) + 1
        self.first = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=n_symbols))))
        self.last = WaveletMatrix(symbols[order - 1], n_symbols)
        kept = order % SAMPLE == 0
        self.sampled, self.samples = Bits(kept), order[kept]

    def dump(self) -> bytes:
        """The index without the text and what follows from it at once."""
        steps = np.diff(self.alphabet.astype(np.int64), prepend=0).astype(np.uint32)
        counts = np.diff(self.first).astype(np.uint32)
        parts = [steps, counts, self.samples.astype(np.uint32), self.sampled.words, *(b.words for b, _ in self.last.levels)]
        sizes = np.array([len(self.last.levels), *(z for _, z in self.last.levels), *(x.nbytes for x in parts)], dtype=np.int64)
        return len(sizes).to_bytes(4, "little") + sizes.tobytes() + b"".join(x.tobytes() for x in parts)

    def _load(self, stored: bytes) -> None:
        n = int.from_bytes(stored[:4], "little")
        sizes = np.frombuffer(stored, dtype=np.int64, count=n, offset=4).tolist()
        zeros, at, parts = sizes[1 : 1 + sizes[0]], 4 + 8 * n, []
        for size in sizes[1 + sizes[0] :]:
            parts.append(stored[at : at + size])
            at += size
        steps, counts, samples = (np.frombuffer(x, dtype=np.uint32) for x in parts[:3])
        words = [np.frombuffer(x, dtype=np.uint64) for x in parts[3:]]
        self.alphabet = np.cumsum(steps, dtype=np.int64).astype(np.uint32)
        self.first = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
        self.sampled, self.samples = Bits(None, words[0]), samples.astype(np.int64)
        self.last = WaveletMatrix(np.zeros(0), len(self.alphabet) + 1, [(Bits(None, w), z) for w, z in zip(words[1:], zeros)])

    def symbols_of(self, hashes: np.ndarray) -> np.ndarray:
        """Symbol of each phrase hash, 0 where the text has no such phrase."""
        short = _short(hashes)
        at = np.minimum(np.searchsorted(self.alphabet, short), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == short, at + 1, 0)

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of each pattern; patterns is a matrix of symbols, filled from the left."""
        low, high = np.zeros(len(patterns), dtype=np.int64), np.full(len(patterns), self.size)
        for back in range(1, patterns.shape[1] + 1):
            live = np.flatnonzero((lengths >= back) & (low < high))
            if not len(live):
                break
            symbol = patterns[live, lengths[live] - back]
            low[live] = np.where(symbol > 0, self.first[symbol] + self.last.rank(symbol, low[live]), 0)
            high[live] = np.where(symbol > 0, self.first[symbol] + self.last.rank(symbol, high[live]), 0)
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Position in the text (of characters) at which the suffix of each row begins."""
        found, steps, open_ = np.zeros(len(rows), dtype=np.int64), 0, np.arange(len(rows))
        rows = rows.copy()
        while len(open_):
            hit = self.sampled.at(rows[open_]) == 1
            done = open_[hit]
            found[done] = self.samples[self.sampled.rank(rows[done])] + steps
            open_ = open_[~hit]
            if len(open_):
                symbol, rank = self.last.access(rows[open_])
                rows[open_] = self.first[symbol] + rank
            steps += 1
        return self.starts[np.minimum(found, len(self.starts) - 1)]
