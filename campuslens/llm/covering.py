"""Covering codes over blocks of a 64-bit fingerprint.

The 64 positions are cut into 23 + 23 + 15 + 3 bits. The first two blocks use the perfect binary
Golay code (length 23, covering radius 3), the third the Hamming code of length 15 (radius 1); the
last 3 bits take no part. An anchor is one codeword per block, 35 information bits in all. Every
fingerprint lies within the covering radius of exactly one anchor, its home. If two fingerprints
differ in e1, e2, e3 bits of the blocks, the second one lies within radius + e of the first one's
home in each block, so replicating to all anchors with e1 + e2 + e3 <= threshold finds every pair."""

from __future__ import annotations

from functools import cache
from itertools import combinations, product

import numpy as np

#: Generator polynomials of the two perfect codes: length, polynomial, covering radius.
GOLAY = (23, 0b101011100011, 3)
HAMMING = (15, 0b10011, 1)
BLOCKS = (GOLAY, GOLAY, HAMMING)
#: Blocks of a 46-bit fingerprint.
SHORT_BLOCKS = (GOLAY, GOLAY)


class PerfectCode:
    """Cyclic code with the error patterns of each syndrome, sorted by weight."""

    def __init__(self, length: int, polynomial: int, radius: int, reach: int):
        self.length, self.radius = length, radius
        self.check = polynomial.bit_length() - 1
        remainders = np.zeros(length, np.int64)
        value = 1
        for i in range(length):
            remainders[i] = value
            value <<= 1
            if value >> self.check & 1:
                value ^= polynomial
        self.remainders = remainders
        patterns, syndromes, weights = [], [], []
        for weight in range(radius + reach + 1):
            for places in combinations(range(length), weight):
                patterns.append(sum(1 << p for p in places))
                syndromes.append(int(np.bitwise_xor.reduce(remainders[list(places)]))
                                 if places else 0)
                weights.append(weight)
        order = np.lexsort((weights, syndromes))
        self.patterns = np.array(patterns, np.int64)[order]
        self.weights = np.array(weights, np.int64)[order]
        sorted_syndromes = np.array(syndromes, np.int64)[order]
        self.bounds = np.searchsorted(sorted_syndromes, np.arange((1 << self.check) + 1))

    def syndromes(self, words: np.ndarray) -> np.ndarray:
        out = np.zeros(len(words), np.int64)
        for i in range(self.length):
            out ^= np.where(words >> i & 1, self.remainders[i], 0)
        return out

    def near(self, words: np.ndarray, extra: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, codeword) of all codewords within radius + extra whose distance is above
        radius + extra - 1 (for extra 0: the one within the radius)."""
        s = self.syndromes(words)
        first, count = self.bounds[s], self.bounds[s + 1] - self.bounds[s]
        rows = np.repeat(np.arange(len(words)), count)
        within = np.arange(len(rows)) - np.repeat(np.cumsum(count) - count, count)
        at = np.repeat(first, count) + within
        weight = self.weights[at]
        low = -1 if extra == 0 else self.radius + extra - 1
        keep = (weight > low) & (weight <= self.radius + extra)
        rows, at = rows[keep], at[keep]
        # cyclic code in systematic form: the bits above the check part name the codeword
        return rows, (words[rows] ^ self.patterns[at]) >> self.check


@cache
def codes(threshold: int, blocks: tuple = BLOCKS) -> tuple[PerfectCode, ...]:
    made = {spec: PerfectCode(*spec, threshold) for spec in set(blocks)}
    return tuple(made[spec] for spec in blocks)


def _split(fingerprints: np.ndarray, blocks: tuple) -> list[np.ndarray]:
    words, shift = [], 0
    for length, _, _ in blocks:
        words.append((fingerprints >> np.uint64(shift)).astype(np.int64) & ((1 << length) - 1))
        shift += length
    return words


def _join(names: list[np.ndarray], made: tuple[PerfectCode, ...]) -> np.ndarray:
    anchor = np.zeros(len(names[0]), np.int64)
    for name, code in zip(names, made, strict=True):
        anchor = anchor << (code.length - code.check) | name
    return anchor


def homes(fingerprints: np.ndarray, threshold: int, blocks: tuple = BLOCKS) -> np.ndarray:
    made = codes(threshold, blocks)
    return _join([code.near(words, 0)[1]
                  for code, words in zip(made, _split(fingerprints, blocks), strict=True)], made)


def replicas(fingerprints: np.ndarray, threshold: int, blocks: tuple = BLOCKS
             ) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) of every anchor that a fingerprint within ``threshold`` bits may call home."""
    made = codes(threshold, blocks)
    words = _split(fingerprints, blocks)
    shells = [[code.near(w, extra) for extra in range(threshold + 1)]
              for code, w in zip(made, words, strict=True)]
    n = len(fingerprints)
    out_rows, out_anchors = [], []
    for extras in product(range(threshold + 1), repeat=len(made)):
        if sum(extras) > threshold:
            continue
        rows, names = np.arange(n), []
        for block, extra in enumerate(extras):
            shell_rows, shell_names = shells[block][extra]
            count = np.bincount(shell_rows, minlength=n)
            first = np.cumsum(count) - count
            times = count[rows]
            at = np.repeat(first[rows], times) + (
                np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times))
            names = [np.repeat(name, times) for name in names] + [shell_names[at]]
            rows = np.repeat(rows, times)
        out_rows.append(rows)
        out_anchors.append(_join(names, made))
    return np.concatenate(out_rows), np.concatenate(out_anchors)
