"""Word shingles, one-permutation hashing and its optimal densification, in numpy."""

from __future__ import annotations

import math

import numpy as np
import xxhash

from shelfcast.llm.parsing import MAX64, mix

ROWS = 5
# A pair right at the threshold is overlooked at most this often.
MISS = 1e-6
_STEP = np.uint64(0x9E3779B97F4A7C15)


def bands_for(similarity: float, rows: int = ROWS, miss: float = MISS) -> int:
    """Bands of ``rows`` values that bring a pair at the threshold together."""
    return math.ceil(math.log(miss) / math.log(1 - similarity**rows))


def _multipliers(count: int) -> np.ndarray:
    return mix(np.arange(1, count + 1, dtype=np.uint64) * _STEP) | np.uint64(1)


def shingle_set(text: str, size: int) -> np.ndarray:
    """Sorted names (64-bit hashes) of the distinct word shingles of a text.

    A-Z count as lower case. Words are runs of anything but ASCII white space. A text with
    fewer words than a shingle has its whole sequence as one; without words the set is empty.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    size = min(size, len(words))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    weights = _multipliers(size)
    count = len(words) - size + 1
    sums = np.full(count, np.uint64(size))
    for place in range(size):
        sums += mix(hashes[place : place + count]) * weights[place]
    return np.unique(mix(sums))


def set_name(names: np.ndarray) -> bytes:
    """128-bit name of a set; equal sets have equal names."""
    return xxhash.xxh3_128_digest(names.tobytes())


def signatures(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """One-permutation MinHash: the smallest name in each bin, for non-empty sets.

    An empty bin borrows from the bin that a random probe sequence of its own, the same
    for all sets, finds first. So two sets agree in a bin as often as they are similar.
    """
    lengths = np.array([len(names) for names in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), lengths)
    place = ((flat >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    smallest = np.full(len(sets) * bins, MAX64)
    np.minimum.at(smallest, owner * bins + place, mix(flat))
    smallest = smallest.reshape(len(sets), bins)
    filled = smallest != MAX64
    row, column = np.nonzero(~filled)
    attempt = 0
    while row.size:
        attempt += 1
        seeds = column.astype(np.uint64) * _STEP + np.uint64(attempt)
        probe = (mix(mix(seeds)) % np.uint64(bins)).astype(np.int64)
        hit = filled[row, probe]
        smallest[row[hit], column[hit]] = smallest[row[hit], probe[hit]]
        row, column = row[~hit], column[~hit]
    return smallest


def band_keys(signature: np.ndarray, bands: int, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key for each band of each signature; keys of different bands differ."""
    weights = _multipliers(rows)
    parts = signature.reshape(len(signature), bands, rows)
    sums = np.zeros(parts.shape[:2], np.uint64)
    for place in range(rows):
        sums += mix(parts[:, :, place]) * weights[place]
    return mix(sums + np.arange(1, bands + 1, dtype=np.uint64) * _STEP).view(np.int64)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether the intersection has at least ``percent`` of the union, in whole numbers."""
    if not len(a) or not len(b):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)
