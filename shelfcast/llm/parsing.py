"""Locally consistent parsing of many texts at once.

A text is a row of symbols, at first its characters. On every level, runs of one symbol
collapse into one, and deterministic coin tossing gives each symbol a label from its own and
its left neighbour's bits, three times over, until labels are smaller than 6 and neighbours
always differ. Local maxima of the labels start phrases. A phrase is named by a hash of the
symbols in it, and the names are the symbols of the next level. A cut depends on a few
symbols around it only, so equal substrings get equal phrases inside, wherever they stand.

All texts of a batch lie in one array; a text's first symbol has a made-up left neighbour,
so that no text depends on the one before it.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

SLOTS = 64
# Names of phrases on this level and above describe a text; lower ones are single syllables.
FIRST_LEVEL = 2
ROOT_BYTES = 8
FINGERPRINT_BYTES = ROOT_BYTES + SLOTS
# Marks of a slot: 0 is empty, others are taken from the smallest name.
MARKS = 255
LONGEST_PHRASE = 64
MAX64 = np.uint64(0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


WEIGHTS = mix(np.arange(1, LONGEST_PHRASE + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
WEIGHTS |= np.uint64(1)


def _toss_table() -> np.ndarray:
    """New label of a symbol with label b right of label a, for 7-bit labels."""
    a, b = np.meshgrid(np.arange(128), np.arange(128), indexing="ij")
    differ = a ^ b
    lowest = np.zeros_like(differ)
    for bit in reversed(range(7)):
        lowest[(differ >> bit) & 1 == 1] = bit
    return (2 * lowest + ((b >> lowest) & 1)).astype(np.uint8).ravel()


TOSS = _toss_table()


def _labels(symbols: np.ndarray, starts: np.ndarray) -> np.ndarray:
    left = np.empty_like(symbols)
    left[1:] = symbols[:-1]
    left[starts] = ~symbols[starts]
    differ = symbols ^ left
    lowest = differ & (~differ + np.uint64(1))
    index = (lowest.astype(np.float64).view(np.int64) >> 52) - 1023
    labels = (2 * index + ((symbols & lowest) != 0)).astype(np.uint8)
    for _ in range(3):
        before = np.empty(len(labels), np.uint16)
        before[1:] = labels[:-1]
        before[starts] = labels[starts] ^ 1
        labels = TOSS[(before << np.uint16(7)) | labels]
    return labels


def next_level(
    symbols: np.ndarray, starts: np.ndarray, level: int
) -> tuple[np.ndarray, np.ndarray]:
    """Phrase names and the first phrase of each text. Every text has a symbol at least."""
    keep = np.empty(len(symbols), bool)
    keep[1:] = symbols[1:] != symbols[:-1]
    keep[starts] = True
    at = np.flatnonzero(keep)
    values = symbols[at]
    starts = np.searchsorted(at, starts)
    labels = _labels(values, starts)
    if len(at) < len(symbols):
        runs = np.diff(np.append(at, len(symbols))).astype(np.uint64)
        long = runs > 1
        values[long] = mix(values[long] ^ mix(runs[long]))
    peak = np.zeros(len(labels), bool)
    peak[1:-1] = (labels[1:-1] > labels[:-2]) & (labels[1:-1] > labels[2:])
    # The last symbol of a text stays in the phrase before it.
    peak[starts[1:] - 1] = False
    peak[starts] = True
    heads = np.flatnonzero(peak)
    lengths = np.diff(np.append(heads, len(labels)))
    place = np.arange(len(labels)) - np.repeat(heads, lengths)
    sums = np.add.reduceat(values * WEIGHTS[place], heads)
    return mix(sums + np.uint64(level)), np.searchsorted(heads, starts)


def fingerprints(texts: Sequence[str]) -> np.ndarray:
    """One row of bytes per text: its name, then the sketch of its phrase names.

    The name is the phrase that holds the whole text. The sketch deals the distinct phrase
    names of all upper levels over the slots and marks each slot by its smallest name. An
    empty text has zeros only.
    """
    out = np.zeros((len(texts), FINGERPRINT_BYTES), np.uint8)
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    owners = np.flatnonzero(lengths)
    if not owners.size:
        return out
    symbols = codes.astype(np.uint64)
    starts = (np.cumsum(lengths) - lengths)[owners]
    smallest = np.full(len(texts) * SLOTS, MAX64)
    roots = np.zeros(len(texts), np.uint64)
    level = 0
    while owners.size:
        level += 1
        symbols, starts = next_level(symbols, starts, level)
        counts = np.diff(np.append(starts, len(symbols)))
        if level >= FIRST_LEVEL:
            slot = np.repeat(owners * SLOTS, counts) + (symbols % np.uint64(SLOTS)).astype(np.int64)
            np.minimum.at(smallest, slot, symbols // np.uint64(SLOTS))
            done = counts == 1
            roots[owners[done]] = symbols[starts[done]]
            if done.any():
                symbols = symbols[np.repeat(~done, counts)]
                owners, counts = owners[~done], counts[~done]
                starts = np.cumsum(counts) - counts
    marks = np.where(smallest == MAX64, 0, mix(smallest) % np.uint64(MARKS) + np.uint64(1))
    out[:, :ROOT_BYTES] = roots.astype(">u8").view(np.uint8).reshape(-1, ROOT_BYTES)
    out[:, ROOT_BYTES:] = marks.astype(np.uint8).reshape(-1, SLOTS)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated share of phrases in common, 0 to 1, for rows of fingerprints.

    Slots that are empty on both sides say nothing. Chance agreement of marks is taken off.
    Two empty texts are alike.
    """
    same_name = (a[:, :ROOT_BYTES] == b[:, :ROOT_BYTES]).all(axis=1)
    left, right = a[:, ROOT_BYTES:], b[:, ROOT_BYTES:]
    used = ((left > 0) | (right > 0)).sum(axis=1)
    alike = ((left == right) & (left > 0)).sum(axis=1)
    share = alike / np.maximum(used, 1)
    corrected = np.clip((share * MARKS - 1) / (MARKS - 1), 0, 1)
    return np.where(same_name, 1.0, corrected)
