"""Sets of word shingles and their minwise sketches, over runs of texts held as one byte array."""

from __future__ import annotations

import numpy as np

from bandstand.llm.ragged import mix, slice_hashes, spread

# White space and letters of the contract: fixed values.
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each lower-cased word and how many words each text has."""
    data = _LOWER[data]
    inside = ~_WHITE[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    filled = np.diff(offsets) > 0
    first, last = offsets[:-1][filled], offsets[1:][filled] - 1
    begins[first] = inside[first]
    ends[last] = inside[last]
    starts = np.flatnonzero(begins)
    hashes = slice_hashes(data, starts, np.flatnonzero(ends) + 1)
    return hashes, np.diff(np.searchsorted(starts, offsets))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within each text, and how many each text has.

    A text with fewer than ``words`` words, but at least one, has its whole sequence as its only shingle.
    """
    hashes, counts = _words(data, offsets)
    begin = np.cumsum(counts) - counts
    width = np.minimum(counts, words)
    n = np.where(counts > 0, counts - width + 1, 0)
    text = np.repeat(np.arange(len(counts)), n)
    at = spread(begin, n)
    total = width[text].astype(np.uint64)
    for k in range(words):
        # Each place has its own odd factor, so that the order of the words counts.
        part = hashes[np.minimum(at + k, len(hashes) - 1)] * np.uint64(2 * (k + 1) * 0x51D7348D2F1B3A65 + 1 & (1 << 64) - 1)
        total = total + np.where(k < width[text], part, np.uint64(0))
    shingle = mix(total)
    order = np.argsort(shingle)
    order = order[np.argsort(text[order].astype(np.uint32), kind="stable")]
    shingle, text = shingle[order], text[order]
    fresh = np.ones(len(shingle), bool)
    fresh[1:] = (shingle[1:] != shingle[:-1]) | (text[1:] != text[:-1])
    return shingle[fresh], np.bincount(text[fresh], minlength=len(counts))


def set_keys(shingles: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit keys per set that do not depend on order; equal sets have equal keys."""
    filled = np.flatnonzero(counts)
    begin = (np.cumsum(counts) - counts)[filled]
    out = []
    for salt in (0x6A09E667F3BCC908, 0xBB67AE8584CAA73B):
        key = np.zeros(len(counts), np.uint64)
        if len(filled):
            key[filled] = np.add.reduceat(mix(shingles ^ np.uint64(salt)), begin)
        out.append(key.astype(np.int64))
    return out[0], out[1]


def minwise(shingles: np.ndarray, counts: np.ndarray, functions: int) -> np.ndarray:
    """Minima of ``functions`` hash functions over each set, scrambled; a row per set, zeros for empty sets."""
    factors = mix(np.arange(functions, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
    filled = np.flatnonzero(counts)
    out = np.zeros((functions, len(counts)), np.uint64)
    if len(filled):
        begin = (np.cumsum(counts) - counts)[filled]
        for k, factor in enumerate(factors):
            out[k, filled] = np.minimum.reduceat(shingles * factor, begin)
    return mix(out.T + np.arange(functions, dtype=np.uint64))
