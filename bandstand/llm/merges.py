"""Byte-pair merges over ragged arrays, all sequences at once."""

from __future__ import annotations

import base64
import json
from functools import cache

import numpy as np

from bandstand.llm.ragged import spread

_NONE = np.iinfo(np.int64).max


class PairTable:
    """Ranks of symbol pairs and the symbols that they become; looked up in bulk."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, becomes: np.ndarray, byte_ids: np.ndarray):
        keys = (left.astype(np.int64) << 32) | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.becomes, self.byte_ids = keys[order], rank[order], becomes[order], byte_ids
        # A slot holds one pair; the few pairs that share a slot are found by bisection.
        bits = 20
        self._mask = np.uint64((1 << bits) - 1)
        self._head = np.full(1 << bits, -1, np.int32)
        slot = self._slot(self.keys)
        self._more = np.zeros(1 << bits, bool)
        taken, counts = np.unique(slot, return_counts=True)
        self._head[slot] = np.arange(len(slot), dtype=np.int32)
        self._more[taken[counts > 1]] = True

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        x = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((x >> np.uint64(40)) & self._mask).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index of each pair, -1 where there is none."""
        keys = (left.astype(np.int64) << 32) | right
        slot = self._slot(keys)
        at = self._head[slot].astype(np.int64)
        found = np.where((at >= 0) & (self.keys[at] == keys), at, -1)
        unsure = np.flatnonzero((found < 0) & self._more[slot])
        if len(unsure):
            place = np.minimum(np.searchsorted(self.keys, keys[unsure]), len(self.keys) - 1)
            found[unsure] = np.where(self.keys[place] == keys[unsure], place, -1)
        return found


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of bytes in byte-level vocabulary files: those that print stay, others move up."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in set(keep)]
    return {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(moved)}


@cache
def json_pairs(path: str) -> tuple[PairTable, tuple[str, ...]]:
    """The merge list of a vocabulary file in JSON, and its special strings."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
    alphabet = byte_alphabet()
    byte_ids = np.zeros(256, np.int64)
    for c, b in alphabet.items():
        byte_ids[b] = vocab[c]
    left, right, becomes = (np.array(x, np.int64) for x in zip(*[(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]))
    special = tuple(t["content"] for t in spec["added_tokens"])
    return PairTable(left, right, np.arange(len(pairs), dtype=np.int64), becomes, byte_ids), special


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@cache
def rank_pairs(path: str) -> tuple[PairTable, dict[bytes, int]]:
    """The pairs of a rank file, where any two neighbours merge whose bytes together have a rank."""
    ranks = read_ranks(path)
    byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
    pairs = [
        (left, right, rank)
        for word, rank in ranks.items()
        for cut in range(1, len(word))
        if (left := ranks.get(word[:cut])) is not None and (right := ranks.get(word[cut:])) is not None
    ]
    left, right, rank = (np.array(x, np.int64) for x in zip(*pairs))
    return PairTable(left, right, rank, rank, byte_ids), ranks


def merged_counts(table: PairTable, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Symbols that are left of each byte slice after all merges."""
    counts = lengths.astype(np.int64).copy()
    for index, size, _ in _rounds(table, data, starts, lengths):
        counts[index] = size
    return counts


def merged_symbols(table: PairTable, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols themselves, slice after slice, and how many each slice has."""
    done = list(_rounds(table, data, starts, lengths))
    counts = np.zeros(len(lengths), np.int64)
    for index, size, _ in done:
        counts[index] = size
    out = np.empty(int(counts.sum()), np.int64)
    begin = begin_of(counts)
    for index, size, symbol in done:
        out[spread(begin[index], size)] = symbol
    return out, counts


def _rounds(table, data, starts, lengths):
    """Yields the sequences that are done: their numbers, sizes and symbols.

    In each round every sequence finds its pair of lowest rank and merges all its occurrences, from left to
    right; a sequence without such a pair is done and leaves the arrays.
    """
    index = np.flatnonzero(lengths > 0)
    size = lengths[index].astype(np.int64)
    symbol = table.byte_ids[data[spread(starts[index].astype(np.int64), size)]]
    pair = _pair_ranks(table, symbol, size)
    while len(index):
        lowest = np.minimum.reduceat(pair, begin_of(size))
        live = lowest < _NONE
        if not live.all():
            keep = np.repeat(live, size)
            yield index[~live], size[~live], symbol[~keep]
            symbol, pair, index, size, lowest = symbol[keep], pair[keep], index[live], size[live], lowest[live]
            if not len(index):
                return
        at = np.flatnonzero(pair == np.repeat(lowest, size))
        # Of a run of overlapping hits (a pair of equal symbols) every second one merges.
        fresh = np.ones(len(at), bool)
        fresh[1:] = at[1:] != at[:-1] + 1
        run = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - run) % 2 == 0]
        symbol[at] = table.becomes[pair[at] & 0xFFFFFFFF]
        keep = np.ones(len(symbol), bool)
        keep[at + 1] = False
        changed = np.zeros(len(symbol), bool)
        changed[at] = True
        owner = np.searchsorted(begin_of(size), at, "right") - 1
        size = size - np.bincount(owner, minlength=len(size))
        symbol, pair, changed = symbol[keep], pair[keep], changed[keep]
        pair = _pair_ranks(table, symbol, size, pair, changed)


def begin_of(size: np.ndarray) -> np.ndarray:
    return np.cumsum(size) - size


def _pair_ranks(table, symbol, size, old=None, changed=None) -> np.ndarray:
    """For each symbol its rank with the next one of its sequence, with the table's row in the low 32 bits."""
    last = np.cumsum(size) - 1
    if old is None:
        look = np.ones(len(symbol), bool)
        out = np.full(len(symbol), _NONE)
    else:
        look, out = changed.copy(), old
        look[:-1] |= changed[1:]
    look[last] = False
    out[last] = _NONE
    at = np.flatnonzero(look)
    found = table.find(symbol[at], symbol[at + 1])
    out[at] = np.where(found >= 0, (table.rank[found] << 32) | found, _NONE)
    return out
