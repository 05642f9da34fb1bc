"""Byte-level BPE encoding and decoding over arrays.

Pre-tokens come from the code point classes and the automaton of ``pretokens``; each different slice of a
run of texts is merged once, by a cache of merged slices; ids and offsets are gathered for all texts at once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from bandstand.llm.merges import PairTable, merged_symbols, rank_pairs
from bandstand.llm.pretokens import pretoken_starts
from bandstand.llm.ragged import spread, text_slices, unique_slices

CACHE_SLICES = 60_000


class Codec:
    """Encodes and decodes by a table of ranks."""

    def __init__(self, pairs: PairTable, ranks: dict[bytes, int]):
        self._pairs, self._ranks = pairs, ranks
        self._cache: dict[bytes, tuple[int, ...]] = {}
        size = max(ranks.values()) + 1
        self._length = np.zeros(size, np.int64)
        words = [b""] * size
        for word, i in ranks.items():
            words[i] = word
            self._length[i] = len(word)
        self._start = np.cumsum(self._length) - self._length
        self._blob = np.frombuffer(b"".join(words), np.uint8)

    def _learn(self, pieces: list[bytes]) -> None:
        """Merge the pieces that the cache lacks, all at once; a piece with a rank of its own is one id."""
        known, ranks = self._cache, self._ranks
        if len(known) > CACHE_SLICES:
            known.clear()
        new = [p for p in pieces if p not in known]
        rest = []
        for piece in new:
            whole = ranks.get(piece)
            if whole is None:
                rest.append(piece)
            else:
                known[piece] = (whole,)
        if rest:
            lengths = np.fromiter(map(len, rest), np.int64, len(rest))
            data = np.frombuffer(b"".join(rest), np.uint8)
            symbols, counts = merged_symbols(self._pairs, data, np.cumsum(lengths) - lengths, lengths)
            flat, end = symbols.tolist(), np.cumsum(counts).tolist()
            for piece, a, b in zip(rest, [0, *end], end):
                known[piece] = tuple(flat[a:b])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts, each text's offset among them, and each id's byte offset in ``data``."""
        starts = pretoken_starts(data, offsets)
        ends = np.append(starts[1:], len(data))
        one, back = unique_slices(data, starts, ends)
        blob, known = data.tobytes(), self._cache
        pieces = [blob[a:b] for a, b in zip(starts[one].tolist(), ends[one].tolist())]
        self._learn(pieces)
        merged = [known[piece] for piece in pieces]
        lengths = np.fromiter(map(len, merged), np.int64, len(merged))
        flat = np.fromiter(chain.from_iterable(merged), np.uint32, int(lengths.sum()))
        first = np.cumsum(lengths) - lengths
        ids = flat[spread(first[back], lengths[back])]
        upto = np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths[back])])
        sizes = self._length[ids]
        return ids, upto[np.searchsorted(starts, offsets)], np.cumsum(sizes) - sizes

    def decode(self, ids: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        """Bytes of the ids, each at its offset; without offsets one after the other."""
        lengths = self._length[ids]
        taken = self._blob[spread(self._start[ids], lengths)]
        if at is None:
            return taken
        out = np.zeros(int((at + lengths).max(initial=0)), np.uint8)
        out[spread(at, lengths)] = taken
        return out


@cache
def codec(path: str) -> Codec:
    return Codec(*rank_pairs(path))


def encode_texts(docs: DataFrame, id_column: str, text_column: str, vocabulary: str, with_offsets: bool = True) -> DataFrame:
    """Per row ``doc_id, ids`` and, if asked for, ``offsets``: the byte at which each token begins.

    ``vocabulary`` is the path of a rank file that every executor can read. A null text counts as empty and
    has no ids; a null id stays null; repeated rows are encoded row by row; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = codec(vocabulary)
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column(1)):
                ids, bounds, at = known.encode(data, offsets)
                columns = [batch.column(0).slice(lo, hi - lo), _lists(ids.astype(np.int32), bounds)]
                if with_offsets:
                    inside = at - np.repeat(offsets[:-1], np.diff(bounds))
                    columns.append(_lists(inside, bounds))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "offsets"][: len(columns)])

    picked = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    schema = "doc_id long, ids array<int>" + (", offsets array<long>" if with_offsets else "")
    return picked.mapInArrow(run, schema)


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))


def token_digests(docs: DataFrame, id_column: str, text_column: str, vocabulary: str) -> DataFrame:
    """Per row ``doc_id, n_tokens, ids_sha256, decoded_sha256``: the text encoded and, by the offsets kept, decoded again.

    One worker does both, so the ids are not sent anywhere. Nulls, repeated rows and other columns are treated as by
    ``encode_texts``, the ids hashed as by ``decode_ids``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = codec(vocabulary)
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column(1)):
                ids, bounds, at = known.encode(data, offsets)
                ids, decoded = ids.astype("<u4"), known.decode(ids, at)
                id_digests = [hashlib.sha256(ids[a:b]).hexdigest() for a, b in zip(bounds[:-1], bounds[1:])]
                text_digests = [hashlib.sha256(decoded[a:b]).hexdigest() for a, b in zip(offsets[:-1], offsets[1:])]
                columns = [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(bounds)), pa.array(id_digests), pa.array(text_digests)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    picked = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return picked.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def decode_ids(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """Per row of ``doc_id, ids`` the ids' number, their bytes and the digests of both.

    Columns ``doc_id, n_tokens, ids_sha256, decoded, decoded_sha256``; ids are hashed as little-endian
    unsigned 32-bit integers. Ids are those of the vocabulary; null ids count as none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = codec(vocabulary)
        for batch in batches:
            lists = batch.column(1)
            bounds = lists.offsets.to_numpy()
            values = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            here = batch.column(0)
            rows: list[tuple] = []
            size = 0
            lo = 0
            for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                ids = values[a:b]
                text = known.decode(ids).tobytes()
                rows.append((b - a, hashlib.sha256(ids.tobytes()).hexdigest(), text, hashlib.sha256(text).hexdigest()))
                size += len(text)
                if size > 1 << 24 or k + 1 == len(bounds) - 1:
                    columns = [here.slice(lo, len(rows))]
                    columns += [pa.array(x, t) for x, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.binary(), pa.string()))]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded", "decoded_sha256"])
                    lo, rows, size = k + 1, [], 0

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded binary, decoded_sha256 string"
    ids = F.coalesce(F.col("ids"), F.array().cast("array<int>")).alias("ids")
    return encoded.select("doc_id", ids).mapInArrow(run, schema)
