"""Token counts by rank-synchronous merging of ragged arrays.

The pre-tokens of a run of texts are held in flat numpy arrays. In each round every sequence merges its
lowest-rank pair, and the symbols that survive are counted. No text is tokenized one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from bandstand.llm.merges import PairTable, json_pairs, merged_counts
from bandstand.llm.pretokens import pretoken_starts
from bandstand.llm.ragged import text_slices, unique_slices

SCHEMA = "doc_id long, n_bytes long, n_tokens long"


def _without_special(data: np.ndarray, offsets: np.ndarray, special: tuple[str, ...]):
    """The texts without special strings, cut where one stood, and how many each text had.

    Returns bytes, offsets of the pieces, for each text the number of its first piece, and the counts.
    """
    blob, marks = data.tobytes(), [s.encode() for s in special]
    counts = np.zeros(len(offsets) - 1, np.int64)
    first = np.arange(len(offsets))
    if not any(m in blob for m in marks):
        return data, offsets, first, counts
    pieces, bounds, length = [], [], 0
    for k, (lo, hi) in enumerate(zip(offsets[:-1], offsets[1:])):
        first[k] = len(bounds)
        at = int(lo)
        while True:
            # The leftmost special string; the longest of those that begin there.
            hits = [(i, -len(m)) for m in marks if (i := blob.find(m, at, int(hi))) >= 0]
            end, size = min(hits, default=(int(hi), 0))
            bounds.append(length)
            pieces.append(blob[at:end])
            length += end - at
            if not hits:
                break
            counts[k] += 1
            at = end - size
    first[-1] = len(bounds)
    bounds.append(length)
    return np.frombuffer(b"".join(pieces), np.uint8), np.array(bounds, np.int64), first, counts


def count_tokens(table: PairTable, special: tuple[str, ...], data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Tokens of each text; the texts lie one after the other in ``data``."""
    data, bounds, first, total = _without_special(data, offsets, special)
    starts = pretoken_starts(data, bounds)
    ends = np.append(starts[1:], len(data))
    # Equal pre-tokens of the run are merged once.
    one, back = unique_slices(data, starts, ends)
    counts = merged_counts(table, data, starts[one], (ends - starts)[one])[back]
    upto = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)])
    at = np.searchsorted(starts, bounds[first])
    return total + upto[at[1:]] - upto[at[:-1]]


def token_counts(docs: DataFrame, id_column: str, text_column: str, vocabulary: str) -> DataFrame:
    """``doc_id, n_bytes, n_tokens`` of every row; a null text counts as empty, a null id stays null.

    ``vocabulary`` is the path of a byte-level BPE file in JSON that every executor can read. Special
    strings of the vocabulary inside a text count as one token each, as its library does by default.
    Repeated rows are counted row by row; other columns of ``docs`` are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, special = json_pairs(vocabulary)
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column(1)):
                counts = count_tokens(table, special, data, offsets)
                columns = [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(offsets)), pa.array(counts)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_tokens"])

    picked = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return picked.mapInArrow(run, SCHEMA)


def over_limit(limit: int) -> Column:
    return F.col("n_tokens") > limit
