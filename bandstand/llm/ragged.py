"""Ragged numpy arrays: many byte strings held as one buffer with offsets, and hashes of their slices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_PLACES = 64


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values, one to one."""
    x = x + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _values(byte: np.ndarray, place: np.ndarray) -> np.ndarray:
    """A scrambled value for each byte at each place of a slice."""
    return mix(mix(place.astype(np.uint64) * np.uint64(256) + byte.astype(np.uint64)))


_TABLE = _values(np.tile(np.arange(256), _PLACES), np.repeat(np.arange(_PLACES), 256))


def slice_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of ``data[start:end]`` for each slice; equal bytes have equal hashes wherever they lie.

    The slices come in ascending order and do not overlap. Each byte is scrambled together with its place in
    the slice before the values are added, so no pattern of bytes cancels out. Seeds give unrelated hashes.
    """
    place = np.zeros(len(data), np.int32)
    inside = starts < len(data)
    place[starts[inside]] = starts[inside]
    place = np.arange(len(data), dtype=np.int32) - np.maximum.accumulate(place)
    values = _TABLE[np.minimum(place, _PLACES - 1) * 256 + data]
    far = np.flatnonzero(place >= _PLACES)
    if len(far):
        values[far] = _values(data[far], place[far])
    if seed:
        values = mix(values ^ mix(np.full(1, seed, np.uint64)))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    return mix((sums[ends] - sums[starts]) + mix((ends - starts).astype(np.uint64)))


def unique_slices(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of one slice of each different content, and for each slice the place of its content among them.

    Slices that share a hash are compared byte by byte; should two differ, all are told apart by their bytes.
    """
    hashes = slice_hashes(data, starts, ends) if hashes is None else hashes
    _, one, back = np.unique(hashes, return_index=True, return_inverse=True)
    lengths, as_first = ends - starts, one[back]
    alike = (lengths == lengths[as_first]).all()
    again = np.flatnonzero(as_first != np.arange(len(starts)))
    if alike:
        alike = (data[spread(starts[again], lengths[again])] == data[spread(starts[as_first[again]], lengths[again])]).all()
    if alike:
        return one, back
    seen: dict[bytes, int] = {}
    blob, firsts, places = data.tobytes(), [], np.zeros(len(starts), np.int64)
    for k, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
        places[k] = seen.setdefault(blob[a:b], len(seen))
        if places[k] == len(firsts):
            firsts.append(k)
    return np.array(firsts, np.int64), places


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes of all elements of the slices, one slice after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)


def text_slices(
    column: pa.Array, most: int = SLICE_BYTES, rows: int | None = None
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with about ``most`` bytes of text, of at most ``rows`` rows: first row, end row, their bytes, their offsets.

    A null is an empty text. A text above ``most`` is a run of its own and is not cut.
    """
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offset_buffer, data_buffer = column.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1)
        hi = hi if rows is None else min(hi, lo + rows)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi
