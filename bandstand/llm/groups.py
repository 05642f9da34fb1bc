"""Arrow batches of a sorted partition, dealt out again in whole groups."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

ROWS = 20_000


def group_edges(keys: list[pa.Array]) -> np.ndarray:
    """First row of each run of equal keys, and the end."""
    n = len(keys[0])
    change = np.zeros(n + 1, bool)
    change[[0, n]] = True
    for key in keys:
        values = key.to_numpy(zero_copy_only=False)
        change[1:n] |= values[1:] != values[:-1]
    return np.flatnonzero(change)


def whole_groups(batches: Iterable[pa.RecordBatch], keys: int, rows: int = ROWS) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of whole groups with the groups' edges; the first ``keys`` columns are the sorted group key.

    No more rows are held than one batch and one group need.
    """
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < rows:
            continue
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        edges = group_edges(whole.columns[:keys])
        if len(edges) > 2:
            yield whole.slice(0, int(edges[-2])), edges[:-1]
            whole = whole.slice(int(edges[-2]))
        held, count = [whole], whole.num_rows
    if count:
        whole = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        yield whole, group_edges(whole.columns[:keys])


def pairs_within(edges: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of all pairs within the groups, in runs of a bounded length."""
    sizes = np.diff(edges)
    for size in np.unique(sizes[sizes > 1]):
        one, two = np.triu_indices(size, 1)
        starts = edges[:-1][sizes == size]
        step = max(1, 40_000 // len(one))
        for k in range(0, len(starts), step):
            here = starts[k : k + step, None]
            yield (here + one).ravel(), (here + two).ravel()


def fixed_rows(column: pa.Array, width: int, dtype=np.uint8) -> np.ndarray:
    """A binary column of values of equal length as a matrix."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    first = int(np.frombuffer(offsets, np.int64)[column.offset]) if len(column) else 0
    flat = np.frombuffer(data, np.uint8)[first : first + len(column) * width] if len(column) else np.zeros(0, np.uint8)
    return flat.view(dtype).reshape(len(column), -1)
