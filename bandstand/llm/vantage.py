"""Nearest vectors by vantage-point trees, one tree per shard.

The vectors are dealt to shards by a hash of their id. A task builds the tree of its shard: each node has a vantage
point and parts its other vectors at their median angle to it. The queries are dealt to every shard and go down its
tree in batches: a branch is left out where the triangle inequality, tightened by ``factor``, says that nothing in
it is nearer than what was found. With a factor of one nothing nearer can be left out and the search is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

BATCH = 512
_CLOSE = 1e-12  # rounding of a product of unit vectors
_ANGLE = 1e-6  # the same, as an angle


@dataclass(frozen=True)
class VantageSearch:
    """Neighbours of a query, factor of the pruning bound (1: exact), vectors of a leaf, bytes of a shard's vectors,
    vectors below which a shard is not split for the sake of more tasks, seed of the vantage points."""

    neighbours: int = 5
    factor: float = 1.0
    leaf: int = 256
    shard_bytes: int = 64 << 20
    least_rows: int = 2048
    seed: int = 11


def _angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


class VantageTree:
    """Tree over the rows of ``unit``; ``order`` gives the row at each place of the tree."""

    def __init__(self, unit: np.ndarray, leaf: int, seed: int):
        rng = np.random.default_rng(seed)
        order = np.arange(len(unit))
        # A node: first and end place, the angles of its inner and outer part, and their node numbers; leaves have none.
        nodes: list[tuple] = []
        open_nodes = [(0, len(unit), None, 0)]
        while open_nodes:
            lo, hi, parent, side = open_nodes.pop()
            number = len(nodes)
            if parent is not None:
                nodes[parent][3][side] = number
            if hi - lo <= leaf:
                nodes.append((lo, hi, None, None))
                continue
            pick = int(rng.integers(lo, hi))
            order[[lo, pick]] = order[[pick, lo]]
            rest = order[lo + 1 : hi].copy()
            angle = _angles(unit[rest] @ unit[order[lo]])
            half = len(rest) // 2
            by_angle = np.argpartition(angle, half)
            order[lo + 1 : hi] = rest[by_angle]
            inner, outer = angle[by_angle[:half]], angle[by_angle[half:]]
            bounds = ((float(inner.min()), float(inner.max())), (float(outer.min()), float(outer.max())))
            nodes.append((lo, hi, bounds, [0, 0]))
            open_nodes += [(lo + 1 + half, hi, number, 1), (lo + 1, lo + 1 + half, number, 0)]
        self.nodes, self.order, self.unit = nodes, order, unit[order]

    def search(self, queries: np.ndarray, most: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of query and row among which are the ``most`` rows nearest to each query, with all ties."""
        best = np.full((len(queries), most), -np.inf)
        self._probe(0, np.arange(len(queries)), queries, best)
        sure = best[:, -1].copy()
        best[:] = -np.inf
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        open_nodes = [(0, np.arange(len(queries)), np.zeros(len(queries)))]
        while open_nodes:
            at, who, bound = open_nodes.pop()
            lo, hi, parts, children = self.nodes[at]
            if at:
                who = who[bound * factor <= _angles(np.maximum(sure[who], best[who, -1])) + _ANGLE]
            if not len(who):
                continue
            end = hi if parts is None else lo + 1
            near = queries[who] @ self.unit[lo:end].T
            best[who] = -np.partition(-np.concatenate([best[who], near], 1), most - 1, 1)[:, :most]
            best[who] = -np.sort(-best[who], 1)
            floor = np.maximum(sure[who], best[who, -1]) - _CLOSE
            row, column = np.nonzero(near >= floor[:, None])
            found.append((who[row], lo + column, near[row, column]))
            if parts is None:
                continue
            angle = _angles(near[:, 0])
            # The last pushed is searched first: the inner part, which is the smaller ball.
            for child, (least, largest) in reversed(list(zip(children, parts))):
                open_nodes.append((child, who, np.maximum(least - angle, angle - largest)))
        floor = np.maximum(sure, best[:, -1]) - _CLOSE
        who, place, near = (np.concatenate(x) for x in zip(*found))
        keep = near >= floor[who]
        return who[keep], self.order[place[keep]]

    def _probe(self, at: int, who: np.ndarray, queries: np.ndarray, best: np.ndarray) -> None:
        """Nearest rows of the leaf that each query falls into: a first bound for its search."""
        while True:
            lo, hi, parts, children = self.nodes[at]
            if parts is None:
                near = queries[who] @ self.unit[lo:hi].T
                best[who] = -np.sort(-np.concatenate([best[who], near], 1), 1)[:, : best.shape[1]]
                return
            inside = _angles(queries[who] @ self.unit[lo]) <= parts[0][1]
            if inside.any() and not inside.all():
                self._probe(children[1], who[~inside], queries, best)
                who = who[inside]
                at = children[0]
            else:
                at = children[0 if inside.any() else 1]


def _scaled(rows: np.ndarray) -> np.ndarray:
    """Rows divided by a power of two, so that their squares neither vanish nor overflow; no digit changes."""
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(1))[1][:, None])


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sums in the order of the components, so that equal vectors have equal products wherever they lie."""
    total = np.zeros(len(a))
    for k in range(a.shape[1]):
        total += a[:, k] * b[:, k]
    return total


class _Shard:
    """Vectors of one shard, equal ones held once with their smallest ids, and their tree."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, p: VantageSearch):
        bytes_of = np.ascontiguousarray(rows).view(np.dtype((np.void, rows.shape[1] * rows.itemsize))).ravel()
        _, one, back = np.unique(bytes_of, return_index=True, return_inverse=True)
        order = np.lexsort((ids, back))
        sizes = np.bincount(back)
        first = np.cumsum(sizes) - sizes
        # A query takes at most its neighbours and itself from equal vectors.
        self.sizes = np.minimum(sizes, p.neighbours + 1)
        self.ids, self.first = ids[order], first
        self.rows = _scaled(rows[one].astype(np.float64))
        self.norms = np.sqrt(_dot(self.rows, self.rows))
        self.tree = VantageTree(self.rows / self.norms[:, None], p.leaf, p.seed)
        self.p = p

    def answer(self, ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query id, row id and cosine of the nearest rows of this shard to each query."""
        rows = _scaled(rows.astype(np.float64))
        norms = np.sqrt(_dot(rows, rows))
        most = min(self.p.neighbours + 1, len(self.rows))
        who, row = self.tree.search(rows / norms[:, None], most, self.p.factor)
        cosine = np.empty(len(who))
        for lo in range(0, len(who), 1 << 14):
            w, r = who[lo : lo + (1 << 14)], row[lo : lo + (1 << 14)]
            cosine[lo : lo + (1 << 14)] = _dot(rows[w], self.rows[r]) / (norms[w] * self.norms[r])
        many = self.sizes[row]
        who, cosine = np.repeat(who, many), np.repeat(cosine, many)
        inside = np.arange(len(who)) - np.repeat(np.cumsum(many) - many, many)
        found = self.ids[np.repeat(self.first[row], many) + inside]
        other = found != ids[who]
        who, cosine, found = who[other], cosine[other], found[other]
        order = np.lexsort((found, -cosine, who))
        who, cosine, found = who[order], cosine[order], found[order]
        counts = np.bincount(who, minlength=len(ids))
        keep = np.arange(len(who)) - np.repeat(np.cumsum(counts) - counts, counts) < self.p.neighbours
        return ids[who[keep]], found[keep], cosine[keep]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int, int], np.ndarray, np.ndarray]]:
    """Shard, width and role with the ids and vectors of the rows that have them, batch by batch."""
    for batch in batches:
        keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)], 1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        ids, lists = batch.column(3).to_numpy(zero_copy_only=False), batch.column(4)
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
            if hi > lo:
                shard, width, role = (int(x) for x in keys[lo])
                flat = lists.slice(lo, hi - lo).flatten().to_numpy(zero_copy_only=False)
                yield (shard, width, role), ids[lo:hi], flat.reshape(hi - lo, width)


def _usable(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    vector = F.col(vector_column)
    if df.schema[vector_column].dataType.simpleString() not in ("array<float>", "array<double>"):
        vector = vector.cast("array<double>")
    picked = df.select(F.col(id_column).cast("long").alias("id"), vector.alias("vector")).where("id is not null and vector is not null")
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x.cast("double")) <= 1.7976931348623157e308))
    return picked.where(F.coalesce(finite & F.exists("vector", lambda x: x != 0), F.lit(False)))


def nearest_vectors(vectors: DataFrame, id_column: str, vector_column: str, is_query: Column, p: VantageSearch = VantageSearch()) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``p.neighbours`` vectors of largest cosine for each row that ``is_query`` picks.

    ``is_query`` is a condition on the ids, which stand in the column ``id``. Every other row of the table is a candidate; all
    of them, if there are fewer. Ties go to the smaller id. The score is the cosine of the given vectors in double precision. Null ids and
    vectors that are null, empty, zero or hold null or non-finite components take no part. Vectors of different width
    are no candidates of each other. Of rows that share an id the one with the least vector counts. An empty table or one without
    queries gives an empty result; other columns are not read.
    """
    spark = vectors.sparkSession
    usable = _usable(vectors, id_column, vector_column)
    sizes = usable.groupBy("id").agg(F.count("*").alias("rows"), F.max(F.size("vector")).alias("width"))
    n, most, width = sizes.agg(F.count("*"), F.max("rows"), F.max("width")).first()
    if (most or 1) > 1:
        usable = usable.groupBy("id").agg(F.min("vector").alias("vector"))
    by_bytes = -(-(n * (width or 1) * 8) // p.shard_bytes)
    for_tasks = min(spark.sparkContext.defaultParallelism, -(-n // p.least_rows))
    shards = max(1, by_bytes, for_tasks)
    columns = [F.size("vector").alias("width"), F.col("id"), F.col("vector")]
    of_id = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")
    held = usable.select(of_id.alias("shard"), columns[0], F.lit(0).alias("role"), *columns[1:])
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    asked = usable.where(is_query).select(every.alias("shard"), columns[0], F.lit(1).alias("role"), *columns[1:])
    dealt = held.union(asked).repartition(shards, "shard").sortWithinPartitions("shard", "width", "role", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, rows, shard = None, [], [], None
        for (number, width, role), run_ids, run_rows in _runs(batches):
            if key != (number, width):
                key, ids, rows, shard = (number, width), [], [], None
            if role == 0:
                ids.append(run_ids)
                rows.append(run_rows)
                continue
            if shard is None and ids:
                shard = _Shard(np.concatenate(ids), np.concatenate(rows), p)
                ids, rows = [], []
            for lo in range(0, len(run_ids) if shard is not None else 0, BATCH):
                found = shard.answer(run_ids[lo : lo + BATCH], run_rows[lo : lo + BATCH])
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["query_id", "vec_id", "score"])

    found = dealt.mapInArrow(run, "query_id long, vec_id long, score double")
    nearest = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= p.neighbours)
    return ranked.select("query_id", "rank", "vec_id", "score")
