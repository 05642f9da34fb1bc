"""Near-duplicate vectors: a forest of random-projection trees with overlapping splits.

Each tree splits its nodes along random directions near the mean of the node; vectors within a margin of the
split go to both sides, so that close pairs seldom part. The narrower a node, the wider its margin, and a node no
wider than a linked pair is not split: a dense group stays whole. Nodes are split level by level for all trees at
once; only counts and moments per node are gathered. Vectors are compared within leaves, in double
precision. A pair that shares several leaves is counted in the smallest of them, so links are summed without
writing pairs. A leaf that cannot be split any more is compared in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from bandstand.llm.components import components
from bandstand.llm.groups import fixed_rows, whole_groups
from bandstand.llm.ragged import mix, slice_hashes, spread
from bandstand.runtime import Scratch


@dataclass(frozen=True)
class Forest:
    """Least cosine, trees, vectors in a leaf, levels, rows of a block, and the margin of a split.

    The margin is in standard deviations of the distance that a pair at the least cosine has along a random
    direction. With a quarter of it a pair at the least cosine stays together in some nine of ten levels; eight
    trees find 99 % of such pairs, and nearly all closer ones. That holds for scattered vectors; narrower nodes
    take a wider margin, so that they part no more pairs.
    """

    cosine: float = 0.9
    trees: int = 8
    leaf: int = 256
    levels: int = 24
    block: int = 1024
    margin: float = 0.25
    seed: int = 7


def _parsed(rows: DataFrame) -> DataFrame:
    """``vec_id``, two keys of the vector (null if it can link with nothing) and its values as doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: list = []
            vectors: list = []
            for value in batch.column(1):
                x = None if not value.is_valid else value.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if x is None or value.values.null_count or not len(x) or not np.isfinite(x).all() or not x.any():
                    keys.append((None, None))
                    vectors.append(None)
                    continue
                x = x + 0.0  # one kind of zero
                raw = x.view(np.uint8)
                one = int(slice_hashes(raw, np.zeros(1, np.int64), np.full(1, len(raw)))[0])
                two = int(np.bitwise_xor.reduce(mix(x.view(np.uint64) ^ mix(np.arange(len(x), dtype=np.uint64)))))
                keys.append((one, two))
                vectors.append(raw.tobytes())
            k1, k2 = (pa.array([None if k is None else k - (1 << 64) * (k >> 63) for k in col], pa.int64()) for col in zip(*keys)) if keys else (pa.array([], pa.int64()),) * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), k1, k2, pa.array(vectors, pa.binary())], names=["vec_id", "k1", "k2", "vector"])

    return rows.mapInArrow(run, "vec_id long, k1 long, k2 long, vector binary")


def _unit(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and unit vectors, a matrix for each length of vector."""
    sizes = np.array([len(v.as_buffer()) for v in column], np.int64)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        x = fixed_rows(column.take(pa.array(at)), int(size), np.float64)
        x = x / np.abs(x).max(1, keepdims=True)  # no overflow in the squares
        yield at, x / np.sqrt((x * x).sum(1, keepdims=True))


def _projected(classes: DataFrame, f: Forest) -> DataFrame:
    """A row per vector and tree: the root's number, the vector's, its places along the tree's directions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directions: dict[int, np.ndarray] = {}
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for at, x in _unit(batch.column(1)):
                dim = x.shape[1]
                if dim not in directions:
                    d = np.random.default_rng([f.seed, dim]).standard_normal((dim, f.trees * f.levels))
                    directions[dim] = d / np.sqrt((d * d).sum(0))
                places = (x @ directions[dim]).astype(np.float32).reshape(len(at) * f.trees, f.levels)
                roots = mix(np.uint64(dim) * np.uint64(1 << 20) + np.arange(f.trees, dtype=np.uint64)).astype(np.int64)
                step = np.arange(len(places) + 1, dtype=np.int32) * f.levels
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.tile(roots, len(at))),
                        pa.array(np.repeat(ids[at], f.trees)),
                        pa.array(np.full(len(places), (2 * (1 - f.cosine) / dim) ** 0.5)),
                        pa.ListArray.from_arrays(pa.array(step), pa.array(places.ravel())),
                    ],
                    names=["node", "cid", "apart", "places"],
                )

    return classes.select("cid", "vector").mapInArrow(run, "node long, cid long, apart double, places array<float>")


def _leaves(scratch: Scratch, rows: DataFrame, f: Forest) -> DataFrame:
    """``leaf, n, cid``: the leaves of all trees, their sizes and members."""
    rows = scratch.write(rows)
    leaves = []
    for level in range(f.levels):
        place = F.get("places", F.lit(level)).cast("double")
        stats = rows.groupBy("node").agg(F.count("*").alias("n"), F.avg(place).alias("mean"), F.stddev_pop(place).alias("sd"), F.max("apart").alias("far"))
        # Near the mean, but not the same for all: a share of the deviation, drawn by the node's number.
        drawn = F.pmod(F.xxhash64("node", F.lit("split")), F.lit(1001)) / 1000.0 - 0.5
        # With the distance a of a pair at the least cosine, a split parts 0.4 E(|a| - 2 m)+ / sd of such pairs; this m
        # keeps that share where sd is less than the 2.2 a of scattered vectors.
        margin = F.greatest(f.margin * F.col("far"), 0.68 * F.col("far") - 0.19 * F.col("sd"))
        # At sd = a, four tenths of the rows would go both ways, and most pairs of the node may be links: it stays whole.
        ends = (F.col("n") <= f.leaf) | (F.col("far") >= F.col("sd")) | F.lit(level + 1 == f.levels)
        cut = F.col("mean") + drawn * 0.5 * F.col("sd")
        stats = scratch.write(stats.select("node", "n", cut.alias("cut"), margin.alias("margin"), ends.alias("ends")))
        met = rows.join(stats, "node")
        leaves.append(scratch.write(met.where("ends").select(F.col("node").alias("leaf"), "n", "cid")))
        if stats.where("not ends").isEmpty():
            break
        sides = F.filter(
            F.array(
                F.when(place <= F.col("cut") + F.col("margin"), F.xxhash64("node", F.lit(0))),
                F.when(place >= F.col("cut") - F.col("margin"), F.xxhash64("node", F.lit(1))),
            ),
            lambda x: x.isNotNull(),
        )
        below = scratch.write(met.where("not ends").select(F.explode(sides).alias("node"), "cid", "apart", "places"))
        scratch.drop(rows, stats)
        rows = below
    out = leaves[0]
    for more in leaves[1:]:
        out = out.union(more)
    return out


def _share_smaller(one: np.ndarray, two: np.ndarray, leaf: int, starts: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Which rows of ``one`` share with which of ``two`` a leaf with a smaller number than ``leaf``."""
    sides = []
    for rows in (one, two):
        size = starts[rows + 1] - starts[rows]
        held = numbers[spread(starts[rows].astype(np.int64), size.astype(np.int64))]
        row = np.repeat(np.arange(len(rows)), size)
        sides.append((row[held < leaf], held[held < leaf]))
    both = np.intersect1d(sides[0][1], sides[1][1])
    shared = np.zeros((len(one), len(two)), bool)
    for k in range(0, len(both), 1024):
        some = both[k : k + 1024]
        marks = []
        for rows, (row, held) in zip((one, two), sides):
            at = np.minimum(np.searchsorted(some, held), len(some) - 1)
            hit = some[at] == held
            mark = np.zeros((len(rows), len(some)), np.float32)
            mark[row[hit], at[hit]] = 1
            marks.append(mark)
        shared |= marks[0] @ marks[1].T > 0
    return shared


def _compared(leaves: DataFrame, vectors: DataFrame, f: Forest) -> DataFrame:
    """Per leaf and vector: ``cid``, the weight of its links counted here, and a vector it is connected with."""
    lists = leaves.groupBy("cid").agg(F.sort_array(F.collect_list("leaf")).alias("leaves"))
    known = vectors.select("cid", "weight", "vector").join(lists, "cid")
    chunks = F.ceil(F.col("n") / f.block).cast("int")
    mine = F.pmod(F.xxhash64("cid", "leaf"), chunks).cast("int")
    other = F.explode(F.sequence(F.lit(0), chunks - 1))
    dealt = leaves.select("leaf", "cid", mine.alias("mine"), other.alias("other")).select(
        "leaf", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"), "mine", "cid"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, edges in whole_groups(batches, 3, 4_000):
            leaf, low, high, mine, cid, weight = (batch.column(k).to_numpy() for k in range(6))
            column = batch.column(7)
            starts, numbers = column.offsets.to_numpy(), column.values.to_numpy()
            unit = list(_unit(batch.column(6)))
            links, root = np.zeros(len(cid), np.int64), np.arange(len(cid))
            for at, x in unit:
                where = np.searchsorted(at, edges)
                for a, b in zip(where[:-1], where[1:]):
                    if b - a > 1:
                        _compare_group(at[a:b], x[a:b], leaf, low, high, mine, weight, starts, numbers, links, root, f.cosine)
            found = (links > 0) | (root != np.arange(len(cid)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cid[found]), pa.array(links[found]), pa.array(cid[root[found]])], names=["cid", "links", "near"]
            )

    rows = dealt.join(known, "cid").select("leaf", "low", "high", "mine", "cid", "weight", "vector", "leaves")
    sorted_rows = rows.repartition("leaf", "low", "high").sortWithinPartitions("leaf", "low", "high")
    return sorted_rows.mapInArrow(run, "cid long, links long, near long")


def _compare_group(rows, x, leaf, low, high, mine, weight, starts, numbers, links, root, cosine) -> None:
    """Compare the vectors of one leaf or of two of its blocks; adds to ``links`` and ``root``."""
    two_blocks = low[rows[0]] != high[rows[0]]
    one, two = (rows, rows) if not two_blocks else (rows[mine[rows] == low[rows]], rows[mine[rows] != low[rows]])
    if not len(one) or not len(two):
        return
    left, right = (x, x) if not two_blocks else (x[mine[rows] == low[rows]], x[mine[rows] != low[rows]])
    near = left @ right.T >= cosine
    if not two_blocks:
        near = np.triu(near, 1)
    some, others = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
    if not len(some):
        return
    one, two, near = one[some], two[others], near[np.ix_(some, others)]
    here = (near & ~_share_smaller(one, two, leaf[rows[0]], starts, numbers)).astype(np.float64)
    links[one] += (here @ weight[two]).astype(np.int64)
    links[two] += (weight[one] @ here).astype(np.int64)
    i, j = np.nonzero(near)
    i, j = one[i], two[j]
    # Within the group, every row takes the smallest row that it is connected with.
    while True:
        least = np.minimum(root[i], root[j])
        before = root[rows].copy()
        np.minimum.at(root, i, least)
        np.minimum.at(root, j, least)
        root[rows] = root[root[rows]]
        if (root[rows] == before).all():
            return


def near_vector_components(rows: DataFrame, id_column: str, vector_column: str, f: Forest = Forest()) -> DataFrame:
    """Per row ``vec_id, n_links, component_id, kept``.

    Vectors are linked if their cosine reaches ``f.cosine``; ``n_links`` counts the other rows linked directly.
    Vectors that are null, empty, zero or hold a null or non-finite value are linked with nothing, and so are
    vectors of different lengths. Equal vectors are one class with a weight and link with each other. Rows that
    repeat an id count as rows of their own. A null id stays null and is never the smallest of a component.
    Empty tables give empty results; other columns are not read.
    """
    scratch = Scratch(rows.sparkSession, "near-vectors")
    picked = rows.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"))
    parsed = scratch.write(_parsed(picked))
    usable = parsed.where("k1 is not null")
    # Equal vectors are one class; the class is known by its first key.
    counted = scratch.write(usable.groupBy("k1", "k2").agg(F.count("*").alias("weight"), F.min("vec_id").alias("rep")))
    vectors = scratch.write(
        usable.select("k1", "k2", "vec_id", "vector")
        .join(counted, ["k1", "k2"])
        .where(F.col("vec_id").eqNullSafe(F.col("rep")))
        .dropDuplicates(["k1", "k2"])
        .select(F.col("k1").alias("cid"), "weight", "rep", "vector")
    )
    leaves = _leaves(scratch, _projected(vectors, f), f)
    found = scratch.write(_compared(leaves, vectors, f))
    links = scratch.write(found.groupBy("cid").agg(F.sum("links").alias("links")))
    labels = components(scratch, found.select(F.col("cid").alias("a"), F.col("near").alias("b")))
    named = vectors.select(F.col("cid").alias("node"), "rep").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = scratch.write(named.groupBy("label").agg(F.min("rep").alias("component_id")))
    classes = scratch.write(
        named.join(smallest, "label")
        .select(F.col("node").alias("cid"), "component_id")
        .join(vectors.select("cid", "weight"), "cid")
        .join(links, "cid", "left")
        .select(F.col("cid").alias("k1"), "component_id", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    )
    out = parsed.select("vec_id", "k1").join(classes, "k1", "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("vec_id")).alias("kept"),
    )
