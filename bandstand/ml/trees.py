"""Boosted trees on binned features; all models of a run grow side by side.

A round adds one tree to every model, level by level, and a level is one job whatever the number of models: each
task adds up gradients and curvatures per model, node, feature and bin of its rows, and the driver picks the splits
from the sums of the tasks (beyond some tasks Spark adds them in a tree first): models x nodes x features x bins of
them, never a row. Each round's first job also stores the blocks with the margins and the draw of the round, which its
other jobs read; every few rounds they are checkpointed.

The blocks of rows are an RDD of numpy arrays: some 1,200 short jobs that add arrays. Written with ``mapInArrow`` and
``groupBy`` the same job took 0.2 s on 752 rows, nearly all of it planning and conversion.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import partial, reduce
from itertools import islice

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from bandstand.runtime import Scratch, ensure_checkpoints

# Rows of a task: up to the first number for each core, no more than the second beyond that.
LEAST_ROWS, ROWS_PER_TASK = 5_000, 250_000
ROWS_PER_BLOCK = 25_000
ROUNDS_PER_STORE = 10
# Tasks whose sums the driver adds itself: a job of one stage takes half the time of one that adds in a tree.
SUMS_AT_ONCE = 48
# Penalty on a leaf's value and least curvature of a leaf (the usual defaults of second-order boosting).
PENALTY, LEAST_CURVATURE = 1.0, 1.0
LEAST_GAIN = 1e-9


@dataclass(frozen=True)
class BoostParams:
    """The documented full setting; pass fewer rounds for a quick run."""

    rounds: int = 300
    depth: int = 4
    rate: float = 0.05
    row_share: float = 0.8
    column_share: float = 0.8
    seed: int = 42
    bins: int = 64


@dataclass(frozen=True, eq=False)
class BoostedTrees:
    """Arrays ``[tree, node]``. The children of node ``i`` are ``2i + 1`` (at most the threshold) and ``2i + 2``;
    feature -1 is a leaf. ``cover`` is the curvature of the training rows that reached the node."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    cover: np.ndarray

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Sum of the leaves that each row reaches: the log odds."""
        flat, first = np.ascontiguousarray(x, dtype=float).ravel(), np.arange(len(x)) * x.shape[1]
        value, depth = _values_below(self.feature, self.value), _depth(self.feature.shape[1])
        feature, threshold = np.maximum(self.feature, 0), np.where(self.feature < 0, np.inf, self.threshold)
        out = np.zeros(len(x))
        for f, t, v in zip(feature, threshold, value):
            at = np.zeros(len(x), dtype=np.intp)
            for _ in range(depth):
                right = flat.take(first + f.take(at)) > t.take(at)
                at *= 2
                at += 1
                at += right
            out += v.take(at)
        return out

    def save(self, spark: SparkSession, path: str) -> None:
        """One row per node; rounds x 2^(depth + 1) rows bound the table."""
        tree, node = np.indices(self.feature.shape)
        columns = {"tree": tree, "node": node, "feature": self.feature, "threshold": self.threshold, "value": self.value, "cover": self.cover}
        rows = pd.DataFrame({k: v.ravel() for k, v in columns.items()})
        ddl = "tree INT, node INT, feature INT, threshold DOUBLE, value DOUBLE, cover DOUBLE"
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "BoostedTrees":
        rows = spark.read.parquet(path).toPandas().sort_values(["tree", "node"])
        shape = (rows["tree"].nunique(), rows["node"].nunique())
        return BoostedTrees(*[rows[c].to_numpy().reshape(shape) for c in ("feature", "threshold", "value", "cover")])


def with_margins(df: DataFrame, models: list[BoostedTrees], name: str) -> DataFrame:
    """Add the margin of every model as an array: one pass over ``features`` for all of them."""
    shipped = df.sparkSession.sparkContext.broadcast(models)

    @F.pandas_udf("array<double>")
    def walk(features: pd.Series) -> pd.Series:
        if features.empty:
            return pd.Series([], dtype=object)
        x = np.stack(features.to_numpy())
        return pd.Series(list(np.column_stack([m.margins(x) for m in shipped.value])))

    return df.withColumn(name, walk(vector_to_array("features")))


@dataclass(frozen=True)
class _Run:
    """What stays the same over a fit: model ``m`` leaves out the rows of fold ``excluded[m]`` (-1: none); sums are counted in ``unit``."""

    params: BoostParams
    cuts: list[np.ndarray]
    excluded: np.ndarray
    weights: np.ndarray
    unit: float = 2.0**-24

    @property
    def models(self) -> int:
        return len(self.excluded)

    @property
    def nodes(self) -> int:
        return 2 ** (self.params.depth + 1) - 1


@dataclass
class _Round:
    """One tree per model, arrays ``[model, node]``; ``cut`` is the last bin that goes left."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    cover: np.ndarray = field(repr=False)

    @staticmethod
    def start(run: _Run) -> "_Round":
        shape = (run.models, run.nodes)
        return _Round(np.full(shape, -1), np.zeros(shape, dtype=np.int64), np.zeros(shape), np.zeros(shape))

    def reach(self, m: int, bins: np.ndarray, rows: np.ndarray, levels: int) -> np.ndarray:
        """The node of each of the ``rows`` in the tree of model ``m`` after ``levels`` splits. Below a leaf, rows go left."""
        flat, width = bins.ravel(), bins.shape[1]
        place = np.maximum(self.feature[m], 0) * width
        cut = np.where(self.feature[m] < 0, 255, self.cut[m]).astype(np.uint8)
        at = np.zeros(len(rows), dtype=np.intp)
        for _ in range(levels):
            right = flat.take(place.take(at) + rows) > cut.take(at)
            at *= 2
            at += 1
            at += right
        return at


def fit_together(
    rows: DataFrame, label: str, excluded: list[int | None], params: BoostParams, key: str | None = None
) -> list[BoostedTrees]:
    """Fit one model per entry of ``excluded`` on ``features`` and ``label`` (1: positive).

    A model leaves out the rows whose ``fold`` is its entry; None takes all. Positives weigh n_neg / n_pos of the
    model's own rows. Rows are drawn per round by the hash of ``key`` (of features and label without one), so that a
    task that runs again draws the same ones. Rows without a label count as negative; a table without rows is an error.
    """
    if not 2 <= params.bins <= 256:
        raise ValueError("bins must be 2 to 256: a bin is stored in one byte")
    ensure_checkpoints(rows.sparkSession)
    scratch = Scratch(rows.sparkSession, "boosting")
    fold = F.col("fold").cast("int") if "fold" in rows.columns else F.lit(-1)
    draw = F.xxhash64(key) if key else F.xxhash64("features", label)
    x = vector_to_array("features").alias("x")
    wide = scratch.write(rows.select(x, F.coalesce(F.col(label) == 1, F.lit(False)).cast("int").alias("positive"), fold.alias("fold"), draw.alias("draw")))
    counts = wide.groupBy("fold").agg(F.count("*").alias("n"), F.sum("positive").alias("pos"), F.max(F.size("x")).alias("width")).collect()
    if not counts:
        raise ValueError("no rows to fit")
    weights, n = _weights(counts, excluded), sum(r["n"] for r in counts)
    run = _Run(params, _cuts(wide, counts[0]["width"], params.bins), np.array([-1 if e is None else e for e in excluded]), weights, _unit(n, weights))
    tasks = tasks_for(n, rows.sparkSession.sparkContext.defaultParallelism)
    held = wide.repartition(tasks).rdd.mapPartitions(partial(_blocks, run))
    grown: list[_Round] = []
    before = None
    for number in range(params.rounds):
        held = held.map(partial(_next_round, run, grown[-1] if grown else None, number)).persist(StorageLevel.MEMORY_AND_DISK)
        if number % ROUNDS_PER_STORE == 0:
            held.checkpoint()
        grown.append(_grow(held, tasks, run, number))
        if before is not None:
            before.unpersist()
        before = held
    if before is not None:
        before.unpersist()
    scratch.drop(wide)
    return [_model(run, grown, m) for m in range(run.models)]


def tasks_for(n: int, cores: int) -> int:
    """Tasks of ``n`` rows: every core takes part, unless rows are few; none has too many rows."""
    return max(-(-n // ROWS_PER_TASK), min(cores, -(-n // LEAST_ROWS)))


def _cuts(wide: DataFrame, width: int, bins: int) -> list[np.ndarray]:
    """Values between the bins of each feature, at about equal shares of the rows."""
    shares = [i / bins for i in range(1, bins)]
    found = wide.agg(*[F.percentile_approx(F.col("x")[i], shares, 10_000).alias(f"c{i}") for i in range(width)]).first()
    return [np.unique(np.array(c or [], dtype=float)) for c in found]


def _weights(counts: list, excluded: list[int | None]) -> np.ndarray:
    out = []
    for e in excluded:
        own = [r for r in counts if r["fold"] != e]
        pos = sum(r["pos"] for r in own)
        out.append((sum(r["n"] for r in own) - pos) / pos if pos else 1.0)
    return np.array([w or 1.0 for w in out])


def _unit(n: int, weights: np.ndarray) -> float:
    """A power of two that all sums over ``n`` rows are less than 2^51 times of, so that doubles hold them exactly."""
    return 2.0 ** (np.ceil(np.log2(max(n, 1) * max(1.0, weights.max()))) - 51)


@dataclass(frozen=True)
class _Block:
    """Rows of a task: ``bins`` [feature, row], columns ``positive, fold, draw`` [row], and at the start of a round
    ``margins`` and the rows drawn, ``part`` [model, row]."""

    bins: np.ndarray
    positive: np.ndarray
    fold: np.ndarray
    draw: np.ndarray
    margins: np.ndarray
    part: np.ndarray | None = None


def _blocks(run: _Run, rows):
    rows = iter(rows)
    while some := list(islice(rows, ROWS_PER_BLOCK)):
        x = np.array([r["x"] for r in some])
        bins = np.stack([np.searchsorted(c, x[:, i], "left") for i, c in enumerate(run.cuts)]).astype(np.uint8)
        positive, fold, draw = (np.array([r[c] for r in some]) for c in ("positive", "fold", "draw"))
        yield _Block(bins, positive.astype(np.uint8), fold, draw, np.zeros((run.models, len(some))))


def _next_round(run: _Run, last: _Round | None, number: int, block: _Block) -> _Block:
    """The block at the start of a round: the last round's trees are added, the rows of each model drawn."""
    margins = block.margins
    if last is not None:
        rows, values = np.arange(len(block.draw)), _values_below(last.feature, last.value)
        margins = np.stack([margins[m] + values[m].take(last.reach(m, block.bins, rows, run.params.depth)) for m in range(run.models)])
    part = np.stack([_drawn(run, block.draw, number, m) for m in range(run.models)])
    part &= (block.fold != run.excluded[:, None]) | (run.excluded < 0)[:, None]
    return replace(block, margins=margins, part=part)


def _drawn(run: _Run, draw: np.ndarray, number: int, m: int) -> np.ndarray:
    """Whether a row takes part in the round of a model: a share of mixed hashes."""
    turn = np.uint64(run.params.seed * 1_000_003 + number * run.models + m + 1)
    with np.errstate(over="ignore"):
        z = draw.astype(np.uint64) + turn * np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z ^= z >> np.uint64(shift)
        z *= np.uint64(factor)
    z ^= z >> np.uint64(31)
    return (z >> np.uint64(11)) / 2.0**53 < run.params.row_share


def _sum_level(run: _Run, trees: _Round, level: int, lighter: np.ndarray, barred: np.ndarray, blocks):
    """Per model, node of the level, feature and bin: the sums of gradients and curvatures of a task's rows, in units.
    Only nodes that are marked in ``lighter`` [model, node of the level] are summed, and no features ``barred`` [model, feature]."""
    width, bins, nodes = len(run.cuts), run.params.bins, 2**level
    sums = np.zeros((2, run.models, width, nodes * bins))
    for block in blocks:
        for m in range(run.models):
            own = np.flatnonzero(block.part[m])
            at = trees.reach(m, block.bins, own, level) - (nodes - 1)
            if not lighter[m].all():
                some = np.flatnonzero(lighter[m].take(at))
                own, at = own.take(some), at.take(some)
            p = 1 / (1 + np.exp(-block.margins[m].take(own)))
            positive = block.positive.take(own)
            weight = np.where(positive == 1, run.weights[m], 1.0) / run.unit
            slope, curve = np.rint(weight * (p - positive)), np.rint(weight * p * (1 - p))
            at *= bins
            for f in np.flatnonzero(~barred[m]):
                where = at + block.bins[f].take(own)
                sums[0, m, f] += np.bincount(where, slope, nodes * bins)
                sums[1, m, f] += np.bincount(where, curve, nodes * bins)
    yield sums.reshape(2, run.models, width, nodes, bins).swapaxes(2, 3)


def _lighter(trees: _Round, level: int) -> np.ndarray:
    """For each model and node of a level whether it is the child of less curvature; both children of a leaf are none."""
    first = 2**level - 1
    if not level:
        return np.ones((len(trees.feature), 1), dtype=bool)
    left, right = (trees.cover[:, first + side : 2 * first + 1 : 2] for side in (0, 1))
    split = trees.feature[:, first // 2 : first] >= 0
    return np.stack([split & (left <= right), split & (left > right)], axis=-1).reshape(len(split), -1)


def _with_rest(sums: np.ndarray, above: np.ndarray, trees: _Round, level: int, lighter: np.ndarray) -> np.ndarray:
    """The sums of a level with those of the heavier children: what the lighter ones leave of their parents."""
    first = 2**level - 1
    split = (trees.feature[:, first // 2 : first] >= 0)[:, :, None, None]
    out = sums.copy()
    for side in (0, 1):
        own = lighter[:, side::2][:, :, None, None]
        out[:, :, side::2] = np.where(own | ~split, sums[:, :, side::2], above - sums[:, :, 1 - side :: 2])
    return out


def _grow(held: RDD, tasks: int, run: _Run, number: int) -> _Round:
    """The next tree of every model: one job per level."""
    trees, p = _Round.start(run), run.params
    width, keep = len(run.cuts), max(1, round(p.column_share * len(run.cuts)))
    barred = np.ones((run.models, width), dtype=bool)
    for m in range(run.models):
        barred[m, np.random.default_rng([p.seed, number, m]).permutation(width)[:keep]] = False
    above = None
    for level in range(p.depth):
        lighter = _lighter(trees, level)
        parts = held.mapPartitions(partial(_sum_level, run, trees, level, lighter, barred))
        sums = parts.treeReduce(np.add) if tasks > SUMS_AT_ONCE else reduce(np.add, parts.collect())
        above = sums if above is None else _with_rest(sums, above, trees, level, lighter)
        if not _split_level(trees, above * run.unit, barred, level, p.rate):
            break
    return trees


def _leaf(g, h, rate: float):
    return -rate * g / (h + PENALTY)


def _split_level(trees: _Round, sums: np.ndarray, barred: np.ndarray, level: int, rate: float) -> bool:
    """Give each node of the level its best split; False when no node has one."""
    left = sums.cumsum(axis=-1)
    whole = left[..., -1:]
    right = whole - left
    score = [g * g / (h + PENALTY) for g, h in (left, right, whole)]
    gain = score[0] + score[1] - score[2]
    gain[(left[1] < LEAST_CURVATURE) | (right[1] < LEAST_CURVATURE) | barred[:, None, :, None]] = -np.inf
    if level:  # nodes below a leaf are none
        parents = trees.feature[:, 2 ** (level - 1) - 1 : 2**level - 1]
        gain[np.repeat(parents < 0, 2, axis=1)] = -np.inf
    models, nodes, _, bins = gain.shape
    best = gain.reshape(models, nodes, -1).argmax(axis=-1)
    first, any_split = 2**level - 1, False
    for m in range(models):
        for i in range(nodes):
            f, b = divmod(int(best[m, i]), bins)
            node = first + i
            if level == 0:
                trees.value[m, 0], trees.cover[m, 0] = _leaf(*whole[:, m, i, f, 0], rate), whole[1, m, i, f, 0]
            if not gain[m, i, f, b] > LEAST_GAIN:
                continue
            any_split = True
            trees.feature[m, node], trees.cut[m, node] = f, b
            for child, side in ((2 * node + 1, left), (2 * node + 2, right)):
                trees.value[m, child], trees.cover[m, child] = _leaf(*side[:, m, i, f, b], rate), side[1, m, i, f, b]
    return any_split


def _model(run: _Run, grown: list[_Round], m: int) -> BoostedTrees:
    def stacked(name: str) -> np.ndarray:
        return np.stack([getattr(t, name)[m] for t in grown])

    feature, cut = stacked("feature"), stacked("cut")
    threshold = np.full(feature.shape, np.nan)
    for t, n in zip(*np.nonzero(feature >= 0)):
        threshold[t, n] = run.cuts[feature[t, n]][cut[t, n]]
    return BoostedTrees(feature, threshold, stacked("value"), stacked("cover"))


def _values_below(feature: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Values ``[tree, node]`` where all nodes below a leaf have that of the leaf."""
    out, leaf = value.copy(), feature < 0
    for node in range(feature.shape[1] // 2):
        for child in (2 * node + 1, 2 * node + 2):
            out[leaf[:, node], child] = out[leaf[:, node], node]
    return out


def _depth(nodes: int) -> int:
    return (nodes + 1).bit_length() - 2
