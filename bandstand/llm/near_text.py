"""Near-duplicate texts: a chosen-path join over sets of word shingles.

Every set is reduced to minwise values. Independent trees branch the sets by chosen values, two in each node. The first
levels, as many as the number of documents asks for, are walked where the text is read: a path is a hash of the
chosen values, and only paths that several sets share go on. A node with few sets is compared exhaustively
by sketches. In a large node all sets are compared with a pivot; sets
that are then known to be connected need no comparison with each other, and the few that stand apart are
compared with all. What passes the sketches is confirmed on the full sets. A node that is large to the end is
compared in blocks, so nothing is dropped for being frequent.

A pair at a threshold of 0.8 meets in the nodes of a tree, however deep, with a chance of 94 % at least (0.85:
97 %), so four trees miss it less than twice in 100,000. Equal sets are one class from the start.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bandstand.llm.components import components
from bandstand.llm.groups import fixed_rows, pairs_within, whole_groups
from bandstand.llm.ragged import mix, text_slices
from bandstand.llm.shingles import minwise, set_keys, shingle_sets
from bandstand.runtime import Scratch

SKETCH = 256
SHORT = 32  # first places of the sketch, compared before the whole
CHILDREN = 2


@dataclass(frozen=True)
class NearText:
    """Shingle length in words, likeness in per cent, trees, sets in a small node, sets that may stand apart in a
    large node before it is branched, levels, shingles of a block."""

    words: int = 5
    percent: int = 80
    trees: int = 4
    small: int = 48
    few: int = 4096
    levels: int = 6
    block: int = 400_000

    def least_equal(self, places: int) -> int:
        """Equal places of a sketch that a pair must have: four standard deviations below the threshold."""
        p = self.percent / 100
        return int(places * p - 4 * (places * p * (1 - p)) ** 0.5)


def _depth(documents: int) -> int:
    """Levels after which texts that share a thousandth of their shingles by chance seldom share a node."""
    depth = 1
    while 1000**depth < documents:
        depth += 1
    return depth


def _paths(values: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """Nodes of each set after ``depth`` levels of all trees; every node branches by values of its own."""
    column = iter(values.T)
    out = []
    for tree in range(trees):
        nodes = [np.full(len(values), tree, np.uint64)]
        for _ in range(depth):
            nodes = [mix(node ^ next(column)) for node in nodes for _ in range(CHILDREN)]
        out += nodes
    return np.ascontiguousarray(np.stack(out, 1)).astype(np.int64)


def _sketches(docs: DataFrame, depth: int, p: NearText) -> DataFrame:
    """Per row: set size, set keys, nodes after the first levels and a byte sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roots = p.trees * CHILDREN**depth
        chosen = p.trees * sum(CHILDREN**k for k in range(1, depth + 1))
        for batch in batches:
            for lo, hi, data, offsets in text_slices(batch.column(1)):
                shingles, counts = shingle_sets(data, offsets, p.words)
                values = minwise(shingles, counts, SKETCH + chosen)
                nodes = _paths(values[:, SKETCH:], p.trees, depth)
                sketch = np.ascontiguousarray(values[:, :SKETCH].astype(np.uint8))
                one, two = set_keys(shingles, counts)
                columns = [
                    batch.column(0).slice(lo, hi - lo),
                    pa.array(counts.astype(np.int64)),
                    pa.array(one),
                    pa.array(two),
                    pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1, dtype=np.int32) * roots), pa.array(nodes.ravel())),
                    pa.FixedSizeBinaryArray.from_buffers(pa.binary(SKETCH), hi - lo, [None, pa.py_buffer(sketch)]).cast(pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_shingles", "k1", "k2", "nodes", "sketch"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, k1 long, k2 long, nodes array<long>, sketch binary")


_CANDIDATES = "a long, b long, best boolean"


def _candidates(one: np.ndarray, two: np.ndarray, best: np.ndarray) -> pa.RecordBatch:
    low, high = np.minimum(one, two), np.maximum(one, two)
    return pa.RecordBatch.from_arrays([pa.array(low), pa.array(high), pa.array(best)], names=["a", "b", "best"])


def _alike(ids, sizes, sketch, i, j, p: NearText) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the row pairs those that may reach the threshold, with their equal places."""
    ok = (100 * np.minimum(sizes[i], sizes[j]) >= p.percent * np.maximum(sizes[i], sizes[j])) & (ids[i] != ids[j])
    i, j = i[ok], j[ok]
    equal = (sketch[i] == sketch[j]).sum(1)
    ok = equal >= p.least_equal(sketch.shape[1])
    return i[ok], j[ok], equal[ok]


def _compare_small(rows: DataFrame, p: NearText) -> DataFrame:
    """All pairs within small nodes; ``best`` marks a pair that is the likeliest of one of its ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, edges in whole_groups(batches, 1):
            ids, sizes = (batch.column(k).to_numpy() for k in (1, 2))
            sketch = fixed_rows(batch.column(3), SHORT)
            found = [_alike(ids, sizes, sketch, i, j, p) for i, j in pairs_within(edges)]
            if not found:
                continue
            i, j, equal = (np.concatenate(x) for x in zip(*found))
            most = np.zeros(len(ids), np.int64)
            np.maximum.at(most, i, equal)
            np.maximum.at(most, j, equal)
            yield _candidates(ids[i], ids[j], (equal == most[i]) | (equal == most[j]))

    sorted_rows = rows.select("node", "rep", "n_shingles", "short").repartition("node").sortWithinPartitions("node")
    return sorted_rows.mapInArrow(run, _CANDIDATES)


def _compare_pivot(rows: DataFrame, p: NearText) -> DataFrame:
    """Pairs of a row and its node's pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, other, other_sizes = (batch.column(k).to_numpy() for k in (0, 1, 3, 4))
            n = len(ids)
            sketch = np.concatenate([fixed_rows(batch.column(k), SHORT) for k in (2, 5)])
            both, both_sizes = np.concatenate([ids, other]), np.concatenate([sizes, other_sizes])
            i, j, _ = _alike(both, both_sizes, sketch, np.arange(n), np.arange(n) + n, p)
            yield _candidates(both[i], both[j], np.ones(len(i), bool))

    return rows.select("rep", "n_shingles", "short", "pivot", "pivot_shingles", "pivot_short").mapInArrow(run, _CANDIDATES)


def _by_whole_sketch(pairs: DataFrame, known: DataFrame, p: NearText) -> DataFrame:
    """The pairs that also pass by their whole sketches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = (fixed_rows(batch.column(k), SKETCH) for k in (3, 4))
            passes = (one == two).sum(1) >= p.least_equal(SKETCH)
            yield batch.select([0, 1, 2]).filter(pa.array(passes))

    ends = [known.select(F.col("rep").alias(end), F.col("sketch").alias(f"of_{end}")).hint("merge") for end in "ab"]
    return pairs.join(ends[0], "a").join(ends[1], "b").select("a", "b", "best", "of_a", "of_b").mapInArrow(run, _CANDIDATES)


def _link_apart(rows: DataFrame, texts: DataFrame, p: NearText) -> DataFrame:
    """Links of the rows that stand apart from their node's main label, with any row of another label, in blocks.

    ``rows``: node, rep, n_shingles, sketch, label, main, whole (shingles of the node), apart (those of the rows that
    stand apart). Each block of asking rows meets each block of all rows once, with their texts. What passes the
    sketches is confirmed at once, the likeliest first; one link to a label is enough.
    """
    shares, parts = (F.greatest(F.lit(1), F.ceil(F.col(c) / p.block).cast("int")) for c in ("whole", "apart"))
    columns = ["node", "share", "part", "asks", "rep", "n_shingles", "sketch", "label", "text"]
    met = rows.join(texts.withColumnRenamed("id", "rep"), "rep")
    asked = met.withColumns({"share": F.pmod(F.xxhash64("rep", "node"), shares), "asks": F.lit(False)}).withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    asking = met.where("label <> main").withColumns({"part": F.pmod(F.xxhash64("rep", F.lit(1)), parts), "asks": F.lit(True)}).withColumn("share", F.explode(F.sequence(F.lit(0), shares - 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, edges in whole_groups(batches, 3, 1):
            asks, ids, sizes, label = (batch.column(k).to_numpy(zero_copy_only=False) for k in (3, 4, 5, 7))
            sketch = fixed_rows(batch.column(6), SKETCH)
            one: list[int] = []
            two: list[int] = []
            for lo, hi in zip(edges[:-1], edges[1:]):
                sets = _Sets(batch.column(8), lo, hi, p.words)
                asked_here = lo + np.flatnonzero(~asks[lo:hi])
                for row in (lo + np.flatnonzero(asks[lo:hi])).tolist():
                    others = asked_here[label[asked_here] != label[row]]
                    _, j, equal = _alike(ids, sizes, sketch, np.full(len(others), row), others, p)
                    met_labels: set[int] = set()
                    for other in j[np.argsort(-equal, kind="stable")].tolist():
                        if label[other] not in met_labels and _reaches(sets[row], sets[other], p.percent):
                            met_labels.add(label[other])
                            one.append(ids[row])
                            two.append(ids[other])
            yield pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(two, pa.int64())], names=["a", "b"])

    dealt = asked.select(*columns).unionByName(asking.select(*columns))
    sorted_rows = dealt.repartition("node", "share", "part").sortWithinPartitions("node", "share", "part")
    return sorted_rows.mapInArrow(run, "a long, b long")


class _Sets:
    """Shingle sets of the rows of a group, made when first asked for."""

    def __init__(self, texts: pa.Array, lo: int, hi: int, words: int):
        self._texts, self._lo, self._hi, self._words, self._made = texts, lo, hi, words, {}

    def __getitem__(self, row: int) -> np.ndarray:
        if not self._made:
            for lo, hi, data, offsets in text_slices(self._texts.slice(self._lo, self._hi - self._lo)):
                shingles, counts = shingle_sets(data, offsets, self._words)
                for k, part in enumerate(np.split(shingles, np.cumsum(counts)[:-1])):
                    self._made[self._lo + lo + k] = part
        return self._made[row]


def _confirmed(scratch: Scratch, pairs: DataFrame, texts: DataFrame, p: NearText) -> DataFrame:
    """The pairs whose full sets reach the threshold.

    The end of a pair that has more pairs is its hub. The pairs of a hub are dealt into groups of some 64;
    each group gets the hub's text once and the text of each other end.
    """
    ends = scratch.write(pairs.select(F.explode(F.array("a", "b")).alias("end")).groupBy("end").agg(F.count("*").alias("pairs")))
    of_a = ends.select(F.col("end").alias("a"), F.col("pairs").alias("of_a"))
    of_b = ends.select(F.col("end").alias("b"), F.col("pairs").alias("of_b"))
    a_leads = F.col("of_a") >= F.col("of_b")
    hub, other = F.when(a_leads, F.col("a")).otherwise(F.col("b")), F.when(a_leads, F.col("b")).otherwise(F.col("a"))
    share = F.pmod(F.xxhash64(other), F.ceil(F.greatest("of_a", "of_b") / 64))
    dealt = scratch.write(pairs.join(of_a, "a").join(of_b, "b").select(hub.alias("hub"), other.alias("id"), share.alias("share")))
    hubs = dealt.select("hub", "share", F.col("hub").alias("id"), F.lit(0).alias("kind")).distinct()
    wanted = hubs.unionByName(dealt.select("hub", "share", "id", F.lit(1).alias("kind")))
    with_text = wanted.join(texts, "id").select("hub", "share", "kind", "id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sets = None, []
        for batch in batches:
            key = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            kind, ids = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            hub, other = [], []
            for lo, hi, data, offsets in text_slices(batch.column(4)):
                shingles, counts = shingle_sets(data, offsets, p.words)
                end = np.cumsum(counts)
                for row in range(lo, hi):
                    here = shingles[end[row - lo] - counts[row - lo] : end[row - lo]]
                    if key[row] != now:
                        now, sets = key[row], []
                    if kind[row] == 0:
                        sets.append(here)
                    elif any(_reaches(here, there, p.percent) for there in sets):
                        hub.append(now[0])
                        other.append(ids[row])
            yield pa.RecordBatch.from_arrays([pa.array(hub, pa.int64()), pa.array(other, pa.int64())], names=["a", "b"])

    sorted_rows = with_text.repartition("hub", "share").sortWithinPartitions("hub", "share", "kind")
    return sorted_rows.mapInArrow(run, "a long, b long")


def _reaches(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    if len(one) > len(two):
        one, two = two, one
    if not len(one):
        return False
    place = np.searchsorted(two, one)
    common = int((two[np.minimum(place, len(two) - 1)] == one).sum())
    return 100 * common >= percent * (len(one) + len(two) - common)


def _labelled(rows: DataFrame, labels: DataFrame, by: str) -> DataFrame:
    named = labels.select(F.col("node").alias(by), F.col("label").alias("_label"))
    return rows.join(named, by, "left").withColumn("label", F.coalesce("_label", by)).drop("_label")


class _Join:
    """The state of one join: texts to confirm on and the components found so far."""

    def __init__(self, spark: SparkSession, docs: DataFrame, p: NearText):
        self.docs, self.p = docs, p
        self.scratch = Scratch(spark, "near-text")
        self.labels = spark.createDataFrame([], "node long, label long")
        self.known: DataFrame | None = None
        self.texts: DataFrame | None = None
        self.ids_repeat = False

    def join_links(self, found: DataFrame) -> None:
        """Join the components that confirmed links connect."""
        if found.isEmpty():
            return
        before = self.labels
        # Earlier components count as stars, so each round works on new links and one row per node.
        self.labels = components(self.scratch, found.union(before.select(F.col("node").alias("a"), F.col("label").alias("b"))))
        self.scratch.drop(before)

    def confirmed(self, pairs: DataFrame, texts: DataFrame) -> DataFrame:
        return self.scratch.write(_confirmed(self.scratch, pairs, texts, self.p))

    def take(self, candidates: DataFrame) -> DataFrame:
        """Confirm the likeliest pairs and join their components; of the others return the links between different ones."""
        distinct = candidates.groupBy("a", "b").agg(F.max("best").alias("best"))
        pairs = self.scratch.write(_by_whole_sketch(distinct, self.known, self.p))
        # The likeliest pairs ask for most of the texts, what is left of the others for few.
        self.join_links(self.confirmed(pairs.where("best"), self.texts.hint("merge")))
        rest = _labelled(_labelled(pairs.where("not best"), self.labels, "a").withColumnRenamed("label", "label_a"), self.labels, "b")
        rest = self.scratch.write(rest.where("label_a <> label").select("a", "b"))
        links = rest if rest.isEmpty() else self.confirmed(rest, self.texts)
        self.scratch.drop(pairs)
        return links


def near_text_components(docs: DataFrame, id_column: str, text_column: str, p: NearText = NearText()) -> DataFrame:
    """Per row ``doc_id, n_shingles, component_id, kept``.

    Texts are linked if their sets of shingles reach the threshold; ``component_id`` is the smallest id that
    links reach, and ``kept`` tells whether it is the row's own. A null or wordless text has an empty set and is
    linked with nothing. A null id stays null, is linked with nothing and kept. Rows that repeat an id are one
    document: its links are those of any of its texts. Empty tables give empty results; other columns are not read.
    """
    spark = docs.sparkSession
    picked = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    join = _Join(spark, picked, p)
    scratch = join.scratch
    sketches = scratch.write(_sketches(picked, _depth(docs.count()), p))
    rows = sketches.select("doc_id", "n_shingles", "k1", "k2")
    filled = rows.where("n_shingles > 0 and doc_id is not null")
    repeated = filled.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    join.ids_repeat = not repeated.isEmpty()
    classes = scratch.write(filled.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep")))
    first = classes.select("k1", "k2", F.col("rep").alias("doc_id"))
    same = ["k1", "k2", "doc_id"]
    of_class = sketches.where("n_shingles > 0").join(first.hint("merge"), same)
    reps = scratch.write((of_class.dropDuplicates(same) if join.ids_repeat else of_class).withColumnRenamed("doc_id", "rep"))
    _search(join, reps)
    labels = _with_repeated_ids(scratch, filled, classes, join.labels) if join.ids_repeat else join.labels
    with_class = rows.join(classes.withColumnRenamed("rep", "_rep"), ["k1", "k2"], "left")
    rep = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("_rep"))
    out = _labelled(with_class.withColumn("rep", rep), labels, "rep")
    component = F.coalesce("label", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"))


def _with_repeated_ids(scratch: Scratch, filled: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """An id that stands at several different texts joins the classes of all of them."""
    named = scratch.write(filled.join(classes, ["k1", "k2"]).select("doc_id", "rep"))
    spans = named.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b")
    several = scratch.write(spans.select("doc_id", "a"))
    more = named.join(several, "doc_id").select("a", F.col("rep").alias("b"))
    return components(scratch, more.union(labels.select(F.col("node").alias("a"), F.col("label").alias("b"))))


def _sizes(scratch: Scratch, rows: DataFrame) -> DataFrame:
    """Nodes with more than one set, their size and a pivot that differs from node to node."""
    pivot = F.min_by("rep", F.xxhash64("rep", "node"))
    return scratch.write(rows.groupBy("node").agg(F.count("*").alias("n"), pivot.alias("pivot")).where("n > 1"))


def _search(join: _Join, reps: DataFrame) -> None:
    """Find and confirm the links between classes, level by level."""
    p, scratch = join.p, join.scratch
    join.known = known = reps.select("rep", "n_shingles", "sketch")
    short = known.select("rep", "n_shingles", F.substring("sketch", 1, SHORT).alias("short"))
    rows = reps.select("rep", F.explode("nodes").alias("node"))
    for level in range(p.levels):
        sizes = _sizes(scratch, rows)
        if sizes.isEmpty():
            return
        met = scratch.write(rows.join(sizes.hint("merge"), "node"))
        if join.texts is None:
            join.texts = _texts(join, met)
        with_short = met.join(short.hint("merge"), "rep")
        pivots = short.select(F.col("rep").alias("pivot"), F.col("n_shingles").alias("pivot_shingles"), F.col("short").alias("pivot_short"))
        centres = scratch.write(sizes.where(F.col("n") > p.small).select("node", "pivot").join(pivots, "pivot"))
        found = _compare_small(with_short.where(F.col("n") <= p.small), p)
        only_small = centres.isEmpty()
        if not only_small:
            found = found.union(_compare_pivot(with_short.where(F.col("n") > p.small).drop("pivot").join(centres, "node"), p))
        links = join.take(found)
        if only_small:
            join.join_links(links)
            return
        rows = _large(join, met.where(F.col("n") > p.small).select("node", "rep"), links, level)
        if rows is None:
            return


def _large(join: _Join, rows: DataFrame, links: DataFrame, level: int) -> DataFrame | None:
    """Link what stands apart in large nodes, or branch them; returns the rows of the next level.

    ``links`` are confirmed links that the labels do not show yet; they are joined with what is found here.
    """
    p, scratch = join.p, join.scratch
    rows = scratch.write(_labelled(rows.join(join.known.select("rep", "n_shingles"), "rep"), join.labels, "rep"))
    counts = rows.groupBy("node", "label").agg(F.count("*").alias("c"), F.sum("n_shingles").alias("s"))
    nodes = counts.groupBy("node").agg(
        F.sum("c").alias("n"), F.max("c").alias("most"), F.max_by("label", "c").alias("main"), F.sum("s").alias("whole"), F.max_by("s", "c").alias("main_s")
    )
    nodes = nodes.select("node", "main", "whole", (F.col("whole") - F.col("main_s")).alias("apart"), (F.col("n") - F.col("most")).alias("others"))
    nodes = scratch.write(nodes.where("others > 0"))
    last = level + 1 == p.levels
    now = nodes if last else nodes.where(F.col("others") <= p.few)
    if not now.isEmpty():
        links = links.union(scratch.write(_link_apart(rows.join(now, "node").join(join.known.select("rep", "sketch"), "rep"), join.texts, p)))
    later = nodes.where(F.col("others") > p.few)
    join.join_links(links)
    if last or later.isEmpty():
        return None
    return scratch.write(_children(rows.join(later, "node").join(join.known.select("rep", "sketch"), "rep"), p))


def _children(rows: DataFrame, p: NearText) -> DataFrame:
    def child(k: int) -> Column:
        place = F.pmod(F.xxhash64("node", F.lit(k)), F.lit(SKETCH)).cast("int")
        return F.xxhash64("node", F.lit(k), F.substr("sketch", place + 1, F.lit(1)))

    return rows.select("rep", F.explode(F.array(*[child(k) for k in range(CHILDREN)])).alias("node"))


def _texts(join: _Join, met: DataFrame) -> DataFrame:
    """Texts of all classes that share a node with another one; they are confirmed from these."""
    ids = met.select(F.col("rep").alias("doc_id")).distinct()
    kept = join.docs.join(ids.hint("merge"), "doc_id", "left_semi").select(F.col("doc_id").alias("id"), "text")
    return join.scratch.write(kept.dropDuplicates(["id", "text"]) if join.ids_repeat else kept)
