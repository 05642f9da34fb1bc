"""Frequent lines, found with levelled sorted runs of line keys, and their removal. DataFrame functions only.

Documents come in batches. Each batch is reduced to its keys and the number of its documents that hold them;
keys that the runs have already settled (found often enough) are anti-joined away, and the rest becomes a
sorted run of the lowest level. When a level has ``fan`` runs they are merged into one run of the next level;
keys that reach the limit move to the settled run. After the last batch all levels are merged.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bandstand.runtime import Scratch

# The contract's white space and letters: fixed values.
WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class LineRules:
    """Documents that make a key frequent, code points of the shortest key, batches, runs of a level."""

    min_docs: int = 10
    min_chars: int = 1
    batches: int = 4
    fan: int = 2


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _key(line: Column, rules: LineRules) -> Column:
    """128-bit key of a line that is already lower-cased; null if it is too short to be dropped."""
    stripped = F.trim(line, F.lit(WHITE))
    return F.when(F.char_length(stripped) >= max(1, rules.min_chars), F.md5(stripped))


def _lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


class LineRuns:
    """The levelled runs: ``key, n`` with n the number of documents seen so far."""

    def __init__(self, spark: SparkSession, rules: LineRules):
        self._scratch, self._rules = Scratch(spark, "line-runs"), rules
        self._levels: list[list[DataFrame]] = [[]]
        self._settled: list[DataFrame] = []

    def add(self, counted: DataFrame) -> None:
        """Take in a batch: ``key, n`` with one row per key."""
        for run in self._settled:
            counted = counted.join(run, "key", "left_anti")
        self._levels[0].append(self._scratch.write(counted.sortWithinPartitions("key")))
        level = 0
        while len(self._levels[level]) >= self._rules.fan:
            if level + 1 == len(self._levels):
                self._levels.append([])
            rest = self._merge(self._levels[level])
            self._levels[level] = []
            self._levels[level + 1].append(rest)
            level += 1

    def frequent(self) -> DataFrame:
        """All keys that reach the limit."""
        runs = [run for level in self._levels for run in level]
        self._levels = [[]]
        if runs:
            self._merge(runs, last=True)
        if len(self._settled) > 1:
            whole = self._scratch.write(self._union(self._settled).repartition("key").sortWithinPartitions("key"))
            self._scratch.drop(*self._settled)
            self._settled = [whole]
        return self._settled[0]

    def _merge(self, runs: list[DataFrame], last: bool = False) -> DataFrame | None:
        """One sorted run of several; what reaches the limit goes to the settled keys."""
        summed = self._union(runs).groupBy("key").agg(F.sum("n").alias("n"))
        enough = F.col("n") >= self._rules.min_docs
        merged = self._scratch.write((summed.where(enough) if last else summed).sortWithinPartitions("key"))
        self._scratch.drop(*runs)
        self._settled.append(merged.where(enough).select("key"))
        return None if last else merged.where(~enough)

    @staticmethod
    def _union(frames: list[DataFrame]) -> DataFrame:
        out = frames[0]
        for frame in frames[1:]:
            out = out.union(frame)
        return out


def drop_frequent_lines(docs: DataFrame, id_column: str, text_column: str, rules: LineRules = LineRules()) -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines`` (before dropping) and ``n_dropped``.

    A line's key is the line without white space at its ends, A-Z lower-cased. Keys found in ``min_docs`` rows or
    more lose all their lines in every row; keys shorter than ``min_chars`` never do. A null or empty text is one
    empty line. Rows are documents: rows that repeat an id, and rows without one, count one by one. Other columns
    are kept as they are; an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "line-dedup")
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    # Which lines go depends on the text alone; the id spreads equal texts over the tasks.
    own = {"_doc": F.coalesce(F.col(id_column).cast("long"), F.lit(-1)), "_text": F.xxhash64(text)}
    keys = F.array_distinct(F.transform(_lines(_lower(text)), lambda line: _key(line, rules)))
    batch = F.pmod(F.xxhash64("_doc", "_text"), F.lit(rules.batches))
    found = docs.select(*[c.alias(n) for n, c in own.items()], F.explode(keys).alias("key"))
    found = scratch.write(found.where("key is not null").select("_doc", "_text", F.unhex("key").alias("key"), batch.alias("batch")))
    counted = scratch.write(found.groupBy("batch", "key").agg(F.count("*").alias("n")))
    runs = LineRuns(docs.sparkSession, rules)
    for k in range(rules.batches):
        runs.add(counted.where(F.col("batch") == k).select("key", "n"))
    frequent = runs.frequent()
    # Rows that repeat an id and a text name the same lines; one list serves them all.
    bad = found.join(frequent, "key").groupBy("_doc", "_text").agg(F.transform(F.collect_set("key"), lambda k: F.lower(F.hex(k))).alias("_bad"))
    bad = scratch.write(bad)
    # No column of the input may hide one of these.
    whole = docs.select(F.struct(*docs.columns).alias("row"), text.alias("text"), *[c.alias(n) for n, c in own.items()])
    met = whole.join(bad, ["_doc", "_text"], "left")
    lines = _lines(F.col("text"))
    kept = F.filter(lines, lambda line: ~F.coalesce(F.array_contains(F.col("_bad"), _key(_lower(line), rules)), F.lit(False)))
    kept = F.when(F.col("_bad").isNull(), lines).otherwise(kept)
    out = met.select("row", F.size(lines).alias("n_lines"), kept.alias("kept"))
    return out.select(
        *[F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("kept_text", "n_lines", "n_dropped")],
        F.array_join("kept", "\n").alias("kept_text"),
        F.col("n_lines").cast("long").alias("n_lines"),
        (F.col("n_lines") - F.size("kept")).cast("long").alias("n_dropped"),
    )
