"""Spelling variants: words one edit apart, found by blocked Gram matrices of letter counts.

One inserted, deleted or replaced letter changes the letter counts by a squared distance of at most two and the length by
at most one. Words of equal length and equal counts of some classes of letters form a block. A block meets itself
and the blocks that one edit can lead to; for each meeting a matrix product of the letter counts gives all squared distances, pairs
of at most two are kept and their edits verified letter by letter. Each pair of words meets once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from bandstand.runtime import Scratch

# Letters of a word and their lower-casing, fixed by the contract.
LETTERS = "[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FIRST_WIDE, _COLUMNS = 0xC0, 26 + 64
_RADIX = 256
RESIDENT, SAME_LENGTH, OWN_BLOCK, SHORTER = range(4)
VISITORS, CANDIDATE_BYTES = 1024, 1 << 24


@dataclass(frozen=True)
class VariantRules:
    """Least length and number of a word, how much more frequent a form is, classes of letters, words and bytes of one
    side of a matrix, words that one task meets."""

    least_chars: int = 5
    least_count: int = 3
    times: int = 2
    classes: int = 6
    block_words: int = 4096
    block_bytes: int = 1 << 22
    task_words: int = 150_000


def letter_runs(text: Column) -> Column:
    """All maximal runs of letters, A to Z lower-cased."""
    lowered = F.transform(
        F.regexp_extract_all(text, F.lit(LETTERS), F.lit(0)), lambda w: F.when(F.lower(w) == w, w).otherwise(F.translate(w, _UPPER, _LOWER))
    )
    return lowered


def damaged_words(docs: DataFrame, id_column: str, text_column: str, every: int, least_chars: int) -> DataFrame:
    """A row ``word`` for each letter run of the texts, with one letter deleted from those that a checksum picks.

    The checksum is the CRC of ``<id>:<run>``; where ``every`` divides it, the letter at its remainder by the length goes. A
    null text has no words, a null id stands as an empty one. Runs that cannot reach ``least_chars`` are left out.
    """
    named = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    runs = docs.select(named.alias("id"), F.explode(letter_runs(F.col(text_column).cast("string"))).alias("run"))
    length = F.char_length("run")
    summed = runs.where(length >= least_chars).select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("sum"))
    at = (F.col("sum") % length).cast("int")
    less = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2, length))
    return summed.select(F.when(F.col("sum") % every == 0, less).otherwise(F.col("run")).alias("word"))


def _class_counts(word: Column, classes: int) -> list[Column]:
    """How many letters of each class but the last the word has; letters are dealt to the classes in turn."""
    wide = [chr(c) for c in range(_FIRST_WIDE, 0x100)]
    letters = [*"etaoinsrhldcumfpgwybvkxjqz", *wide]  # frequent ones first, so that the classes are about equal
    return [F.char_length(word) - F.char_length(F.translate(word, "".join(letters[k::classes]), "")) for k in range(classes - 1)]


def _meetings(classes: int) -> list[tuple[int, int, int]]:
    """Longer by, block number away and role for each block that a word visits."""
    weight = [_RADIX**k for k in range(classes - 1)] + [0]
    other = [(0, a - b, SAME_LENGTH) for a in weight for b in weight if a > b]
    return [(0, 0, OWN_BLOCK), *other, *[(1, w, SHORTER) for w in weight]]


def _letters_of(words: pa.Array, length: int) -> np.ndarray:
    """Words of one length as a matrix of Latin-1 bytes."""
    joined = "".join(words.to_pylist()).encode("latin-1")
    return np.frombuffer(joined, np.uint8).reshape(len(words), length)


def _counts(letters: np.ndarray) -> np.ndarray:
    column = np.where(letters >= _FIRST_WIDE, letters.astype(np.int64) - _FIRST_WIDE + 26, letters.astype(np.int64) - ord("a"))
    flat = (np.arange(len(letters))[:, None] * _COLUMNS + column).ravel()
    kind = np.float32 if letters.shape[1] < 2000 else np.float64  # squares must stay whole numbers
    return np.bincount(flat, minlength=len(letters) * _COLUMNS).reshape(-1, _COLUMNS).astype(kind)


def _one_edit(short: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Which rows differ by exactly one replaced letter, or by one letter that ``other`` has more."""
    m = short.shape[1]
    if other.shape[1] == m:
        return (short != other).sum(1) == 1
    ahead = np.logical_and.accumulate(short == other[:, :m], 1).sum(1)
    behind = np.logical_and.accumulate((short == other[:, 1:])[:, ::-1], 1).sum(1)
    return ahead + behind >= m


class _Block:
    """The words that live in a block, as a matrix of letters and one of counts."""

    def __init__(self, words: pa.Array, n: pa.Array, length: int):
        self.words, self.n = words, n
        self.letters = _letters_of(words, length)
        counts = _counts(self.letters)
        self.used = np.flatnonzero(counts.any(0))
        self.half = (counts * counts).sum(1) / 2
        self.counts = np.ascontiguousarray(counts[:, self.used].T)

    def near(self, words: pa.Array, role: int) -> tuple[np.ndarray, np.ndarray]:
        """Visitors and residents that are one edit apart."""
        length = self.letters.shape[1] - (role == SHORTER)
        letters = _letters_of(words, length)
        counts = _counts(letters)
        half = (counts * counts).sum(1) / 2
        # |v - r|^2 <= 2, that is v.r >= (|v|^2 + |r|^2) / 2 - 1
        close = counts[:, self.used] @ self.counts >= half[:, None] + (self.half - 1)
        who, row = np.nonzero(close)
        keep = []
        step = max(1, CANDIDATE_BYTES // self.letters.shape[1])
        for lo in range(0, len(who), step):
            keep.append(_one_edit(letters[who[lo : lo + step]], self.letters[row[lo : lo + step]]))
        keep = np.concatenate(keep) if keep else np.zeros(0, bool)
        who, row = who[keep], row[keep]
        if role == OWN_BLOCK:  # both words of a pair visit: the first one counts
            a, b = letters[who], self.letters[row]
            first = (a != b).argmax(1)
            at = np.arange(len(who))
            ordered = a[at, first] < b[at, first]
            who, row = who[ordered], row[ordered]
        return who, row


def _near_in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, words, counts, block = None, [], [], None
    for batch in batches:
        keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)], 1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)]):
            if hi == lo:
                continue
            here, role = tuple(keys[lo, :3].tolist()), int(keys[lo, 3])
            if key != here:
                key, words, counts, block = here, [], [], None
            if role == RESIDENT:
                words.append(batch.column(4).slice(lo, hi - lo))
                counts.append(batch.column(5).slice(lo, hi - lo))
                continue
            if block is None:
                if not words:
                    continue
                block = _Block(pa.concat_arrays(words), pa.concat_arrays(counts), here[0])
                words, counts = [], []
            step = max(1, min(VISITORS, CANDIDATE_BYTES // (here[0] + 1)))
            for start in range(lo, hi, step):
                some = batch.slice(start, min(step, hi - start))
                who, row = block.near(some.column(4), role)
                if len(who):
                    columns = [some.column(4).take(pa.array(who)), some.column(5).take(pa.array(who))]
                    columns += [block.words.take(pa.array(row)), block.n.take(pa.array(row))]
                    yield pa.RecordBatch.from_arrays(columns, names=["a", "a_n", "b", "b_n"])


def near_words(scratch: Scratch, vocabulary: DataFrame, p: VariantRules = VariantRules()) -> DataFrame:
    """``a, a_n, b, b_n``: each pair of different words of ``word, n`` that are one edit apart, once.

    Words consist of letters as in ``LETTERS`` without A to Z. A block with many words is held in parts, each of which meets all
    visitors, so no task holds more than ``block_words`` words and one batch of visitors, and no pair is left out.
    """
    cell = sum((c.cast("long") * _RADIX**k for k, c in enumerate(_class_counts(F.col("word"), p.classes))), F.lit(0).cast("long"))
    placed = scratch.write(vocabulary.select("word", "n", F.char_length("word").alias("length"), cell.alias("cell")))
    rows = F.greatest(F.lit(1), F.least(F.lit(p.block_words), F.floor(F.lit(p.block_bytes) / F.col("length"))))
    parts = placed.groupBy("length", "cell").agg(F.count("*").alias("words")).select("length", "cell", F.ceil(F.col("words") / rows).cast("int").alias("parts"))
    parts = scratch.write(parts)
    part = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int").alias("part")
    living = placed.join(parts, ["length", "cell"]).select("length", "cell", part, F.lit(RESIDENT).alias("role"), "word", "n")
    ways = F.array(*[F.struct(F.lit(a).alias("longer"), F.lit(b).cast("long").alias("away"), F.lit(r).alias("role")) for a, b, r in _meetings(p.classes)])
    visits = placed.select("word", "n", "length", "cell", F.explode(ways).alias("way")).select(
        (F.col("length") + F.col("way.longer")).alias("length"), (F.col("cell") + F.col("way.away")).alias("cell"), F.col("way.role").alias("role"), "word", "n"
    )
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    visiting = visits.join(parts, ["length", "cell"]).select("length", "cell", every, "role", "word", "n")
    tasks = max(int(vocabulary.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-placed.count() * len(_meetings(p.classes)) // p.task_words))
    keys = ["length", "cell", "part"]
    dealt = living.union(visiting).repartition(tasks, *keys).sortWithinPartitions(*keys, "role")
    return dealt.select(F.col("length").cast("long"), "cell", F.col("part").cast("long"), F.col("role").cast("long"), "word", "n").mapInArrow(
        _near_in_blocks, "a string, a_n long, b string, b_n long"
    )


def variant_groups(words: DataFrame, p: VariantRules = VariantRules()) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of each frequent word of ``words``, a table with a row ``word`` per occurrence.

    Words of at least ``least_chars`` letters and ``least_count`` occurrences count. ``n_near`` is the number of words one edit
    away. The form is the most frequent of them, ties to the smallest, if it is at least ``times`` as frequent as the word; else
    null. The root is where following the forms ends. Null words and those with other signs than letters are left out;
    repeated rows are occurrences; an empty table gives an empty result; other columns are not read.
    """
    scratch = Scratch(words.sparkSession, "variants")
    counted = words.where((F.char_length("word") >= p.least_chars) & ~F.col("word").rlike("[^a-zÀ-ÿ]")).groupBy("word").agg(F.count("*").alias("n"))
    vocabulary = scratch.write(counted.where(F.col("n") >= p.least_count))
    sides = F.array(*[F.struct(F.col(x).alias("word"), F.col(y).alias("near"), F.col(f"{y}_n").alias("near_n")) for x, y in ("ab", "ba")])
    each = near_words(scratch, vocabulary, p).select(F.inline(sides))
    best = each.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("best"))
    enough = -F.col("best.rank") >= F.col("n") * p.times
    forms = scratch.write(
        vocabulary.join(best, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(enough, F.col("best.near")).alias("form"),
            F.when(enough, -F.col("best.rank")).alias("form_n"),
        )
    )
    return forms.join(_roots(scratch, forms), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(scratch: Scratch, forms: DataFrame) -> DataFrame:
    """``word, root`` of the words that have a form. Each round doubles the way covered; forms at least double in number,
    so a way is never longer than a count has binary digits."""
    ways = scratch.write(forms.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        further = scratch.write(ways.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        scratch.drop(ways)
        ways = further
        if ways.where("moved").isEmpty():
            return ways.select("word", "root")
