"""Phrases that keep together, mined by dynamic itemset counting.

The words of the texts are stored as numbers, in shards, and counted on the way. Then the shards are scanned in turn, again
and again. In each scan phrases of all lengths are counted side by side: a phrase is active from the scan after
both its subphrases (without its last and without its first word) reached the threshold, and is counted for one full
cycle of shards, after which its count is complete. Scans end when no phrase became frequent within a cycle.

These scans count short hashes, sorted and packed to a few bytes each, and know what is frequent by a bit filter of bounded
size to which bits are only added: each shard counts a phrase once, in the first scan whose filter passes it. Both may
take too many phrases for frequent, but never miss one. A last scan counts the words of the phrases that the filter holds; those
that reach the threshold by this count are the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from bandstand.llm.ragged import mix, slice_hashes, text_slices, unique_slices
from bandstand.runtime import Scratch, scratch_path

UNNAMED = "und"
PARTS = 64
# Signs that end a piece and signs that part words, fixed by the contract.
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_TASK_WORDS, _TASK_PHRASES, _TASK_HASHES = 400_000, 2_000_000, 4_000_000
# Bits of a short hash, and words of the texts for each bucket of them.
_SHORT, _BUCKET_WORDS = 40, 1_000_000
_RUNS = "kind string, bucket int, hashes binary, counts binary, starts binary"
_PHRASES = "bucket int, length int, words binary, counts binary"
_STORED = "shard int, part string, lang string, word string, key long, n long, keys binary, codes binary"


@dataclass(frozen=True)
class PhraseRules:
    """Words of the longest phrase, least count, phrases returned per language, shards of a cycle, most bits of the filter,
    bytes of text in a chunk."""

    longest: int = 5
    least: int = 100
    top: int = 2000
    shards: int = 2
    filter_bits: int = 1 << 26
    chunk_bytes: int = 1 << 20


def _spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First and end byte of each word, whether it begins a piece, and the number of its text."""
    stop = _BREAK[data]
    inside = ~(stop | _BLANK[data])
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    filled = np.diff(offsets) > 0
    first, last = offsets[:-1][filled], offsets[1:][filled] - 1
    begins[first] = inside[first]
    ends[last] = inside[last]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    text = np.searchsorted(offsets, starts, "right") - 1
    piece = np.cumsum(stop)[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (piece[1:] != piece[:-1]) | (text[1:] != text[:-1])
    return starts, stops, new, text


def _store(batches: Iterator[pa.RecordBatch], shards: int, chunk_bytes: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Chunks of numbered words, dealt to the shards in turn, and how often each word stands in all chunks."""
    names = [f.split()[0] for f in _STORED.split(", ")]
    turn = TaskContext.get().partitionId()
    seen: dict[int, int] = {}
    texts: dict[int, tuple[str, str]] = {}
    clashes: list[tuple[int, tuple[str, str], int]] = []

    def words() -> Iterator[pa.RecordBatch]:
        # A second word under one key is told without a count; the words are then numbered anew.
        rows = chain(((key, texts[key], n) for key, n in seen.items()), clashes)
        while some := list(islice(rows, 50_000)):
            keys, named, n = zip(*some)
            none = pa.nulls(len(some), pa.binary())
            columns = [pa.nulls(len(some), pa.int32()), pa.array(["words"] * len(some)), *(pa.array(x) for x in zip(*named))]
            columns += [pa.array(keys, pa.int64()), pa.array(n, pa.int64()), none, none]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        for held in (seen, texts, clashes):
            held.clear()

    for batch in batches:
        langs = batch.column(0).to_pylist()
        for lo, hi, data, offsets in text_slices(batch.column(1), chunk_bytes):
            data = _LOWER[data]
            starts, ends, new, text = _spans(data, offsets)
            if not len(starts):
                continue
            hashes = slice_hashes(data, starts, ends, seed)
            one, back = unique_slices(data, starts, ends, hashes)
            here = sorted(set(langs[lo:hi]))
            number = {lang: k for k, lang in enumerate(here)}
            lang = np.array([number[x] for x in langs[lo:hi]], np.int64)[text]
            pairs, codes, counts = np.unique(back * len(here) + lang, return_inverse=True, return_counts=True)
            # Frequent words get small numbers, which are stored in little space.
            order = np.argsort(-counts, kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            pairs, counts, codes = pairs[order], counts[order], place[codes]
            word, lang_of = one[pairs // len(here)], pairs % len(here)
            salts = np.array([_text_hash(x, seed) for x in here], np.uint64)
            keys = mix(hashes[word] + mix(salts[lang_of])).view(np.int64)
            blob, first, end = data.tobytes(), starts[word].tolist(), ends[word].tolist()
            for k, (key, n) in enumerate(zip(keys.tolist(), counts.tolist())):
                named = here[lang_of[k]], blob[first[k] : end[k]].decode("utf-8")
                seen[key] = seen.get(key, 0) + n
                if texts.setdefault(key, named) != named:
                    clashes.append((key, named, 0))
            none = [pa.nulls(1, t) for t in (pa.string(), pa.string(), pa.int64(), pa.int64())]
            columns = [pa.array([turn % shards], pa.int32()), pa.array(["texts"]), *none, pa.array([keys.tobytes()], pa.binary()), pa.array([_packed(codes, new)], pa.binary())]
            turn += 1
            yield pa.RecordBatch.from_arrays(columns, names=names)
            if len(texts) > _TASK_WORDS:
                yield from words()
    yield from words()


def _packed(codes: np.ndarray, new: np.ndarray) -> bytes:
    """Word numbers with the mark of a new piece, byte by byte: all lowest bytes first, so that they compress well."""
    coded = ((codes.astype("<u4") << np.uint32(1)) | new).astype("<u4")
    return np.ascontiguousarray(coded.view(np.uint8).reshape(-1, 4).T).tobytes()


def _unpacked(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(packed, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _text_hash(text: str, seed: int) -> int:
    raw = np.frombuffer(text.encode(), np.uint8)
    return int(slice_hashes(raw, np.zeros(1, np.int64), np.full(1, len(raw)), seed)[0])


def _extended(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hash of each phrase with one more word at its end."""
    return mix(hashes * np.uint64(0xD1B54A32D192ED03) + words)


def _short(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - _SHORT)


class _Filter:
    """Bits of the short hashes of what is taken for frequent now, and one cycle of scans before."""

    def __init__(self, known: np.ndarray, before: np.ndarray):
        self.known, self.before = known, before

    def _has(self, bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        out = np.ones(len(hashes), bool)
        for at in _places(hashes, len(bits) * 64):
            out &= (bits[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
        return out

    def look(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        short = _short(hashes)
        known = self._has(self.known, short)
        before = known.copy()
        before[known] = self._has(self.before, short[known])
        return known, before


def _places(short: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask, mixed = np.uint64(bits - 1), mix(short)
    return (mixed & mask).astype(np.int64), (mixed >> np.uint64(34) & mask).astype(np.int64)


def _active_phrases(keys: np.ndarray, coded: np.ndarray, filters: _Filter, longest: int) -> Iterator[tuple[np.ndarray, ...]]:
    """For each length, one row per occurrence of the phrases whose subphrases pass: the hash, where it begins, whether the
    phrase passes itself, and whether its subphrases passed a cycle before."""
    words = keys[coded >> 1]
    piece = np.cumsum(coded & np.uint32(1), dtype=np.int64)
    word_known, word_before = filters.look(keys)
    code = (coded >> 1).astype(np.int64)
    at = np.flatnonzero(word_known[code])
    before, hashes = word_before[code[at]], words[at]
    for length in range(2, longest + 1):
        # A phrase begins where a frequent one begins at its place and at the next, in one piece.
        follows = np.flatnonzero(at[1:] == at[:-1] + 1)
        begin = at[follows]
        inside = begin + length <= len(words)
        follows, begin = follows[inside], begin[inside]
        whole = piece[begin + length - 1] == piece[begin]
        follows, begin = follows[whole], begin[whole]
        counted = before[follows] & before[follows + 1]
        longer = _extended(hashes[follows], words[begin + length - 1])
        passes, passed = filters.look(longer)
        yield longer, begin, passes, counted
        at, hashes, before = begin[passes], longer[passes], (counted & passed)[passes]


def _planes(values: np.ndarray, width: int) -> bytes:
    """Numbers byte by byte, all lowest bytes first, so that they compress well."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def _numbers(planes: bytes, width: int) -> np.ndarray:
    raw = np.frombuffer(planes, np.uint8).reshape(width, -1)
    out = np.zeros((raw.shape[1], 8), np.uint8)
    out[:, :width] = raw.T
    return out.view("<u8").ravel()


def _buckets(short: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """The buckets that sorted short hashes fall into, by their first ``bits`` bits: number, first and end place."""
    bounds = np.searchsorted(short, np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(_SHORT - bits)).tolist()
    return ((bucket, lo, hi) for bucket, (lo, hi) in enumerate(zip(bounds, bounds[1:])) if lo < hi)


def _runs(kind: str, short: np.ndarray, n: np.ndarray, starts: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """Sorted short hashes with their counts and first scans, a row for each bucket."""
    for bucket, lo, hi in _buckets(short, bits):
        steps = np.diff(short[lo:hi], prepend=np.uint64(0))
        row = (kind, bucket, _planes(steps, _SHORT // 8), _planes(n[lo:hi], 8), _planes(starts[lo:hi], 4))
        types = (pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names=[f.split()[0] for f in _RUNS.split(", ")])


def _hash_scan(batches: Iterator[pa.RecordBatch], filters: _Filter, longest: int, step: int, bits: int) -> Iterator[pa.RecordBatch]:
    """How often the hashes of active phrases occur that neither passed nor were counted before."""
    held: list[np.ndarray] = []

    def counted() -> Iterator[pa.RecordBatch]:
        if held:
            short, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            yield from _runs("active", short, n, np.full(len(n), step), bits)

    size = 0
    for batch in batches:
        for keys, coded in zip(batch.column(0), batch.column(1)):
            keys, coded = np.frombuffer(keys.as_py(), np.uint64), _unpacked(coded.as_py())
            for longer, _, passes, before in _active_phrases(keys, coded, filters, longest):
                held.append(_short(longer[~(passes | before)]))
                size += len(held[-1])
            if size > _TASK_HASHES:
                yield from counted()
                size = 0
    yield from counted()


def _merged(batches: Iterator[pa.RecordBatch], step: int, p: PhraseRules, bits: int) -> Iterator[pa.RecordBatch]:
    """The counts of some buckets added up: hashes that reached the threshold, and those to be counted further."""
    read: tuple[list, list, list] = ([], [], [])
    for batch in batches:
        for row in zip(*(batch.column(k) for k in (2, 3, 4))):
            hashes, n, starts = (x.as_py() for x in row)
            for held, x in zip(read, (np.cumsum(_numbers(hashes, _SHORT // 8), dtype=np.uint64), _numbers(n, 8), _numbers(starts, 4))):
                held.append(x)
    if not read[0]:
        return
    every, n, starts = (np.concatenate(x) for x in read)
    for x in read:
        x.clear()
    order = np.argsort(every, kind="stable")
    every = every[order]
    first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
    short, n, starts = every[first], np.add.reduceat(n[order], first), np.minimum.reduceat(starts[order], first)
    reached = n >= p.least
    # What has had its cycle and is not frequent is not needed any more.
    further = ~reached & (starts + np.uint64(p.shards) > np.uint64(step + 1))
    for kind, some in (("reached", reached), ("active", further)):
        yield from _runs(kind, short[some], n[some], starts[some], bits)


def _counted(hashes: list[np.ndarray], rows: list[np.ndarray], n: list[np.ndarray] | None = None) -> tuple[np.ndarray, ...]:
    """Hashes, different rows and their number, or the sum of their numbers ``n``; equal hashes stand together, in order."""
    every, words = np.concatenate(hashes), np.concatenate(rows)
    numbers = np.ones(len(every), np.int64) if n is None else np.concatenate(n).astype(np.int64)
    order = np.argsort(every, kind="stable")
    every, words, numbers = every[order], words[order], numbers[order]
    if (words[1:] != words[:-1])[every[1:] == every[:-1]].any():  # rows that share a hash
        order = np.lexsort((*words.T, every))
        every, words, numbers = every[order], words[order], numbers[order]
    new = np.ones(len(every), bool)
    new[1:] = (every[1:] != every[:-1]) | (words[1:] != words[:-1]).any(axis=1)
    first = np.flatnonzero(new)
    return every[first], words[first], np.add.reduceat(numbers, first)


def _lists(rows: np.ndarray) -> pa.Array:
    bounds = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.ascontiguousarray(rows).view(np.int64).ravel()))


def _scan(batches: Iterator[pa.RecordBatch], filters: _Filter, longest: int, bits: int) -> Iterator[pa.RecordBatch]:
    """The words of the phrases that pass, and their number, packed by length and bucket."""
    held: dict[int, tuple[list, list]] = {k: ([], []) for k in range(2, longest + 1)}
    size = 0

    def counted() -> Iterator[pa.RecordBatch]:
        for length, (hashes, rows) in held.items():
            if hashes:
                every, words, n = _counted(hashes, rows)
                for bucket, lo, hi in _buckets(_short(every), bits):
                    row = (bucket, length, words[lo:hi].tobytes(), _planes(n[lo:hi], 8))
                    types = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names=[f.split()[0] for f in _PHRASES.split(", ")])
                hashes.clear()
                rows.clear()

    for batch in batches:
        for keys, coded in zip(batch.column(0), batch.column(1)):
            keys, coded = np.frombuffer(keys.as_py(), np.uint64), _unpacked(coded.as_py())
            words = keys[coded >> 1]
            for length, (longer, begin, passes, _) in enumerate(_active_phrases(keys, coded, filters, longest), 2):
                if passes.any():
                    held[length][0].append(longer[passes])
                    held[length][1].append(words[begin[passes, None] + np.arange(length)])
                    size += int(passes.sum())
            if size > _TASK_PHRASES:
                yield from counted()
                size = 0
    yield from counted()


def _frequent(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """The phrases of some buckets that occur often enough."""
    read: dict[int, tuple[list, list, list]] = {}
    for batch in batches:
        for length, words, n in zip(*(batch.column(k) for k in (1, 2, 3))):
            words = np.frombuffer(words.as_py(), np.uint64).reshape(-1, length.as_py())
            hashes = words[:, 0]
            for k in range(1, words.shape[1]):
                hashes = _extended(hashes, words[:, k])
            for held, x in zip(read.setdefault(words.shape[1], ([], [], [])), (hashes, words, _numbers(n.as_py(), 8))):
                held.append(x)
    while read:
        _, words, n = _counted(*read.popitem()[1])
        often = n >= least
        yield pa.RecordBatch.from_arrays([_lists(words[often]), pa.array(n[often])], names=["w", "n"])


def _bits_of(rows: DataFrame, bits: int) -> np.ndarray:
    """The filter's bits of the words' keys or of packed runs of hashes, in one column; what reaches the driver are the bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            if pa.types.is_integer(column.type):
                each = [_short(column.to_numpy().view(np.uint64))]
            else:
                each = (np.cumsum(_numbers(x.as_py(), _SHORT // 8), dtype=np.uint64) for x in column)
            for short in each:
                for at in _places(short, bits):
                    one = (np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array(one)], names=["at", "bits"])

    got = rows.mapInArrow(run, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[got["at"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
    return out


def _stored(docs: DataFrame, lang_column: str, text_column: str, p: PhraseRules, seed: int) -> str:
    spark = docs.sparkSession
    path = scratch_path(spark, "phrases")
    lang = F.coalesce(F.col(lang_column).cast("string"), F.lit(UNNAMED)).alias("lang")
    picked = docs.select(lang, F.col(text_column).cast("string").alias("text"))
    stored = picked.mapInArrow(lambda batches: _store(batches, p.shards, p.chunk_bytes, seed), _STORED)
    stored.write.partitionBy("part", "shard").option("compression", "zstd").parquet(path)
    return path


def frequent_phrases(scratch: Scratch, docs: DataFrame, lang_column: str, text_column: str, p: PhraseRules) -> tuple[DataFrame, DataFrame]:
    """All words as ``key, lang, word, n``, and all phrases of two to ``p.longest`` words that occur ``p.least`` times
    or more as ``w`` (the keys of the words) and ``n``."""
    spark = docs.sparkSession
    schema = ", ".join(f for f in _STORED.split(", ") if not f.startswith(("shard", "part")))
    seed = 0
    while True:
        path = _stored(docs, lang_column, text_column, p, seed)
        read = spark.read.schema(f"{schema}, part string, shard int").parquet(path)
        words = scratch.write(read.where("part = 'words'").groupBy("key", "lang", "word").agg(F.sum("n").alias("n")))
        if words.groupBy("key").agg(F.count("*").alias("words")).where("words > 1").isEmpty():
            break
        seed += 1  # two words share a key: number them anew
    texts = read.where("part = 'texts'").select("keys", "codes", "shard")
    total = words.agg(F.sum("n")).first()[0] or 0
    width, bits = 1 << 16, 4
    while width < min(p.filter_bits, total // p.least * 16):
        width *= 2
    while _BUCKET_WORDS << bits < total:
        bits += 1
    none = np.zeros(width // 64, np.uint64)
    known = [_bits_of(words.where(F.col("n") >= p.least).select("key"), width)]  # before the first scan and after each of the last ones
    state, step = None, 0
    # What passes the filter of a cycle before was counted in all shards.
    while not (known[-1] == (known[-1 - p.shards] if step >= p.shards else none)).all():
        step += 1
        filters = _Filter(known[-1], known[-1 - p.shards] if step > p.shards else none)
        rows = texts.where(F.col("shard") == (step - 1) % p.shards).select("keys", "codes")
        found = rows.mapInArrow(lambda batches, step=step, filters=filters: _hash_scan(batches, filters, p.longest, step, bits), _RUNS)
        if state is not None:
            found = found.union(state.where("kind = 'active'"))
        dealt = found.repartition(1 << bits, "bucket")
        before, state = state, scratch.write(dealt.mapInArrow(lambda batches, step=step: _merged(batches, step, p, bits), _RUNS))
        if before is not None:
            scratch.drop(before)
        known = [*known[-p.shards :], known[-1] | _bits_of(state.where("kind = 'reached'").select("hashes"), width)]
    if state is not None:
        scratch.drop(state)
    filters = _Filter(known[-1], none)
    found = texts.select("keys", "codes").mapInArrow(lambda batches: _scan(batches, filters, p.longest, bits), _PHRASES)
    return words, scratch.write(found.repartition(1 << bits, "bucket").mapInArrow(lambda batches: _frequent(batches, p.least), "w array<bigint>, n long"))


def collocations(docs: DataFrame, lang_column: str, text_column: str, p: PhraseRules = PhraseRules()) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``p.top`` phrases.

    A text (null: empty) is lower-cased from A to Z and parted into pieces and words. ``a`` counts a phrase, ``l`` and ``r`` the two
    parts of its lowest-scoring cut (ties: the earliest cut), ``n`` all words of the language (null: ``und``); the score is
    ``floor(1000 a n / (l r))`` in exact decimals. A phrase goes if a longer one that occurs as often holds it. Repeated rows count
    each time; a table without texts gives an empty result; other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "collocations")
    words, phrases = frequent_phrases(scratch, docs, lang_column, text_column, p)
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    common = scratch.write(words.where(F.col("n") >= p.least).select("key", "lang", "word", "n"))
    counts = scratch.write(phrases.union(common.select(F.array("key").alias("w"), "n")))
    words_of = F.size("w")
    inside = F.explode(F.array(F.slice("w", F.lit(1), words_of - 1), F.slice("w", F.lit(2), words_of - 1))).alias("w")
    held = phrases.where(words_of > 2).select(inside, "n").groupBy("w").agg(F.max("n").alias("longer"))
    left = phrases.join(held, "w", "left").where(F.coalesce("longer", F.lit(0)) < F.col("n")).select("w", F.col("n").alias("a"))
    langs = common.select(F.col("key").alias("first"), "lang").join(totals, "lang")
    left = left.join(langs, F.element_at("w", 1) == F.col("first")).drop("first")
    cuts = left.withColumn("cut", F.explode(F.sequence(F.lit(1), words_of - 1)))
    one = counts.select(F.col("w").alias("one"), F.col("n").alias("l"))
    two = counts.select(F.col("w").alias("two"), F.col("n").alias("r"))
    cuts = cuts.join(one, F.slice("w", F.lit(1), F.col("cut")) == F.col("one")).join(two, F.slice("w", F.col("cut") + 1, words_of - F.col("cut")) == F.col("two"))
    wide = "decimal(38,0)"
    score = F.expr(f"(CAST(1000 AS {wide}) * a * total) div (CAST(l AS {wide}) * r)").alias("score")
    scored = cuts.select("w", "lang", "a", F.col("total").alias("n"), F.struct(score, "cut", "l", "r").alias("of"))
    scored = scored.groupBy("w", "lang", "a", "n").agg(F.min("of").alias("of"))
    spelled = left.select("w", F.posexplode("w").alias("place", "key")).join(common.select("key", "word"), "key")
    spelled = spelled.groupBy("w").agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("words"))
    named = spelled.select("w", F.array_join(F.transform("words", lambda x: x["word"]), " ").alias("phrase"))
    order = [F.col("of.score").desc(), F.col("a").desc(), F.col("phrase")]
    # A language's phrases are ranked in parts first, so that no task orders all of them.
    part = F.pmod(F.xxhash64("w"), F.lit(PARTS))
    ranked = scored.join(named, "w")
    for keys in (["lang", part], ["lang"]):
        ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= p.top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("of.l").alias("l"), F.col("of.r").alias("r"), "n", F.col("of.score").alias("score"))
