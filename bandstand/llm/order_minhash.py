"""Order MinHash fingerprints. DataFrame functions only.

The k-mers of a text are runs of words between white space, numbered by occurrence; words longer than usual, such as
lines without blanks, are cut into runs of characters that start at each of their characters. A hash deals them to the
places of a signature; each place keeps the least numbered k-mer of each of its parts, puts these back into the
order they have in the text and hashes that tuple. Two texts agree in a place if they share its least k-mers and
have them in the same order, so the share of equal places falls with moved text as well as with changed text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from bandstand.functions.ordering import with_row_number
from bandstand.runtime import Scratch

_HEX = 8  # digits of a place
_EMPTY = "-" * _HEX
_SPACE = r"\p{IsWhite_Space}"
# Scripts written without blanks: Thai to Tibetan, Burmese, Khmer, kana and Han characters.
_UNSPACED = r"[\x{E00}-\x{FFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{2E80}-\x{2FDF}\x{3005}-\x{3007}\x{3040}-\x{30FF}\x{31F0}-\x{31FF}\x{3400}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}]"


@dataclass(frozen=True)
class OrderMinHash:
    """Words of a k-mer, longest word that is not cut and characters of the runs of others, places of a signature,
    k-mers of a tuple, characters of text for one task, seed."""

    words: int = 2
    longest: int = 24
    run: int = 4
    places: int = 32
    tuple_size: int = 2
    task_chars: int = 4_000_000
    seed: int = 5


def _once(value: Column) -> Column:
    """A generator of one row that holds the value: later uses read it instead of working it out again."""
    return F.explode(F.array(value))


def _unspaced(text: Column) -> Column:
    """Whether the text has signs of scripts without blanks; ASCII is not searched."""
    return (F.octet_length(text) > F.char_length(text)) & text.rlike(_UNSPACED)


def _cut(word: Column, p: OrderMinHash) -> Column:
    """The word, or the runs of characters at each of its characters where it is long or of a script without blanks."""
    runs = F.regexp_extract_all(word, F.lit(rf"(?s)(?=(.{{1,{p.run}}}))."), F.lit(1))
    return F.when((F.char_length(word) > p.longest) | _unspaced(word), runs).otherwise(F.array(word))


def _with_kmers(texts: DataFrame, keys: list[str], p: OrderMinHash) -> DataFrame:
    """``keys, kmers`` for a column ``text``: hashes of the k-mers at each word; at the end of a text they are shorter."""
    split = texts.select(*keys, _unspaced(F.col("text")).alias("unspaced"), _once(F.split("text", _SPACE)).alias("words"))
    # Most texts have no word to cut and are not gone through again.
    some = F.col("unspaced") | F.exists("words", lambda w: F.char_length(w) > p.longest)
    tokens = F.when(some, F.flatten(F.transform("words", lambda w: _cut(w, p)))).otherwise(F.col("words"))
    cut = split.select(*keys, _once(tokens).alias("tokens"))
    out = F.transform("tokens", lambda w: F.xxhash64(w))
    for k in range(1, p.words):
        later = F.slice("tokens", F.lit(k + 1), F.greatest(F.size("tokens") - k, F.lit(0)))
        out = F.zip_with(out, later, lambda h, w: F.xxhash64(h, w))
    return cut.select(*keys, _once(out).alias("kmers"))


def signatures(texts: DataFrame, keys: list[str], text_columns: dict[str, str], p: OrderMinHash = OrderMinHash()) -> DataFrame:
    """``keys`` and, for each entry ``name: column``, the signature of that text as a string.

    The keys name a row; ``texts`` should be partitioned by them, then nothing is shuffled: the k-mers of a text
    are numbered and reduced in the task that holds the text.
    """
    kinds = F.array(*[F.struct(F.lit(i).alias("kind"), F.col(c).alias("text")) for i, c in enumerate(text_columns.values())])
    each = texts.select(*keys, F.inline(kinds))
    found = _with_kmers(each, [*keys, "kind"], p).select(*keys, "kind", F.posexplode("kmers").alias("pos", "kmer"))
    same = "PARTITION BY kmer, " + ", ".join(keys) + ", kind ORDER BY pos"
    numbered = found.select(*keys, "kind", "pos", F.xxhash64("kmer", F.expr(f"row_number() OVER ({same})"), F.lit(p.seed)).alias("hash"))
    parts = p.places * p.tuple_size
    part = F.pmod("hash", F.lit(parts)).cast("int").alias("part")
    least = numbered.groupBy(*keys, "kind", part).agg(F.min("hash").alias("hash"), F.min_by("pos", "hash").alias("pos"))
    item = F.struct("part", "pos", "hash")
    lists = [F.collect_list(F.when(F.col("kind") == i, item)).alias(name) for i, name in enumerate(text_columns)]
    return least.groupBy(*keys).agg(*lists).select(*keys, *[_places(F.col(n), p).alias(n) for n in text_columns])


def _places(items: Column, p: OrderMinHash) -> Column:
    """The places' hashes, one after the other; an empty place has its own sign."""

    def place(i: Column) -> Column:
        mine = F.array_sort(
            F.transform(
                F.filter(items, lambda x: F.floor(x["part"] / p.tuple_size) == i), lambda x: F.struct(x["pos"].alias("pos"), x["hash"].alias("hash"))
            )
        )
        value = F.aggregate(mine, F.lit(p.seed).cast("long"), lambda acc, x: F.xxhash64(acc, x["hash"]))
        return F.when(F.size(mine) == 0, F.lit(_EMPTY)).otherwise(F.lpad(F.lower(F.hex(value.bitwiseAND(F.lit(0xFFFFFFFF)))), _HEX, "0"))

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(p.places - 1)), place), "")


def likeness(one: Column, two: Column, p: OrderMinHash = OrderMinHash()) -> Column:
    """Share of the places that agree, of those that are not empty in both."""

    def count(test) -> Column:
        return F.size(F.filter(F.sequence(F.lit(0), F.lit(p.places - 1)), test))

    def at(text: Column, i: Column) -> Column:
        return F.substr(text, i * _HEX + 1, F.lit(_HEX))

    used = count(lambda i: (at(one, i) != _EMPTY) | (at(two, i) != _EMPTY))
    equal = count(lambda i: (at(one, i) != _EMPTY) & (at(one, i) == at(two, i)))
    return F.when(used == 0, F.lit(1.0)).otherwise(equal / used)


def fingerprints(docs: DataFrame, id_column: str, text_column: str, p: OrderMinHash = OrderMinHash()) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text has its last quarter (rounded down) replaced by as many characters from the start of the next
    document, in ascending order of id, after the last the first; a shorter next text gives all it has. Columns
    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``. A null text is empty.
    Null ids come last. Rows that repeat an id and a text are one document in this order and get equal results; different
    texts under one id follow each other in an order of their hashes. A lone document is its own next one. An
    empty table gives an empty result; other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "order-minhash")
    keys = ["kid", "th"]
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    doc_id = F.col(id_column).cast("long")
    base = docs.select(F.coalesce(doc_id, F.lit(-(1 << 63))).alias("kid"), F.xxhash64(text).alias("th"), text.alias("text"))
    narrow = scratch.write(docs.select(doc_id.alias("doc_id"), F.xxhash64(text).alias("th"), F.char_length(text).alias("n_chars")))
    once = narrow.groupBy("doc_id", "th", "n_chars").agg(F.count("*").alias("rows"))
    ranked = scratch.write(with_row_number(once, [F.col("doc_id").asc_nulls_last(), F.col("th"), F.col("n_chars")], "rank"))
    n, chars, most = ranked.agg(F.count("*"), F.sum("n_chars"), F.max("rows")).first()
    ranked = ranked.withColumn("kid", F.coalesce("doc_id", F.lit(-(1 << 63))))
    follows = F.pmod(F.col("rank"), F.lit(max(n, 1))) + 1
    this = ranked.select(F.col("kid").alias("for_kid"), F.col("th").alias("for_th"), F.floor(F.col("n_chars") / 4).cast("int").alias("need"), follows.alias("rank"))
    pairs = scratch.write(this.join(ranked.select("rank", *keys), "rank").drop("rank"))
    if (most or 1) > 1:
        base = base.dropDuplicates(keys)
    # One shuffle of the texts serves both joins and all that follows.
    dealt = base.repartition(max(1, -(-(chars or 0) // p.task_chars), _partitions(docs)), *keys)
    heads = dealt.join(pairs, keys).select(F.col("for_kid").alias("kid"), F.col("for_th").alias("th"), "need", F.substr("text", F.lit(1), F.col("need")).alias("head"))
    met = dealt.join(heads, keys)
    kept = F.substr(F.col("text"), F.lit(1), F.char_length("text") - F.col("need"))
    met = met.select(*keys, "text", F.concat(kept, "head").alias("edited"))
    signed = signatures(met, keys, {"fingerprint": "text", "edited_fingerprint": "edited"}, p)
    digests = met.select(*keys, F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"))
    own = scratch.write(digests.join(signed, keys))
    of_next = pairs.select(*keys, "for_kid", "for_th").join(own.select(*keys, F.col("fingerprint").alias("next_fingerprint")), keys)
    of_next = of_next.select(F.col("for_kid").alias("kid"), F.col("for_th").alias("th"), "next_fingerprint")
    out = own.join(of_next, keys).select(
        *keys,
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint"), p).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint"), p).alias("near_next"),
    )
    if (most or 1) > 1:
        rows = ranked.select("doc_id", "rows", *keys)
        repeats = F.explode(F.sequence(F.lit(1), F.col("rows").cast("int")))
        return out.join(rows, keys).withColumn("_copy", repeats).select("doc_id", *[c for c in out.columns if c not in keys])
    named = F.when(F.col("kid") != -(1 << 63), F.col("kid")).alias("doc_id")
    return out.select(named, *[c for c in out.columns if c not in keys])


def _partitions(docs: DataFrame) -> int:
    return int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
