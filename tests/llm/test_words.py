"""Nearest vectors, spelling variants and phrases against plain versions of what they promise."""

import random
import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from bandstand.llm import collocations as phrases
from bandstand.llm import vantage, variants
from bandstand.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<float>"


def nearest(rows, every, k):
    """Brute force over usable rows; the least vector of an id counts."""
    least = {}
    for i, e in rows:
        if i is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e):
            e = [float(np.float32(x)) for x in e]
            least[i] = min(least.get(i, e), e)
    out = set()
    for q, a in least.items():
        if q % every == 0:
            scored = []
            for c, b in least.items():
                if c != q and len(b) == len(a):
                    dot = aa = bb = 0.0
                    for x, y in zip(a, b):
                        dot, aa, bb = dot + x * y, aa + x * x, bb + y * y
                    scored.append((-dot / (aa**0.5 * bb**0.5), c))
            out |= {(q, r + 1, c, -s) for r, (s, c) in enumerate(sorted(scored)[:k])}
    return out


def close(got, want):
    got = {(r.query_id, r.rank, r.vec_id): r.score for r in got}
    want = {(q, r, c): s for q, r, c, s in want}
    return got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in got)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(2)
    rows = [(k, rng.normal(size=8).tolist()) for k in range(600)]
    rows += [(1000 + k, rows[5][1]) for k in range(40)]  # ties beyond the number of neighbours
    rows += [(1100 + k, (np.array(rows[7][1]) * 2**k).tolist()) for k in range(9)]
    rows += [(1150, None), (1200, []), (1250, [0.0] * 8), (1300, [1.0, None] + [0.0] * 6), (1350, [float("nan")] * 8), (1400, [float("inf")] * 8)]
    rows += [(1450, [1.0, 2.0]), (1451, [2.0, 1.0]), (1500, [3.0, 0.0, 1.0]), (None, rows[0][1]), (50, rows[51][1]), (3, rows[3][1])]
    return rows


def test_searches_are_exact_over_small_leaves_and_many_shards(spark, vectors):
    df = spark.createDataFrame(vectors, VECTORS).select("*", *[F.lit("x").alias(c) for c in ("id", "vector", "shard", "width", "role")])
    p = vantage.VantageSearch(neighbours=5, leaf=8, least_rows=64)
    want = nearest(vectors, 50, 5)
    assert close(vantage.nearest_vectors(df, "vec_id", "embedding", F.col("id") % 50 == 0, p).collect(), want)
    one = vantage.VantageSearch(neighbours=5, leaf=8, least_rows=10_000)
    assert close(vantage.nearest_vectors(df, "vec_id", "embedding", F.col("id") % 50 == 0, one).collect(), want)


def test_few_candidates_and_empty_tables(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, 1.0])], VECTORS)
    got = vantage.nearest_vectors(few, "vec_id", "embedding", F.col("id") % 50 == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in got] == [(0, 1, 1), (0, 2, 2)]
    assert vantage.nearest_vectors(few.where("vec_id > 0"), "vec_id", "embedding", F.col("id") % 50 == 0).count() == 0
    assert vantage.nearest_vectors(few.where("false"), "vec_id", "embedding", F.col("id") % 50 == 0).count() == 0


def test_trees_prune_and_a_larger_factor_prunes_more():
    rng = np.random.default_rng(4)
    rows = np.concatenate([c + rng.normal(scale=0.02, size=(500, 6)) for c in rng.normal(size=(12, 6))])
    unit = rows / np.linalg.norm(rows, axis=1)[:, None]
    tree = vantage.VantageTree(unit, 16, 1)
    queries = unit[::60]
    exact = np.argsort(-(queries @ unit.T), 1)[:, :6]
    looked = {}
    for factor in (1.0, 2.0):
        seen, matrix = [0], tree.unit

        class Counted:
            def __getitem__(self, s):
                seen[0] += s.stop - s.start if isinstance(s, slice) else 1
                return matrix[s]

        tree.unit = Counted()
        who, row = tree.search(queries, 6, factor)
        tree.unit = matrix
        found = [set(row[who == q].tolist()) for q in range(len(queries))]
        looked[factor] = seen[0], np.mean([len(set(e) & f) / 6 for e, f in zip(exact.tolist(), found)])
    assert looked[1.0][1] == 1.0 and looked[2.0][1] >= 0.8
    assert looked[2.0][0] <= looked[1.0][0]


def variant_rows(words, least_chars=5, least_count=3, times=2):
    counts = {w: n for w, n in Counter(words).items() if len(w) >= least_chars and n >= least_count}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    by = {w: [x for x in counts if abs(len(x) - len(w)) < 2 and x != w and near(w, x)] for w in counts}
    form = {}
    for w in counts:
        best = min(by[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= times * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(by[w]), counts[form[w]] if form[w] else None)
    return out


def as_rows(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def test_variants_are_those_of_all_pairs(spark):
    rng = random.Random(3)
    base = ["".join(rng.choice("abdeÿé×") for _ in range(rng.randint(4, 7))) for _ in range(40)]
    words = []
    for w in base:
        for _ in range(12):
            k, x = rng.randrange(len(w)), w
            x = rng.choice([x, x[:k] + x[k + 1 :], x[:k] + rng.choice("abdeÿé") + x[k:], x[:k] + rng.choice("abdeÿé") + x[k + 1 :]])
            words += [x] * rng.choice([2, 3, 6, 13, 27])
    words += [a + "xyzw" for a in ("".join(x) for x in product("ab", repeat=3)) for _ in range(3)] + ["q" * 3000] * 3 + ["q" * 2999] * 7
    odd = [None, "", "UPPER", "ÅÅÅÅÅ", "no1digits", "with blank"] * 3
    df = spark.createDataFrame([(w, "x", 1) for w in [*words, *odd]], "word string, cell string, part int").repartition(5)
    want = variant_rows([*words, "ÅÅÅÅÅ", "ÅÅÅÅÅ", "ÅÅÅÅÅ"])
    assert as_rows(variants.variant_groups(df)) == want
    small = variants.VariantRules(block_words=3, block_bytes=12_000, classes=3)
    assert as_rows(variants.variant_groups(df, small)) == want
    assert variants.variant_groups(df.where("false")).count() == 0


def test_runs_are_damaged_by_their_checksum(clashing, odd_rows):
    want = Counter()
    for i, text, *_ in odd_rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 7 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                want[run] += 1
    got = variants.damaged_words(clashing, "doc_id", "text", 7, 5).where("char_length(word) >= 5").groupBy("word").count().collect()
    assert {r.word: r["count"] for r in got} == want


def phrase_rows(rows, longest, least, top):
    count, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                count.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    often = {key: a for key, a in count.items() if a >= least and len(key[1]) > 1}
    held = {(lang, w[i:j]): a for (lang, w), a in sorted(often.items(), key=lambda x: x[1]) for i in range(len(w)) for j in range(i + 2, len(w) + 1) if j - i < len(w)}
    out = []
    for (lang, w), a in often.items():
        if held.get((lang, w), 0) < a:
            cuts = [(1000 * a * total[lang] // (count[lang, w[:k]] * count[lang, w[k:]]), k) for k in range(1, len(w))]
            score, k = min(cuts)
            out.append((lang, -score, -a, " ".join(w).encode(), count[lang, w[:k]], count[lang, w[k:]], total[lang]))
    best = set()
    for lang in {x[0] for x in out}:
        mine = sorted(x for x in out if x[0] == lang)[:top]
        best |= {(lang, r + 1, x[3].decode(), -x[2], x[4], x[5], x[6], -x[1]) for r, x in enumerate(mine)}
    return best


@pytest.fixture(scope="module")
def spoken():
    rng = random.Random(8)
    parts = ["in the beginning of", "the old house", "a b a b a", "Ça va", "New York", "x", "y", "z", "über", "of", "the"]
    rows = []
    for _ in range(400):
        text = "".join(rng.choice(parts) + rng.choice([" ", " ", "\t", ". ", ",", "\n", "\r\x0b", " ! "]) for _ in range(rng.randint(0, 30)))
        rows.append((rng.choice(["en", "en", "fr", None, "und"]), text))
    rows += [("en", None), (None, None), ("fr", ""), ("fr", " .,; "), ("en", "of"), ("de", "de en " * 40), ("en", "de en " * 40), ("zz", "long one " * 5000)]
    return rows


@pytest.mark.parametrize("shards,longest", [(3, 5), (4, 3)])
def test_phrases_are_those_of_a_plain_count(spark, spoken, shards, longest):
    df = spark.createDataFrame([(*r, "x", 2) for r in spoken], "lang string, text string, key string, n int").repartition(3)
    p = phrases.PhraseRules(longest=longest, least=20, top=25, shards=shards, chunk_bytes=1000)
    got = {tuple(r) for r in phrases.collocations(df, "lang", "text", p).collect()}
    assert got == phrase_rows(spoken, longest, 20, 25)


def test_no_phrases_without_texts(spark, spoken):
    df = spark.createDataFrame(spoken, "lang string, text string")
    assert phrases.collocations(df.where("false"), "lang", "text").count() == 0
    assert phrases.collocations(df.where("text is null"), "lang", "text").count() == 0


def test_words_that_share_a_key_are_numbered_anew(spark, spoken, monkeypatch):
    real = phrases.slice_hashes
    weak = lambda data, starts, ends, seed=0: real(data, starts, ends, seed) if seed else real(data, starts, ends) % np.uint64(7)
    rows, clash = spoken[:80], phrases._store

    def store(batches, shards, chunk_bytes, seed):
        phrases.slice_hashes = weak
        return clash(batches, shards, chunk_bytes, seed)

    monkeypatch.setattr(phrases, "_store", store)
    df = spark.createDataFrame(rows, "lang string, text string")
    got = {tuple(r) for r in phrases.collocations(df, "lang", "text", phrases.PhraseRules(least=10, top=50)).collect()}
    assert got == phrase_rows(rows, 5, 10, 50)


def test_rare_phrases_are_counted_in_a_few_bytes_each():
    rng = np.random.default_rng(5)
    keys = rng.integers(0, 2**64, 2000, dtype=np.uint64)
    width = 1 << 16
    known, none = np.zeros(width // 64, np.uint64), np.zeros(width // 64, np.uint64)
    for at in phrases._places(phrases._short(keys), width):
        np.bitwise_or.at(known, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
    filters, p, bits = phrases._Filter(known, none), phrases.PhraseRules(longest=2, least=100, shards=1), 4
    runs, pairs = [], []
    for _ in range(2):
        codes = rng.integers(0, 2000, 400_000)
        packed = phrases._packed(codes, np.arange(len(codes)) == 0)
        chunk = pa.RecordBatch.from_arrays([pa.array([keys.tobytes()]), pa.array([packed])], names=["keys", "codes"])
        runs += phrases._hash_scan(iter([chunk]), filters, 2, 1, bits)
        pairs.append(phrases._short(phrases._extended(keys[codes[:-1]], keys[codes[1:]])))
    passes = filters.look(np.concatenate(pairs) << np.uint64(64 - phrases._SHORT))[0]
    want = dict(zip(*(x.tolist() for x in np.unique(np.concatenate(pairs)[~passes], return_counts=True))))
    size = sum(len(zlib.compress(x.as_py(), 1)) for r in runs for x in (r.column(k)[0] for k in (2, 3, 4)))
    assert size < 6 * sum(len(np.unique(x)) for x in pairs)
    # A cycle of two shards is not over after one scan: all counts are kept, and added up.
    merged = list(phrases._merged(iter(runs), 1, phrases.PhraseRules(longest=2, least=3, shards=2), bits))
    got = {}
    for r in merged:
        kind, n = r.column(0)[0].as_py(), phrases._numbers(r.column(3)[0].as_py(), 8).tolist()
        assert all((x >= 3) == (kind == "reached") for x in n)
        got |= zip(np.cumsum(phrases._numbers(r.column(2)[0].as_py(), 5)).tolist(), n)
    assert got == want
    assert not list(phrases._merged(iter(runs), 1, p, bits))


def test_registered_queries_give_the_agreed_columns(spark):
    d = "/root/testdata/sf0.001"
    rows = QUERIES["op11_vantage_trees"](spark, d)
    assert rows.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")] and rows.count() == 50
    rows = QUERIES["op12_variant_blocks"](spark, d)
    assert rows.dtypes == [("word", "string"), ("form", "string"), ("root", "string"), ("n", "bigint"), ("n_near", "bigint"), ("form_n", "bigint")]
    rows = QUERIES["op13_itemset_phrases"](spark, d)
    assert rows.dtypes == [("lang", "string"), ("rank", "bigint"), ("phrase", "string"), *[(c, "bigint") for c in ("a", "l", "r", "n", "score")]]
