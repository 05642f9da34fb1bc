import itertools
import random
import re

import numpy as np
import pytest

from bandstand.llm.components import components
from bandstand.llm.near_text import NearText, near_text_components
from bandstand.llm.near_vectors import Forest, near_vector_components
from bandstand.runtime import Scratch


def shingles(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if len(found) < words:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}


class Groups:
    def __init__(self, ids):
        self.up = {i: i for i in ids}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def brute_text(rows, p):
    """Sorted (doc_id, n_shingles, component_id, kept) of all rows by comparing all pairs."""
    sets = [(d, shingles(t, p.words)) for d, t in rows]
    groups = Groups([d for d, _ in sets if d is not None])
    for (a, x), (b, y) in itertools.combinations(sets, 2):
        if a is not None and b is not None and x and y and 100 * len(x & y) >= p.percent * len(x | y):
            groups.join(a, b)
    out = [(d, len(s), d if d is None else groups.find(d)) for d, s in sets]
    # An empty text is linked with nothing, also where its id has another text.
    out = [(d, n, d if n == 0 else c) for d, n, c in out]
    return sorted(((d, n, c, c == d) for d, n, c in out), key=str)


def near(docs, p):
    return sorted((tuple(r) for r in near_text_components(docs, "doc_id", "text", p).collect()), key=str)


def test_odd_rows(clashing, odd_rows):
    p = NearText(words=3, percent=85)
    assert near(clashing, p) == brute_text([(d, t) for d, t, *_ in odd_rows], p)


def test_empty_table(clashing):
    assert near(clashing.where("false"), NearText()) == []
    assert near(clashing.where("text = ''"), NearText()) == [(5, 0, 5, True)]


@pytest.fixture(scope="module")
def copies():
    """A large group of near copies, some of them far from each other, and many documents that share a passage."""
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    base = [word() for _ in range(150)]
    rows = []
    for k in range(150):
        copy = list(base)
        for _ in range(rng.randint(1, 5)):
            copy[rng.randrange(len(copy))] = word()
        rows.append((k, " ".join(copy)))
    passage = " ".join(word() for _ in range(60))
    rows += [(200 + k, passage + " " + " ".join(word() for _ in range(rng.randint(5, 60)))) for k in range(150)]
    rows += [(400 + k, rows[0][1]) for k in range(40)]
    return rows


@pytest.mark.parametrize("p", [NearText(small=8, block=4000), NearText(words=3, percent=85, small=8, few=20, levels=2, block=2000)])
def test_large_nodes_lose_no_link(spark, copies, p):
    docs = spark.createDataFrame(copies, "doc_id long, text string").repartition(5)
    assert near(docs, p) == brute_text(copies, p)


def test_components(spark):
    rng = random.Random(4)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(500 + i, 501 + i) for i in range(40)] + [(7, 1000 + i) for i in range(60)]
    groups = Groups({x for p in pairs for x in p})
    for a, b in pairs:
        groups.join(a, b)
    got = components(Scratch(spark, "t"), spark.createDataFrame([*pairs, (None, 3), (3, None)], "a long, b long"))
    want = {x: groups.find(x) for p in pairs if p[0] != p[1] for x in p}
    assert {r.node: r.label for r in got.collect()} == want
    assert components(Scratch(spark, "t"), spark.createDataFrame([], "a long, b long")).count() == 0


def brute_vectors(rows, cosine):
    usable = [(k, np.array(v, float) / np.max(np.abs(v))) for k, (_, v) in enumerate(rows) if v and None not in v and np.isfinite(v).all() and np.any(v)]
    links = {k: 0 for k in range(len(rows))}
    groups = Groups(range(len(rows)))
    for (i, x), (j, y) in itertools.combinations(usable, 2):
        if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= cosine:
            links[i] += 1
            links[j] += 1
            groups.join(i, j)
    least = {}
    for k, (d, _) in enumerate(rows):
        if d is not None:
            least[groups.find(k)] = min(d, least.get(groups.find(k), d))
    out = []
    for k, (d, _) in enumerate(rows):
        c = None if d is None else least[groups.find(k)]
        out.append((d, links[k], c, c == d))
    return sorted(out, key=str)


def near_vectors(df, f):
    return sorted((tuple(r) for r in near_vector_components(df, "vec_id", "embedding", f).collect()), key=str)


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((500, 24))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(1000 + i, (base[i] + 0.2 * rng.standard_normal(24)).tolist()) for i in range(100)]
    rows += [(2000 + i, (base[7] + 0.15 * rng.standard_normal(24)).tolist()) for i in range(90)]
    rows += [(3000 + i, base[9].tolist()) for i in range(50)]
    want = brute_vectors(rows, 0.9)
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4), Forest(leaf=32, block=64))
    assert sum(r[1] for r in got) >= 0.99 * sum(r[1] for r in want) > 0
    by_id = {r[0]: r for r in want}
    assert all(r[1] <= by_id[r[0]][1] and r[2] >= by_id[r[0]][2] for r in got)  # nothing below the threshold
    assert sum(r == by_id[r[0]] for r in got) >= 0.99 * len(rows)


@pytest.mark.parametrize("mutual", [0.93])
def test_dense_group_keeps_its_links(spark, mutual):
    rng = np.random.default_rng(3)
    group = np.sqrt(mutual) * np.eye(64)[0] + np.sqrt((1 - mutual) / 64) * rng.standard_normal((2500, 64))
    x = np.vstack([group, rng.standard_normal((5000, 64))])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = (x @ x.T >= 0.9).sum(1) - 1
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = dict(near_vector_components(df, "vec_id", "embedding", Forest()).select("vec_id", "n_links").collect())
    found = np.array([got[i] for i in range(len(x))])
    assert (found <= want).all() and found.sum() >= 0.995 * want.sum()


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]),
        (7, [nan, 1.0]), (8, [inf, 1.0]), (None, [1.0, 0.0]), (9, [1.0, 0.0, 0.0]), (10, [1e300, 1e290]), (11, [0.0, -1.0]), (0, [-0.0, -1.0]),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, cid string")
    assert near_vectors(df, Forest()) == brute_vectors(rows, 0.9)
    assert near_vectors(df.where("false"), Forest()) == []
