import itertools

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from bandstand.functions import similarity
from bandstand.operators import linkage, merge


def lcs(a, b):
    """Textbook table."""
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b, 1):
            row[j] = before[j - 1] + 1 if x == y else max(before[j], row[j - 1])
    return row[-1]


@given(st.text("abc d", max_size=30), st.text("abc d", max_size=30))
@settings(max_examples=300, deadline=None)
def test_common_subsequence_matches_the_table(a, b):
    assert similarity._lcs(a, b) == lcs(a, b)


def test_token_sort_ratio(spark):
    pairs = [
        ("Bring Me the Horizon", "bring me The horizon"), ("horizon bring the me", "Bring Me the Horizon"),
        ("The Acacia Strain", "Acacia Strain"), ("abc", "abd"), ("  x ", ""), ("x" * 900 + "y", "x" * 900),
    ]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i INT, a STRING, b STRING")
    got = [r[1] for r in df.select("i", similarity.token_sort_ratio(F.col("a"), F.col("b"))).orderBy("i").collect()]

    def expected(a, b):
        a, b = (" ".join(sorted(s.lower().split())) for s in (a, b))
        return 200.0 * lcs(a, b) / (len(a) + len(b))

    assert got == [expected(*p) for p in pairs]
    assert got[:2] == [100.0, 100.0]


CAND = "query STRING, pos BIGINT, id STRING, name STRING, type STRING, country STRING, score INT, life_span_begin STRING, disambiguation STRING"


def test_landed_candidates(spark):
    rows = [
        ("a b", 0, "p", "A B", "Person", None, 100, None, None),
        ("a b", 1, "g", "A C", "Group", "SE", 10, "1999-01", None),
        ("solo", 0, "s1", "Solo", "Person", None, None, "2026", "x"),
        ("solo", 1, "s2", "Solo!", None, None, 0, None, None),
        ("tie", 0, "t1", "Tie", "Group", None, 50, None, None),
        ("tie", 1, "t2", "Tie", "Group", None, 50, None, None),
    ]
    names = spark.createDataFrame([("a b",), ("solo",), ("tie",), ("nobody",), ("",), (None,)], "lastfm_name STRING")
    out = linkage.match_landed(names, spark.createDataFrame(rows, CAND)).collect()
    got = {r["lastfm_name"]: (r["match"]["mbid"] if r["match"] else None, r["resolution_status"]) for r in out}
    assert got == {"a b": ("g", "rejected"), "solo": ("s1", "auto_accepted"), "tie": ("t1", "auto_accepted"), "nobody": (None, "rejected")}
    years = {r["lastfm_name"]: r["match"] and r["match"]["formed_year"] for r in out}
    assert years == {"a b": 1999, "solo": None, "tie": None, "nobody": None}


def one_step(q, e):
    """The candidate rule, by brute force over token-sorted names."""
    if q == e:
        return True
    less = lambda s: {s[:i] + s[i + 1 :] for i in range(len(s))}
    if q in less(e) or e in less(q):
        return True
    if len(q) == len(e) and less(q) & less(e):
        return True
    drop = lambda s: {" ".join(t[:i] + t[i + 1 :]) for t in [s.split(" ")] for i in range(len(t)) if len(t) > 1}
    return q in drop(e) or e in drop(q)


def test_name_pairs_equal_brute_force(spark):
    names = ["".join(p) for p in itertools.product("ab ", repeat=4)] + ["the cold band", "cold band", "cold the band", "slipknot", "slipkont", "a", ""]
    names = sorted({" ".join(sorted(n.split())) for n in names} - {""})
    q = spark.createDataFrame([(n,) for n in names], "q STRING")
    e = spark.createDataFrame([(n,) for n in names], "e STRING")
    got = {tuple(r) for r in linkage.name_pairs(q, e).collect()}
    assert got == {(a, b) for a in names for b in names if one_step(a, b)}
    scored = linkage.name_pairs(q, e).select("q", "e", linkage.pair_score(F.col("q"), F.col("e")).alias("s")).collect()
    assert all(abs(r["s"] - 200.0 * lcs(r["q"], r["e"]) / (len(r["q"]) + len(r["e"]))) < 1e-9 for r in scored)


def test_common_token_makes_no_pairs(spark):
    """Ten thousand names that share a token and differ elsewhere stay ten thousand separate names."""
    n = 10_000
    names = spark.range(n).select(F.concat(F.lit("band "), F.sha1(F.col("id").cast("string"))).alias("q"))
    pairs = linkage.name_pairs(names, names.select(F.col("q").alias("e")))
    assert pairs.count() == n


def test_exact_lookup_comes_before_folded(spark, rows):
    asked = spark.createDataFrame([("Abc",), ("ABC",), ("x",)], "lastfm_name STRING")
    lookup = spark.createDataFrame([("Abc", 1, 0), ("abc", 2, 1), ("Abc", 3, 2), ("aBC", 4, 3)], "lastfm_name STRING, v INT, _seq INT")
    assert rows(merge.exact_then_folded(asked, lookup, "lastfm_name", ["_seq"])) == [("ABC", 4), ("Abc", 3), ("x", None)]


def test_every_name_comes_out_of_linking(spark):
    names = spark.createDataFrame([("   ",), ("The Cold Band",), ("far away",), ("",), (None,)], "lastfm_name STRING")
    known = spark.createDataFrame(
        [("2", "cold band", "Person", "SE", "1999"), ("1", "Band Cold", "Group", "US", "1950"), ("3", "\t", None, None, None)],
        "id STRING, name STRING, type STRING, country STRING, life_span_begin STRING",
    )
    got = {r["lastfm_name"]: (r["mbid"], r["similarity_score"], r["resolution_status"]) for r in linkage.link_names(names, known).collect()}
    assert got == {"   ": ("3", 100.0, "auto_accepted"), "The Cold Band": ("1", 81.82, "review_required"), "far away": (None, None, "not_compared")}
