import collections
import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from bandstand.llm.line_dedup import LineRules, drop_frequent_lines
from bandstand.llm.mixing import Mix, mix_plan, mixed
from bandstand.llm.order_minhash import OrderMinHash, fingerprints
from bandstand.llm.private_data import KINDS, _with_candidates, base_spans, em_posteriors, fit_logistic, private_spans, span_text

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_lines_against_a_plain_loop(clashing, odd_rows):
    def key(line):
        return re.sub("[A-Z]", lambda m: m.group().lower(), line.strip(" \t\n\x0b\x0c\r"))

    rules = LineRules(min_docs=5, batches=3, fan=2)
    texts = [t or "" for _, t, *_ in odd_rows]
    seen = collections.Counter(k for t in texts for k in {key(x) for x in t.split("\n")})
    want = []
    for (d, *_), t in zip(odd_rows, texts):
        lines = t.split("\n")
        kept = [x for x in lines if not key(x) or seen[key(x)] < rules.min_docs]
        want.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    got = drop_frequent_lines(clashing, "doc_id", "text", rules)
    assert sorted(map(tuple, got.select("doc_id", "n_lines", "n_dropped", "kept_text").collect()), key=str) == sorted(want, key=str)
    assert {"rep", "node", "key", "_doc", "lang"} <= set(got.columns) and sum(w[2] for w in want) >= 26
    assert drop_frequent_lines(clashing.where("false"), "doc_id", "text", rules).count() == 0


@pytest.fixture(scope="module")
def plan(clashing):
    return mix_plan(clashing, "doc_id", "text", "source", Mix(group=4)).collect()


def test_targets_and_takes(plan, odd_rows):
    sizes = collections.Counter()
    for _, t, _, s, _ in odd_rows:
        sizes[s] += len(WORD.findall(t or ""))
    names = sorted(s for s in sizes if s is not None) + [None]
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    target, left, free = dict.fromkeys(names, 0.0), float(sum(sizes.values())), set(names)
    while free and left > 1e-9:
        share = left / sum(weight[s] for s in free)
        left = 0.0
        for s in list(free):
            target[s] += share * weight[s]
            if target[s] >= 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
                free.discard(s)
    assert len(plan) == len(odd_rows)
    for r in plan:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        factor = r.target / r.source_size if r.source_size else 0
        assert r.taken == r.copies * r.size and (r.copies in (int(factor), int(factor) + 1, 3) or r.size == 0) and r.copies <= 3


def test_takes_are_near_the_target(spark):
    rng = random.Random(3)
    rows = [(k, "w " * rng.randint(1, 300), rng.choice(["a", "b", "c", "d", "e"])) for k in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    one = {r.doc_id: r for r in mix_plan(docs, "doc_id", "text", "source").collect()}
    for source in "abcde":
        own = [r for r in one.values() if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 0.01 * own[0].target
    again = {r.doc_id: r.copies for r in mix_plan(docs.repartition(7, "text"), "doc_id", "text", "source").collect()}
    assert again == {d: r.copies for d, r in one.items()}


def test_mixed_rows(clashing):
    taken = {(r.doc_id, r.source, r.th): r.n for r in mix_plan(clashing, "doc_id", "text", "source").groupBy("doc_id", "source", "th").agg(F.sum("copies").alias("n")).collect()}
    rows = mixed(clashing, "doc_id", "text", "source")
    assert rows.columns == clashing.columns
    got = rows.groupBy("doc_id", "source", F.xxhash64(F.coalesce("text", F.lit(""))).alias("th")).agg(F.count("*").alias("n")).collect()
    assert {(r.doc_id, r.source, r.th): r.n for r in got} == {k: n for k, n in taken.items() if n}
    empty = clashing.where("false")
    assert mixed(empty, "doc_id", "text", "source").count() == 0 and mix_plan(empty, "doc_id", "text", "source").count() == 0


def test_fingerprints(clashing, odd_rows):
    got = fingerprints(clashing, "doc_id", "text", OrderMinHash()).collect()
    assert len(got) == len(odd_rows)
    # Repeats of an id and a text are one document of the order.
    order = sorted({(d is None, d or 0, t or "") for d, t, *_ in odd_rows if not (d == 12 or d is None)})
    by_id = collections.defaultdict(list)
    for r in got:
        by_id[r.doc_id].append(r)
    for k, (_, d, t) in enumerate(order[:10]):
        following = order[k + 1][2]
        n = len(t) // 4
        r = by_id[d][0]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256((t[: len(t) - n] + following[:n]).encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert by_id[0][0].fingerprint == by_id[1][0].fingerprint and by_id[0][0].near_next == 1.0
    assert by_id[1][0].near_edited < 1 and by_id[10][0].near_edited > 0.1
    assert fingerprints(clashing.where("false"), "doc_id", "text").count() == 0


def test_texts_without_blanks_have_kmers(spark):
    rng = random.Random(8)
    han = lambda n: "".join(chr(rng.randint(0x4E00, 0x9F00)) for _ in range(n))
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    texts = [
        han(2000),
        "\u3002".join(han(9) for _ in range(200)),
        "\n".join(word() for _ in range(400)),
        "\t".join(word() for _ in range(400)),
        "".join(word() for _ in range(400)),
        "\n".join("https://example.com/" + word() + word() for _ in range(100)),
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in fingerprints(docs, "doc_id", "text").collect()}
    assert all(0.1 < got[i].near_edited < 0.9 for i in range(len(texts)))
    assert all("-" not in got[i].fingerprint for i in range(len(texts)))


def test_order_counts(spark):
    """Moved text lowers the likeness although the k-mers stay nearly the same."""
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdef") for _ in range(5)) for _ in range(400)]
    rows = [(0, " ".join(words)), (1, " ".join(words)), (2, " ".join(words[200:] + words[:200])), (3, " ".join(reversed(words)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    near = {r.doc_id: r.near_next for r in fingerprints(docs, "doc_id", "text").collect()}
    assert near[0] == 1.0 and 0.2 < near[1] < 0.9 and near[2] < 0.1


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base(text):
    out = []
    for place, kind in enumerate(KINDS):
        for m in re.finditer(PATTERNS[kind], text):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((m.start(), place, m.end()))
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(out))


def test_fixed_patterns_against_python(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choice("a1.@- +(2é%4") for _ in range(rng.randint(0, 60))) for _ in range(600)]
    texts += ["x@y@z.w a@b.c%d@e.f", "1.2.3.4.5 001.02.255.0 1.2.3.256 9999999999999.1.1.1", "+1 (988) 555-2485 +12 3", "4111 1111-1111 1111", "4111111111111112", "a@" + "b." * 20000 + "c", "1-" * 20000 + "1", "a" * 50000 + " é 4242424242424242"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    got = private_spans(docs, "doc_id", "text").select("doc_id", span_text(F.col("base")).alias("spans")).collect()
    assert {r.doc_id: r.spans for r in got} == {k: base(t) for k, t in enumerate(texts)}


def test_secrets_are_added_and_plain_text_is_left_alone(spark):
    rng = random.Random(8)
    hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(24)) + "a1" for _ in range(30)]
    keys = ["AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(15)) + "7" for _ in range(30)]
    secret = [f'é password={h} then' for h in hexes[:10]] + [f'token = "{h}"' for h in hexes[10:]] + [f"and {k} here" for k in keys]
    plain = ["under the Apache License, Version 2.0.", "call 555-24851 or part-number-12", "number 4111111111111112 fails", "chapter12 of volume34"] * 20
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(secret + plain)], "doc_id long, text string")
    rows = {r.doc_id: r for r in private_spans(docs, "doc_id", "text").collect()}
    for k, text in enumerate(secret):
        assert [text[x.start : x.end] for x in rows[k].added] == [x for x in hexes + keys if x in text]
    assert all(not rows[len(secret) + k].added for k in range(len(plain)))


def test_values_numbers_and_addresses(spark):
    rng = random.Random(9)
    digits = lambda n: "".join(rng.choice("123456789") for _ in range(n))
    planted = []
    for k in range(40):
        phone, ident = f"({digits(3)}) {digits(3)}-{digits(4)}", f"{digits(3)}-{digits(2)}-{digits(4)}"
        street, word = f"{digits(3)} North {rng.choice(['Hill', 'Mill'])} {rng.choice(['Road', 'Street', 'Ave'])}", "q" + digits(2) + "!w"
        planted += [(f"é so call {phone} today", phone), (f"her ssn is {ident} and", ident), (f"I live at {street} now", street)]
        planted += [(f"my password is {word}", word), (f"Password: {word}, then", word), (f"pwd={word}; x", word)]
    clean = [
        "the war of 1914-1918 and 2024-05-06 at noon",
        "page 12 34 of volume 3",
        "she forgot the password and went home",
        "a walk along 12 Long Lane Market",
        "in 10 20 30 years",
        "see ISBN 978 0306 40615",
    ] * 20
    docs = spark.createDataFrame([(k, t) for k, t in enumerate([t for t, _ in planted] + clean)], "doc_id long, text string")
    rows = {r.doc_id: r for r in private_spans(docs, "doc_id", "text").collect()}
    caught = [span in [text[x.start : x.end] for x in rows[k].added] for k, (text, span) in enumerate(planted)]
    assert sum(caught) >= 0.9 * len(planted)
    assert all(not rows[len(planted) + k].added for k in range(len(clean)))


def test_candidates_touch_no_span(spark):
    rng = random.Random(10)
    texts = [" ".join(rng.choice(["10.0.0.1", "a1b2c3d4e5", "a@b.co", "pwd=x1@b.co", "555-010-2030", "w"]) for _ in range(rng.randint(0, 40))) for _ in range(200)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    for r in _with_candidates(docs.withColumn("base", base_spans(F.col("text")))).collect():
        spans = sorted([(b.start, b.end) for b in r.base] + [(c.start, c.end) for c in r.c])
        own = sorted((c.start, c.end) for c in r.c)
        assert all(r.text[c.start : c.end] == c.token for c in r.c)
        assert all(not (a < y and x < b) for a, b in own for x, y in [(s.start, s.end) for s in r.base])
        assert all(b <= x for (_, b), (x, _) in zip(own, own[1:])) and len(spans) == len(r.base) + len(r.c)
        # Nothing apart from all others is lost.
        for m in re.finditer(r"(?<!\S)a1b2c3d4e5(?!\S)", r.text):
            assert (m.start(), m.end()) in own


def test_long_texts_take_linear_time(spark):
    def seconds(n):
        docs = spark.createDataFrame([(1, "ab12cd34ef 10.0.0.1 " * n)], "doc_id long, text string")
        began = time.perf_counter()
        (row,) = private_spans(docs, "doc_id", "text").collect()
        assert len(row.base) == n
        return time.perf_counter() - began

    seconds(10)
    small, large = seconds(12_500), seconds(50_000)  # the larger one has a million characters
    assert large < 6 * small + 2


def test_odd_rows_have_spans_or_none(clashing, odd_rows):
    got = private_spans(clashing, "doc_id", "text").collect()
    assert len(got) == len(odd_rows) and [len(r.base) for r in got if r.doc_id == 13] == [4]
    assert private_spans(clashing.where("false"), "doc_id", "text").count() == 0


def test_reliabilities_follow_agreement():
    likely, right = em_posteriors([((1, 1, 0), 50), ((0, 0, 1), 50), ((1, 0, 1), 2), ((0, 0, 0), 10)], [1, 1, 0])
    assert likely[0] > 0.9 and likely[1] < 0.4 and all(0.6 < r <= 0.99 for r in right)
    weights = fit_logistic([((1, 0), 1.0, 10), ((0, 1), 0.0, 10)])
    assert weights[0] > 0 > weights[1] and fit_logistic([]) == []
