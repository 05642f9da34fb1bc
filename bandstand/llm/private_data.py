"""Personal data and secrets by weak supervision. DataFrame functions only.

Four kinds have fixed patterns: their matches are always spans. Beyond these there are four kinds of candidates: what is
assigned to a password or key, street addresses, grouped numbers (local phone numbers, identity and account numbers),
and longer runs of letters, digits and joining signs that hold a digit. Names of persons alone are no candidates.
Labelers look at each: patterns of its own shape, word lists for its start and the words before it, and signs around
it; each votes for, against or not at all. The votes of all candidates are counted by pattern, expectation-maximisation estimates how reliable each labeler is and how
likely each pattern is private, and a logistic classifier over the candidates' own features and votes is trained on
those likelihoods. Only the table of patterns, whose size is bounded by the labelers, leaves the cluster.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, functions as F

from bandstand.runtime import Scratch

# The contract's patterns, in its order of kinds: fixed values. Quantifiers that never need to give back are possessive,
# and an e-mail address may only begin where a run begins or the last match ended; the matches are the same, and no
# text makes them slow.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SECRET = "secret"
_FOUND_KIND = "struct<start:bigint,end:bigint,token:string,before:string,kind:string>"
BEFORE = 32  # code points before a candidate that its labelers see

# Word lists of the labelers.
KEY_WORDS = ("password", "passwd", "passphrase", "pwd", "secret", "token", "apikey", "api_key", "api-key", "access_key", "auth", "bearer", "credential")
KEY_STARTS = ("AKIA", "ASIA", "ghp_", "gho_", "sk-", "pk-", "xoxb-", "xoxp-", "AIza", "eyJ")
PLAIN_WORDS = ("version", "license", "licence", "gpl", "cc", "rfc", "iso", "isbn", "page", "chapter", "vol", "no")


ASSIGNED_WORDS = ("password", "passwd", "passphrase", "pwd", "apikey", "api_key", "api-key", "api key", "access_key", "access key", "client_secret", "pin code")
CONTACT_WORDS = ("tel", "phone", "telephone", "mobile", "cell", "fax", "call", "whatsapp", "text me", "contact", "reach me")
IDENTITY_WORDS = ("ssn", "social security", "passport", "national id", "identity card", "id card", "tax id", "driving licence", "driver's license", "account", "iban")
NUMBER_DIGITS = 9  # grouped numbers with fewer digits (dates, spans of years) are no candidates of their own
HOME_WORDS = ("address", "live", "lives", "lived", "living", "residing", "resident", "home", "mail", "ship", "deliver")
STREETS = ("Street", "St", "Avenue", "Ave", "Road", "Rd", "Lane", "Ln", "Drive", "Boulevard", "Blvd", "Court", "Terrace", "Crescent")


def _any_of(words: tuple[str, ...]) -> str:
    return "(?:" + "|".join(words) + ")"


_ASSIGNED = rf"(?i)(?<![A-Za-z0-9]){_any_of(ASSIGNED_WORDS)}[\"']?\s*+(?:[:=]|is\s++(?=\S*?[0-9!@#$%^&*]))\s*+[\"']?"
# Kinds of candidates by precedence: a later kind leaves out what touches an earlier one or a base span.
CANDIDATES = {
    "value": rf"{_ASSIGNED}[^\s\"',;]{{4,}}+",
    "address": rf"(?<![A-Za-z0-9])[0-9]{{1,5}}[A-Za-z]? (?:[A-Z][a-z]++ ){{1,3}}{_any_of(STREETS)}\b",
    "number": r"(?<![A-Za-z0-9+.,/-])\(?[0-9]{2,5}\)?(?:[ .-][0-9]{2,5}){1,4}+(?![A-Za-z0-9/-]|[.,][0-9])",
    "token": r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{8,}+",
}


@dataclass(frozen=True)
class Labeler:
    """A vote (1 for, 0 against) and the condition on a candidate that casts it: its token and the text before it.

    ``kinds``: the kinds of candidates it looks at.
    """

    name: str
    vote: int
    casts: Callable[[Column, Column], Column]
    kinds: tuple[str, ...] = ("token", "value")


def _follows(words: tuple[str, ...], before: Column) -> Column:
    """One of the words stands shortly before the candidate."""
    return before.rlike(rf"(?i)\b{_any_of(words)}\b[^.;\n]{{0,16}}$")


_PHONE_SHAPE = r"^\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}$"
_IDENTITY_SHAPE = "^[0-9]{3}-[0-9]{2}-[0-9]{4}$"
LABELERS = (
    Labeler("capital_key", 1, lambda token, before: token.rlike("^[A-Z]{3,5}[A-Z0-9]{12,}$")),
    Labeler("long_hex", 1, lambda token, before: token.rlike("^(?=.*[0-9])(?=.*[a-f])[0-9a-f]{16,}$")),
    Labeler("mixed_long", 1, lambda token, before: (F.length(token) >= 20) & token.rlike("[A-Z]") & token.rlike("[a-z]")),
    Labeler("plain_number", 0, lambda token, before: token.rlike("^[0-9/_-]+$"), ("token",)),
    Labeler("word_and_number", 0, lambda token, before: token.rlike("^[A-Z]?[a-z]+[0-9]{1,4}$"), ("token",)),
    Labeler("key_word", 1, lambda token, before: before.rlike(rf"(?i){_any_of(KEY_WORDS)}[\"']?\s*[:=]?\s*[\"']?$")),
    Labeler("key_start", 1, lambda token, before: token.rlike(f"^{_any_of(KEY_STARTS)}")),
    Labeler("plain_word", 0, lambda token, before: before.rlike(rf"(?i)\b{_any_of(PLAIN_WORDS)}\.?\s+$"), ("token", "number")),
    Labeler("assigned", 1, lambda token, before: before.rlike(r"[=:]\s*[\"']?$")),
    Labeler("hyphenated", 0, lambda token, before: token.rlike("^[A-Za-z]+(-[A-Za-z0-9]+)+$"), ("token",)),
    Labeler("account_shape", 1, lambda token, before: token.rlike("^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$"), ("token",)),
    Labeler("letters_only", 0, lambda token, before: token.rlike(r"^\p{L}+[.!?)]*$"), ("value",)),
    Labeler("contact_word", 1, lambda token, before: _follows(CONTACT_WORDS, before), ("number",)),
    Labeler("identity_word", 1, lambda token, before: _follows(IDENTITY_WORDS, before), ("number",)),
    Labeler("phone_shape", 1, lambda token, before: token.rlike(_PHONE_SHAPE), ("number",)),
    Labeler("identity_shape", 1, lambda token, before: token.rlike(_IDENTITY_SHAPE), ("number",)),
    Labeler("bare_number", 0, lambda token, before: ~_follows((*CONTACT_WORDS, *IDENTITY_WORDS), before) & ~token.rlike(f"{_PHONE_SHAPE}|{_IDENTITY_SHAPE}"), ("number",)),
    Labeler("home_word", 1, lambda token, before: _follows(HOME_WORDS, before), ("address",)),
    Labeler("bare_place", 0, lambda token, before: ~_follows(HOME_WORDS, before), ("address",)),
)
# Features of the classifier besides the votes and the kind.
FEATURES: dict[str, Callable[[Column], Column]] = {
    "long": lambda token: F.length(token) >= 16,
    "very_long": lambda token: F.length(token) >= 32,
    "many_digits": lambda token: F.length(F.regexp_replace(token, "[^0-9]", "")) * 4 >= F.length(token),
    "all_digits": lambda token: token.rlike("^[0-9]+$"),
    "capitals": lambda token: token.rlike("[A-Z].*[A-Z].*[A-Z]"),
    "joined": lambda token: token.rlike("[+/_-]"),
}


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Running totals of an array under an associative ``join``: at each step an entry takes in the one 1, 2, 4, ... places
    before it, so a long array takes as many steps as its length has bits."""
    steps = F.transform(F.sequence(F.lit(0), F.length(F.bin(F.size(values)))), lambda k: F.call_function("shiftleft", F.lit(1), k))
    return F.aggregate(
        steps,
        values,
        lambda acc, step: F.transform(acc, lambda x, i: F.when(i >= step, join(x, F.get(acc, i - step))).otherwise(x)),
    )


def _located(text: Column, pattern: str) -> Column:
    """Matches of the pattern: ``start, end`` in code points, the match and the text before it."""
    pieces, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    zipped = F.zip_with(pieces, found, lambda piece, token: F.struct(piece.alias("piece"), token.alias("token")))

    def placed(matches: Column) -> Column:
        widths = F.transform(matches, lambda x: (F.char_length(x["piece"]) + F.char_length(x["token"])).cast("bigint"))
        ends = _let(widths, lambda w: _running(w, lambda x, earlier: x + earlier))
        return F.zip_with(
            matches,
            ends,
            lambda x, end: F.struct(
                (end - F.char_length(x["token"])).alias("start"),
                end.alias("end"),
                x["token"].alias("token"),
                F.right(x["piece"], F.lit(BEFORE)).alias("before"),
            ),
        )

    return _let(F.filter(zipped, lambda x: x["token"].isNotNull()), placed)


def _passes(kind: str, token: Column) -> Column:
    digits = F.regexp_replace(token, "[^0-9]", "")
    if kind == "ip":
        parts = F.transform(F.split(token, r"\."), lambda x: F.regexp_replace(x, "^0+(?=.)", ""))
        return F.forall(parts, lambda x: (F.length(x) < 3) | ((F.length(x) == 3) & (x <= "255")))
    if kind == "card":
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Matches of the fixed patterns as an array of ``start, place, end`` in the order of the contract."""
    has_digit = text.rlike("[0-9]")
    worth = {"email": F.contains(text, F.lit("@")), "ip": has_digit, "card": has_digit, "phone": F.contains(text, F.lit("+"))}
    empty = F.array().cast("array<struct<start:bigint,place:int,end:bigint>>")

    def of(place: int, kind: str) -> Column:
        good = F.filter(_located(text, PATTERNS[kind]), lambda x: _passes(kind, x["token"]))
        spans = F.transform(good, lambda x: F.struct(x["start"].alias("start"), F.lit(place).alias("place"), x["end"].alias("end")))
        return F.when(worth[kind], spans).otherwise(empty)

    return F.array_sort(F.concat(*[of(place, kind) for place, kind in enumerate(KINDS)]))


def count_of(base: Column, kind: str) -> Column:
    place = KINDS.index(kind)
    return F.size(F.filter(base, lambda x: x["place"] == place)).cast("long")


def _apart(found: Column, taken: Column) -> Column:
    """The entries of ``found`` that touch no span of ``taken`` (``start, end``); both are columns.

    All ends of candidates and starts of spans are put in one order; a candidate is touched if a span that starts before
    its end reaches beyond its start, that is, if the running maximum of the spans' ends does.
    """
    starts = F.transform(
        taken,
        lambda b: F.struct(
            b["start"].alias("at"), F.lit(1).alias("side"), b["end"].alias("reach"), F.lit(None).cast(_FOUND_KIND).alias("c")
        ),
    )
    ends = F.transform(
        found, lambda x: F.struct(x["end"].alias("at"), F.lit(0).alias("side"), F.lit(0).cast("bigint").alias("reach"), x.alias("c"))
    )

    def untouched(events: Column) -> Column:
        reach = _let(F.transform(events, lambda e: e["reach"]), lambda r: _running(r, lambda x, earlier: F.greatest(x, earlier)))
        return F.zip_with(events, reach, lambda e, r: F.when((e["side"] == 0) & (r <= e["c"]["start"]), e["c"]))

    apart = F.filter(_let(F.array_sort(F.concat(starts, ends)), untouched), lambda c: c.isNotNull())
    return F.when((F.size(found) == 0) | (F.size(taken) == 0), found).otherwise(apart)


def _of_kind(text: Column, kind: str) -> Column:
    """Candidates of one kind, with the kind; of an assignment only the value counts, the rest is text before it."""

    def one(x: Column) -> Column:
        token, start, before = x["token"], x["start"], x["before"]
        if kind == "value":
            token = F.regexp_replace(token, f"^{_ASSIGNED}", "")
            start = x["end"] - F.char_length(token)
            before = F.right(F.substring(x["token"], F.lit(1), F.char_length(x["token"]) - F.char_length(token)), F.lit(BEFORE))
        return F.struct(start.alias("start"), x["end"].alias("end"), token.alias("token"), before.alias("before"), F.lit(kind).alias("kind"))

    none = F.array().cast(f"array<{_FOUND_KIND}>")
    worth = F.lit(True) if kind == "value" else text.rlike("[0-9]")
    found = F.transform(_located(text, CANDIDATES[kind]), one)
    if kind == "number":
        found = F.filter(found, lambda x: F.length(F.regexp_replace(x["token"], "[^0-9]", "")) >= NUMBER_DIGITS)
    return F.when(worth, found).otherwise(none)


def _with_candidates(found: DataFrame) -> DataFrame:
    """Adds ``c`` to ``doc_id, text, base``: candidates of all kinds that touch neither a base span nor one of an earlier kind.

    One column per step: an array that is named several times is worked out once, and no expression nests deeply.
    """

    def spans(c: str) -> Column:
        return F.transform(c, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))

    found = found.withColumn("taken", spans("base"))
    for kind in CANDIDATES:
        found = found.withColumn("found", _of_kind(F.col("text"), kind))
        found = found.withColumn(kind, _apart(F.col("found"), F.col("taken")))
        found = found.withColumn("taken", F.concat("taken", spans(kind)))
    return found.select("doc_id", "text", "base", F.concat(*CANDIDATES).alias("c"))


def em_posteriors(patterns: list[tuple[tuple[int, ...], int]], votes: list[int], rounds: int = 50) -> tuple[list[float], list[float]]:
    """How likely each pattern of cast votes is private, and the share of right votes of each labeler.

    ``patterns``: which labelers voted (0/1 each) and how many candidates did so. The labelers are taken as
    independent given the truth; their shares start at 0.8 and stay between 0.55 and 0.99, and both classes are
    taken as equally frequent: labelers that only ever vote one way cannot tell the frequency from their errors.
    A pattern without votes stays at one half.
    """
    right = [0.8] * len(votes)
    likely = [0.5] * len(patterns)
    for _ in range(rounds):
        for k, (cast, _) in enumerate(patterns):
            score = 0.0
            for j, c in enumerate(cast):
                if c:
                    score += (1 if votes[j] else -1) * math.log(right[j] / (1 - right[j]))
            likely[k] = 1 / (1 + math.exp(-max(-50.0, min(50.0, score))))
        for j, vote in enumerate(votes):
            cast_by = [(n, p if vote else 1 - p) for (cast, n), p in zip(patterns, likely) if cast[j]]
            total = sum(n for n, _ in cast_by)
            agreed = sum(n * p for n, p in cast_by)
            right[j] = min(0.99, max(0.55, (agreed + 8.0) / (total + 10.0)))
    return likely, right


def fit_logistic(rows: list[tuple[tuple[int, ...], float, float]], rounds: int = 300) -> list[float]:
    """Weights (the last one is the bias) for rows of features, likelihood and count; by gradient descent."""
    if not rows:
        return []
    size = len(rows[0][0]) + 1
    weights, total = [0.0] * size, sum(n for _, _, n in rows)
    for _ in range(rounds):
        slope = [0.001 * w for w in weights]
        for features, target, n in rows:
            x = (*features, 1)
            off = 1 / (1 + math.exp(-max(-50.0, min(50.0, sum(w * v for w, v in zip(weights, x)))))) - target
            for j, v in enumerate(x):
                if v:
                    slope[j] += off * n / total
        weights = [w - 2.0 * s for w, s in zip(weights, slope)]
    return weights


def private_spans(docs: DataFrame, id_column: str, text_column: str, least: float = 0.5) -> DataFrame:
    """Per row ``doc_id, base, added``: arrays of ``start, place, end`` and of ``start, end, score``.

    Positions are code points, the end is exclusive; ``place`` is the kind's place in ``KINDS``. Added spans are
    candidates that do not touch a base span and whose score reaches ``least``. A null text is empty and has no spans;
    a null id stays null; rows that repeat are looked at one by one; an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession, "private-data")
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    found = docs.select(F.col(id_column).cast("long").alias("doc_id"), text.alias("text"), base_spans(text).alias("base"))
    # What is kept of a candidate: its place and the bits of votes and features; no text.
    marked = scratch.write(_with_candidates(found).select("doc_id", "base", F.transform("c", _marks).alias("c")))
    counted = marked.select(F.explode("c.bits").alias("bits")).groupBy("bits").agg(F.count("*").alias("n")).orderBy("bits").collect()
    weights = _train(counted)
    if not weights:
        none = F.array().cast("array<struct<start:bigint,end:bigint,score:double>>")
        return marked.select("doc_id", "base", none.alias("added"))

    def scored(x: Column) -> Column:
        total = F.lit(weights[-1])
        for j, w in enumerate(weights[:-1]):
            total = total + F.getbit(x["bits"], F.lit(j)) * w
        return F.struct(x["start"].alias("start"), x["end"].alias("end"), (1 / (1 + F.exp(-total))).alias("score"))

    added = F.filter(F.transform("c", scored), lambda x: x["score"] >= least)
    return marked.select("doc_id", "base", added.alias("added"))


def _marks(x: Column) -> Column:
    """A candidate's place, and its votes and features as bits."""
    total = F.lit(0).cast("long")
    cast = [x["kind"].isin(*labeler.kinds) & labeler.casts(x["token"], x["before"]) for labeler in LABELERS]
    tests = [*cast, *[test(x["token"]) for test in FEATURES.values()], *[x["kind"] == kind for kind in CANDIDATES]]
    for j, test in enumerate(tests):
        total = total + F.when(test, F.lit(1 << j).cast("long")).otherwise(0)
    return F.struct(x["start"].alias("start"), x["end"].alias("end"), total.alias("bits"))


def _train(counted: list[Row]) -> list[float]:
    if not counted:
        return []
    n_votes = len(LABELERS)
    n_bits = n_votes + len(FEATURES) + len(CANDIDATES)
    rows = [(tuple(int(r["bits"]) >> j & 1 for j in range(n_bits)), r["n"]) for r in counted]
    by_votes: dict[tuple[int, ...], int] = {}
    for bits, n in rows:
        by_votes[bits[:n_votes]] = by_votes.get(bits[:n_votes], 0) + n
    patterns = sorted(by_votes.items())
    likely, _ = em_posteriors(patterns, [x.vote for x in LABELERS])
    of = {cast: p for (cast, _), p in zip(patterns, likely)}
    return fit_logistic([(bits, of[bits[:n_votes]], float(n)) for bits, n in rows])


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of spans of ``start, place, end``, comma-joined; kinds beyond the fixed ones are secrets."""
    names = F.array(*[F.lit(k) for k in (*KINDS, SECRET)])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["place"] + 1), x["start"], x["end"])), ",")
