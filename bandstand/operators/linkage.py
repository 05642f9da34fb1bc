"""Record linkage: the best external entity for each artist name.

With landed search results, ``match_landed`` grades the best candidate of each query. Without them,
``name_pairs`` finds candidates by a fixed rule whose fan-out is bounded: two names are candidates when
their token-sorted forms are equal, differ by one character (left out, changed or moved), or differ by
one whole token. Each of these is an equality of derived keys, so one equi-join finds every such pair. A key
is a name with at most one character or token left out: the names that share it are as many as there are
places and characters, whatever the size of the tables, so no common token forms a group of pairs and
nothing is capped. Names are reduced to distinct ones first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bandstand.functions.dates import life_span_year
from bandstand.functions.ranking import first_per_key
from bandstand.functions.similarity import sorted_tokens, token_sort_ratio
from bandstand.functions.tiers import match_status
from bandstand.settings import DEFAULTS, Settings

NOT_COMPARED = "not_compared"

def group_first(type_column: str = "type") -> Column:
    return F.coalesce(F.col(type_column) == "Group", F.lit(False)).desc()


def best_candidate(candidates: DataFrame) -> DataFrame:
    """Per query: groups before anything else, then the highest search score, then the first one."""
    return first_per_key(candidates, ["query"], [group_first(), F.coalesce("score", F.lit(0)).desc(), F.col("pos")])


def match_landed(names: DataFrame, candidates: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Grade the best landed candidate of each distinct name; names without one come out rejected."""
    queries = names.where(F.coalesce("lastfm_name", F.lit("")) != "").select("lastfm_name").distinct()
    best = best_candidate(candidates)
    found = queries.join(best, queries["lastfm_name"] == best["query"], "left")
    score = token_sort_ratio(F.col("lastfm_name"), F.coalesce("name", F.lit("")))
    graded = found.withColumn("_score", F.when(F.col("query").isNotNull(), score))
    match = F.when(
        F.col("query").isNotNull(),
        F.struct(
            F.col("id").alias("mbid"),
            F.col("name").alias("mb_name"),
            "type",
            "country",
            life_span_year(F.col("life_span_begin"), s.first_year, s.last_structured_year).alias("formed_year"),
            F.coalesce("disambiguation", F.lit("")).alias("disambiguation"),
            F.coalesce("score", F.lit(0)).alias("mb_score"),
            F.bround("_score", 2).alias("similarity_score"),
        ),
    )
    return graded.select("lastfm_name", match.alias("match"), match_status(F.col("_score"), s).alias("resolution_status"))


def spread_match(matches: DataFrame) -> DataFrame:
    """The landed metadata rows: match fields beside the name, unmatched names left out."""
    return matches.where(F.col("match").isNotNull()).select("lastfm_name", "match.*", "resolution_status")


def _without_token(c: Column) -> Column:
    """Every form of a name with one of its several tokens left out."""
    tokens = F.split(c, " ")
    places = F.sequence(F.lit(1), F.size(tokens))
    shorter = F.transform(
        places, lambda i: F.array_join(F.filter(tokens, lambda _, at: at + 1 != i), " ")
    )
    return F.when(F.size(tokens) > 1, F.array_distinct(shorter)).otherwise(F.array().cast("array<string>"))


def _without_char(c: Column) -> Column:
    places = F.sequence(F.lit(1), F.length(c))
    return F.transform(places, lambda i: F.concat(c.substr(F.lit(1), i - 1), c.substr(i + 1, F.length(c))))


def _keyed(names: DataFrame, column: str, query_side: bool) -> DataFrame:
    """Join keys ``k`` of each name. A query key and an entity key are equal exactly when a rule holds.

    Rule ``f``: the names are equal; ``d``: equal when each leaves out one character; ``x`` and ``y``: the
    query (the entity) without a character is the other name; ``t`` and ``u``: the same without a token.
    """
    c, i = F.col(column), F.col("_i")
    own, other = ("x", "y") if query_side else ("y", "x")
    own_token, other_token = ("t", "u") if query_side else ("u", "t")

    def key(*parts) -> Column:
        return F.xxhash64(F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]))

    less = F.concat(c.substr(F.lit(1), i - 1), c.substr(i + 1, F.length(c)))
    at_place = F.array(key("d", less), key(own, less))
    whole = F.concat(
        F.array(key("f", c), key(other, c), key(other_token, c)),
        F.transform(_without_token(c), lambda v: key(own_token, v)),
    )
    # Place 0 stands for the whole name, the others for the name without that character.
    places = _spread(names, column).select(column, F.explode(F.sequence(F.lit(0), F.length(c))).alias("_i"))
    return places.select(column, F.explode(F.when(i == 0, whole).otherwise(at_place)).alias("k"))


def _spread(names: DataFrame, column: str) -> DataFrame:
    """Deal the names out anew; adaptive execution chooses the number of tasks and splits large ones."""
    return names.select(column).hint("rebalance", column)


def name_pairs(queries: DataFrame, entities: DataFrame) -> DataFrame:
    """Candidate pairs ``q, e`` of distinct token-sorted names (columns ``q`` and ``e`` in)."""
    left, right = _keyed(queries, "q", True), _keyed(entities, "e", False)
    # Exploded keys are many times larger than their table's size estimate: never broadcast them.
    pairs = left.join(right.hint("merge"), "k").select("q", "e")
    # Equal hashes of different keys are told apart here.
    one_char = F.levenshtein("q", "e", 1) >= 0
    moved = (F.length("q") == F.length("e")) & F.arrays_overlap(_without_char(F.col("q")), _without_char(F.col("e")))
    one_token = F.array_contains(_without_token(F.col("q")), F.col("e")) | F.array_contains(
        _without_token(F.col("e")), F.col("q")
    )
    return pairs.where(one_char | one_token | moved).distinct()


def pair_score(q: Column, e: Column) -> Column:
    """Indel ratio of a candidate pair. By the rules the shorter name is a subsequence of the longer one, or
    both have the same length and lose one character each, so the common subsequence needs no search."""
    differs = ((F.length(q) == F.length(e)) & (q != e)).cast("int")
    shared = F.least(F.length(q), F.length(e)) - differs
    total = F.length(q) + F.length(e)
    return F.when(total == 0, F.lit(100.0)).otherwise(F.lit(200.0) * shared / F.nullif(total, F.lit(0)))


def link_names(names: DataFrame, entities: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Best entity per artist name by the candidate rule: groups first, then similarity.

    ``entities`` has ``id, name, type, country, life_span_begin``. Every name comes out. The rule is narrower than the
    ratio: a name that it brings no entity is ``not_compared``, which says nothing about how similar others are.
    """
    named = names.where(F.coalesce("lastfm_name", F.lit("")) != "").select("lastfm_name").distinct()
    queries = named.withColumn("q", sorted_tokens(F.col("lastfm_name")))
    known = first_per_key(
        entities.where(F.coalesce("name", F.lit("")) != "").withColumn("e", sorted_tokens(F.col("name"))),
        ["e"],
        [group_first(), F.col("id")],
    )
    pairs = name_pairs(queries.select("q").distinct(), known.select("e"))
    scored = pairs.withColumn("_score", pair_score(F.col("q"), F.col("e"))).join(known, "e")
    best = first_per_key(scored, ["q"], [group_first(), F.col("_score").desc(), F.col("e"), F.col("id")])
    return queries.join(best, "q", "left").select(
        "lastfm_name",
        F.col("id").alias("mbid"),
        F.col("name").alias("mb_name"),
        "type",
        "country",
        life_span_year(F.col("life_span_begin"), s.first_year, s.last_structured_year).alias("formed_year"),
        F.bround("_score", 2).alias("similarity_score"),
        F.when(F.col("_score").isNull(), NOT_COMPARED).otherwise(match_status(F.col("_score"), s)).alias("resolution_status"),
    )
