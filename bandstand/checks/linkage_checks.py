"""Lookups, record linkage and the candidate rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from bandstand.checks import shapes
from bandstand.checks.registry import check
from bandstand.checks.shapes import CHECK_SETTINGS as S
from bandstand.checks.shapes import sql, table
from bandstand.checks.source_checks import FILLED_SQL, full_profiles, popularity_records
from bandstand.functions import similarity, tiers
from bandstand.operators import linkage, merge, quality
from bandstand.settings import DEFAULT_COLOR, SUBGENRE_COLORS


def lcs(a: str, b: str) -> str:
    """SQL of the longest common subsequence of two text expressions (row by row over ``a``)."""
    return (
        f"list_reduce(list_transform(string_split({a}, ''), lambda ca: list_transform(string_split({b}, ''), lambda cb: CASE WHEN ca = cb THEN 1 ELSE 0 END)),"
        " lambda prev, hit: list_transform(range(1, len(hit) + 1), lambda j: list_max(list_transform(range(1, j + 1),"
        " lambda k: greatest(prev[k], coalesce(prev[k - 1], 0) + hit[k])))),"
        f" list_transform(string_split({b}, ''), lambda z: 0))[-1]"
    )


def tokens(c: str) -> str:
    return f"array_to_string(list_sort(string_split_regex(lower(trim({c})), '\\s+')), ' ')"


def ratio(a: str, b: str) -> str:
    return f"CASE WHEN {a} = {b} THEN 100.0 ELSE 200.0 * {lcs(a, b)} / (length({a}) + length({b})) END"


def status(score: str) -> str:
    return f"CASE WHEN {score} >= 90 THEN 'auto_accepted' WHEN {score} >= 70 THEN 'review_required' ELSE 'rejected' END"


_BEST = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY coalesce(type = 'Group', false) DESC, coalesce(score, 0) DESC, pos) AS rn FROM candidates) WHERE rn = 1"""


@check("w4_best_candidate", sql("SELECT query, id, name, score FROM best", "candidates", best=_BEST))
def w4(spark, d):
    return linkage.best_candidate(shapes.candidates(spark, d)).select("query", "id", "name", "score")


@check("f11_groups_else_all", sql("""
 SELECT query, bool_or(coalesce(type = 'Group', false)) AS has_group, any_value(best_type) AS best_type FROM candidates JOIN (SELECT query AS q, type AS best_type FROM best) ON q = query GROUP BY 1""",
 "candidates", best=_BEST))
def f11(spark, d):
    rows = shapes.candidates(spark, d)
    best = linkage.best_candidate(rows).select("query", F.col("type").alias("best_type"))
    has = rows.groupBy("query").agg(F.coalesce(F.bool_or(F.col("type") == "Group"), F.lit(False)).alias("has_group"))
    return has.join(best, "query")


_PAIRS = f"SELECT query, {tokens('query')} AS a, {tokens('name')} AS b, b.* EXCLUDE (query) FROM best b"
_SCORED = f"SELECT *, {ratio('a', 'b')} AS s FROM pairs"


@check("fz1_token_sort_ratio", sql("SELECT query, name, round(s, 9) AS score FROM scored", "candidates", best=_BEST, pairs=_PAIRS, scored=_SCORED))
def fz1(spark, d):
    best = linkage.best_candidate(shapes.candidates(spark, d))
    return best.select("query", "name", F.round(similarity.token_sort_ratio(F.col("query"), F.col("name")), 9).alias("score"))


@check("fz2_match_status", "SELECT l_orderkey, l_linenumber, CASE WHEN 50 + l_quantity >= 90 THEN 'auto_accepted' WHEN 50 + l_quantity >= 70 THEN 'review_required' ELSE 'rejected' END AS status FROM lineitem")
def fz2(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", tiers.match_status(50 + F.col("l_quantity"), S).alias("status"))


def part_names(spark, d):
    return table(spark, d, "part").selectExpr(
        "case when p_partkey % 50 = 0 then '' else concat('Part Band ', cast(p_partkey as string)) end as lastfm_name"
    )


_MATCHED = sql(f"""
 SELECT 'Part Band ' || p_partkey AS lastfm_name, id AS mbid, name AS mb_name, type, country,
  CASE WHEN length(life_span_begin) >= 4 AND CAST(left(life_span_begin, 4) AS INTEGER) BETWEEN 1960 AND 2025 THEN CAST(left(life_span_begin, 4) AS INTEGER) END AS formed_year,
  coalesce(score, 0) AS mb_score, round_even(s, 2) AS similarity_score, {status('s')} AS resolution_status
 FROM part LEFT JOIN scored ON query = 'Part Band ' || p_partkey WHERE p_partkey % 50 <> 0""", "candidates", best=_BEST, pairs=_PAIRS, scored=_SCORED)


@check("j8_match_landed_candidates", f"SELECT lastfm_name, mbid, mb_name, formed_year, CASE WHEN mbid IS NOT NULL THEN mb_score END AS mb_score, similarity_score, resolution_status FROM ({_MATCHED})")
def j8(spark, d):
    matches = linkage.match_landed(part_names(spark, d), shapes.candidates(spark, d), S)
    return matches.select(
        "lastfm_name", "match.mbid", "match.mb_name", "match.formed_year", "match.mb_score", "match.similarity_score", "resolution_status"
    )


@check("p11_spread_match", f"SELECT lastfm_name, mbid, mb_name, type, country, formed_year, '' AS disambiguation, mb_score, similarity_score, resolution_status FROM ({_MATCHED}) WHERE mbid IS NOT NULL")
def p11(spark, d):
    return linkage.spread_match(linkage.match_landed(part_names(spark, d), shapes.candidates(spark, d), S))


@check("a11_status_tally", f"SELECT resolution_status, count(*) AS lookups FROM ({_MATCHED}) GROUP BY 1")
def a11(spark, d):
    return quality.status_tally(linkage.match_landed(part_names(spark, d), shapes.candidates(spark, d), S))


@check("f17_unmatched_dropped", f"SELECT count(*) AS names, count(mbid) AS landed FROM ({_MATCHED})")
def f17(spark, d):
    matches = linkage.match_landed(part_names(spark, d), shapes.candidates(spark, d), S)
    return matches.agg(F.count("*").alias("names"), F.count("match.mbid").alias("landed"))


def entities(spark, d):
    return table(spark, d, "part").selectExpr(
        "concat('e', lpad(cast(p_partkey as string), 12, '0')) as id",
        "concat(p_name, ' ', p_type, ' ', p_brand) as name",
        "case when p_size % 4 <> 0 then 'Group' else 'Person' end as type",
        "p_brand as country",
        "cast(1940 + p_size as string) as life_span_begin",
    )


def spelled_names(spark, d):
    """Names with swapped tokens, a lost, added, changed or moved character, a lost or added token, or no match."""
    name = "concat(p_name, ' ', p_type, ' ', p_brand)"
    return table(spark, d, "part").selectExpr(
        f"case p_partkey % 9 when 0 then {name} when 1 then concat('  ', p_brand, ' ', upper(p_type), ' ', p_name)"
        f" when 2 then concat(substr({name}, 1, 3), substr({name}, 5)) when 3 then concat(substr({name}, 1, 5), 'q', substr({name}, 6))"
        f" when 4 then concat(substr({name}, 1, 2), 'z', substr({name}, 4)) when 5 then concat(p_name, ' ', p_brand)"
        f" when 6 then concat('The ', {name})"
        f" when 7 then concat(substr({name}, 1, 1), substr({name}, 3, 1), substr({name}, 2, 1), substr({name}, 4)) else concat('nobody ', cast(p_partkey as string)) end as lastfm_name"
    )


_NAME = "(p_name || ' ' || p_type || ' ' || p_brand)"
_LINK_CTES = dict(
    q=f"""SELECT DISTINCT lastfm_name, {tokens('lastfm_name')} AS q FROM (SELECT CASE p_partkey % 9 WHEN 0 THEN {_NAME} WHEN 1 THEN '  ' || p_brand || ' ' || upper(p_type) || ' ' || p_name
      WHEN 2 THEN left({_NAME}, 3) || substr({_NAME}, 5) WHEN 3 THEN left({_NAME}, 5) || 'q' || substr({_NAME}, 6)
      WHEN 4 THEN left({_NAME}, 2) || 'z' || substr({_NAME}, 4) WHEN 5 THEN p_name || ' ' || p_brand
      WHEN 6 THEN 'The ' || {_NAME} WHEN 7 THEN left({_NAME}, 1) || {_NAME}[3] || {_NAME}[2] || substr({_NAME}, 4) ELSE 'nobody ' || p_partkey END AS lastfm_name FROM part)""",
    e=f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY e ORDER BY type = 'Group' DESC, id) AS rn FROM (
      SELECT 'e' || lpad(CAST(p_partkey AS VARCHAR), 12, '0') AS id, {_NAME} AS name, {tokens(_NAME)} AS e,
       CASE WHEN p_size % 4 <> 0 THEN 'Group' ELSE 'Person' END AS type, p_brand AS country,
       CASE WHEN 1940 + p_size >= 1960 THEN 1940 + p_size END AS formed_year FROM part)) WHERE rn = 1""",
    dropped="""SELECT e, array_to_string(list_concat(t[:i - 1], t[i + 1:]), ' ') AS less FROM (SELECT e, string_split(e, ' ') AS t, unnest(range(1, len(string_split(e, ' ')) + 1)) AS i FROM e)""",
    shorter="""SELECT q, array_to_string(list_concat(t[:i - 1], t[i + 1:]), ' ') AS less FROM (SELECT q, string_split(q, ' ') AS t, unnest(range(1, len(string_split(q, ' ')) + 1)) AS i FROM (SELECT DISTINCT q FROM q)) WHERE len(t) > 1""",
    less_q="SELECT q, left(q, i - 1) || substr(q, i + 1) AS less FROM (SELECT q, unnest(range(1, length(q) + 1)) AS i FROM (SELECT DISTINCT q FROM q))",
    less_e="SELECT e, left(e, i - 1) || substr(e, i + 1) AS less FROM (SELECT e, unnest(range(1, length(e) + 1)) AS i FROM e)",
    pairs="""SELECT l.q, m.e FROM less_q l JOIN less_e m ON m.less = l.less UNION SELECT a.q, b.e FROM (SELECT DISTINCT q FROM q) a JOIN e b ON abs(length(a.q) - length(b.e)) <= 1 AND levenshtein(a.q, b.e) <= 1
      UNION SELECT a.q, x.e FROM q a JOIN dropped x ON x.less = a.q UNION SELECT s.q, b.e FROM shorter s JOIN e b ON b.e = s.less""",
    scored=f"SELECT p.q, p.e, {ratio('p.q', 'p.e')} AS s FROM pairs p",
    best="""SELECT * FROM (SELECT s.q AS bq, s.s, e.*, row_number() OVER (PARTITION BY s.q ORDER BY e.type = 'Group' DESC, s.s DESC, s.e, e.id) AS pick FROM scored s JOIN e ON e.e = s.e) WHERE pick = 1""",
)


@check("j8_link_names", sql(f"""
 SELECT lastfm_name, id AS mbid, name AS mb_name, type, country, formed_year, round_even(s, 2) AS similarity_score,
  CASE WHEN s IS NULL THEN 'not_compared' ELSE {status('s')} END AS resolution_status
 FROM q LEFT JOIN best ON bq = q""", **_LINK_CTES))
def j8_link(spark, d):
    return linkage.link_names(spelled_names(spark, d), entities(spark, d), S)


@check("j4_exact_then_folded", """
 WITH l AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) ELSE p_name END AS k, p_brand FROM part)
 SELECT a.doc_key, a.k AS lastfm_name, coalesce(x.p_brand, f.p_brand) AS brand FROM (SELECT o_orderkey AS doc_key, CASE o_orderkey % 4 WHEN 0 THEN 'COLD widget' WHEN 1 THEN 'COLD WIDGET' WHEN 2 THEN 'cold widget' ELSE 'no such band' END AS k FROM orders) a
 LEFT JOIN (SELECT k, arg_max(p_brand, p_partkey) AS p_brand FROM l GROUP BY k) x ON x.k = a.k
 LEFT JOIN (SELECT lower(k) AS k, arg_max(p_brand, p_partkey) AS p_brand FROM l GROUP BY 1) f ON f.k = lower(a.k)""")
def j4(spark, d):
    asked = table(spark, d, "orders").selectExpr(
        "o_orderkey as doc_key",
        "case o_orderkey % 4 when 0 then 'COLD widget' when 1 then 'COLD WIDGET' when 2 then 'cold widget' else 'no such band' end as lastfm_name",
    )
    lookup = table(spark, d, "part").selectExpr(
        "case when p_partkey % 3 = 0 then upper(p_name) else p_name end as lastfm_name", "p_brand as brand", "p_partkey as _seq"
    )
    return merge.exact_then_folded(asked, lookup, "lastfm_name", ["_seq"])


@check("j4_resolve_profiles", """
 WITH l AS (SELECT upper(p_name) AS k, arg_max(p_partkey, p_partkey) AS pk FROM part GROUP BY 1)
 SELECT a.p_partkey, 's-' || l.pk AS spotify_id, CASE WHEN l.pk % 2 = 0 THEN a.p_name ELSE string_split(a.p_name, ' ')[2] || ' ' || string_split(a.p_name, ' ')[1] END AS spotify_name,
  'auto_accepted' AS entity_resolution_status, CAST(100 AS DOUBLE) AS entity_resolution_score FROM part a JOIN l ON l.k = upper(a.p_name)""")
def j4_profiles(spark, d):
    part = table(spark, d, "part")
    names = part.select("p_partkey", F.col("p_name").alias("lastfm_name"))
    swapped = F.concat(F.split("p_name", " ")[1], F.lit(" "), F.split("p_name", " ")[0])
    profiles = part.select(
        F.upper("p_name").alias("lastfm_name"),
        F.struct(
            F.concat(F.lit("s-"), F.col("p_partkey").cast("string")).alias("id"),
            F.when(F.col("p_partkey") % 2 == 0, F.col("p_name")).otherwise(swapped).alias("name"),
            F.col("p_size").alias("popularity"),
            F.col("p_partkey").alias("followers"),
            F.array("p_type").alias("genres"),
        ).alias("match"),
        F.col("p_partkey").alias("_seq"),
    )
    out = merge.resolve_profiles(names, profiles, ["_seq"], S)
    return out.select("p_partkey", "spotify_id", "spotify_name", "entity_resolution_status", "entity_resolution_score")


@check("j5_features_by_id", """
 SELECT l_orderkey, l_linenumber, CASE WHEN p_size % 9 <> 0 THEN p_size END AS tempo FROM lineitem LEFT JOIN part ON p_partkey = l_partkey""")
def j5(spark, d):
    known = table(spark, d, "part").selectExpr(
        "case when p_size % 9 <> 0 then p_partkey end as id", "p_size as tempo", "p_partkey as _seq"
    )
    tracks = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    out = merge.attach_by_id(tracks, known, "l_partkey", "id", "_audio_features", ["_seq"])
    return out.select("l_orderkey", "l_linenumber", "_audio_features.tempo")


@check("f13_drop_null_lookups", "SELECT count(*) AS lookups, count(p_size) FILTER (p_size % 9 <> 0) AS known FROM part")
def f13(spark, d):
    looked_up = table(spark, d, "part").selectExpr("p_partkey", "case when p_size % 9 <> 0 then named_struct('tempo', p_size) end as features")
    known = looked_up.where(F.col("features").isNotNull()).agg(F.count("*").alias("known"))
    return looked_up.agg(F.count("*").alias("lookups")).withColumn("known", known.scalar())


@check("j6_fill_missing", f"SELECT record, popularity FROM ({FILLED_SQL})")
def j6(spark, d):
    filled = merge.fill_missing(popularity_records(spark, d), full_profiles(spark, d), "id", "popularity")
    return filled.select("record", "popularity")


@check("j7_top_n_membership", sql("""
 SELECT artist_name, CASE WHEN country IN (SELECT country FROM (SELECT country, count(*) AS n FROM features WHERE country IS NOT NULL GROUP BY 1 ORDER BY n DESC, country LIMIT 10)) THEN country ELSE 'Other' END AS country_bucketed FROM features""", "features"))
def j7(spark, d):
    from bandstand.ml import prep

    rows = shapes.features(spark, d)
    return prep.bucket_country(rows, prep.top_values(rows, "country", S.top_countries)).select("artist_name", "country_bucketed")


@check("j9_color_lookup", f"""
 SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN '{SUBGENRE_COLORS["djent"]}' WHEN 1 THEN '{SUBGENRE_COLORS["nu-metal"]}' ELSE '{DEFAULT_COLOR}' END AS color FROM orders""")
def j9(spark, d):
    rows = table(spark, d, "orders").selectExpr(
        "o_orderkey", "case o_orderkey % 3 when 0 then 'djent' when 1 then 'nu-metal' else lower(o_orderpriority) end as subgenre"
    )
    return merge.with_color(rows, SUBGENRE_COLORS, DEFAULT_COLOR).drop("subgenre")


@check("j10_listed_with_info", """
 SELECT c_custkey, s_suppkey FROM (SELECT c_custkey, CASE WHEN c_custkey % 20 = 0 THEN '' ELSE 'band ' || (c_custkey % 400) END AS name FROM customer) c JOIN (SELECT s_suppkey, 'band ' || s_suppkey AS name FROM supplier) s USING (name) WHERE name <> ''""")
def j10(spark, d):
    listed = table(spark, d, "customer").selectExpr(
        "c_custkey", "case when c_custkey % 20 = 0 then '' else concat('band ', cast(c_custkey % 400 as string)) end as name"
    )
    info = table(spark, d, "supplier").selectExpr("s_suppkey", "concat('band ', cast(s_suppkey as string)) as name")
    return merge.info_of_listed(listed, info, ["name"], ["s_suppkey"]).select("c_custkey", "s_suppkey")


def expanded(spark, d):
    artists = table(spark, d, "customer").selectExpr("c_custkey as artist_id", "c_name as artist_name", "lower(c_name) as lastfm_name")
    albums = table(spark, d, "orders").selectExpr(
        "o_custkey as artist_id", "o_orderkey as album_id", "concat('Album ', cast(o_orderkey as string)) as album_name",
        "date_format(o_orderdate, 'yyyy-MM-dd') as release_date",
        "case o_orderstatus when 'F' then 'album' when 'O' then 'single' else 'compilation' end as album_type",
    )
    tracks = table(spark, d, "lineitem").selectExpr("l_orderkey as album_id", "l_linenumber as track", "l_partkey as id")
    return merge.expand_tracks(artists, albums, tracks)


_EXPANDED = """ FROM customer JOIN orders ON o_custkey = c_custkey AND o_orderstatus IN ('F', 'O') JOIN lineitem ON l_orderkey = o_orderkey"""


@check("j11_expand_tracks", f"SELECT lower(c_name) AS lastfm_name, o_orderkey AS album_id, l_linenumber AS track, l_partkey AS id{_EXPANDED}")
def j11(spark, d):
    return expanded(spark, d).select("lastfm_name", "album_id", "track", "id")


@check("p7_embedded_context", f"""
 SELECT c_custkey AS artist_id, 'Album ' || o_orderkey AS album_name, CASE o_orderstatus WHEN 'F' THEN 'album' ELSE 'single' END AS album_type, count(*) AS tracks{_EXPANDED} GROUP BY 1, 2, 3""")
def p7(spark, d):
    rows = expanded(spark, d)
    return rows.groupBy(F.col("_artist.artist_id").alias("artist_id"), F.col("_album.name").alias("album_name"), F.col("_album.album_type").alias("album_type")).agg(
        F.count("*").alias("tracks")
    )


@check("w5_most_popular", """
 SELECT query, id FROM (SELECT l_suppkey AS query, l_orderkey * 10 + l_linenumber AS id, row_number() OVER (PARTITION BY l_suppkey ORDER BY coalesce(CASE WHEN l_returnflag <> 'N' THEN l_quantity END, 0) DESC, l_orderkey * 10 + l_linenumber) AS rn FROM lineitem) WHERE rn = 1""")
def w5(spark, d):
    rows = table(spark, d, "lineitem").selectExpr(
        "l_suppkey as query", "l_orderkey * 10 + l_linenumber as id", "case when l_returnflag <> 'N' then l_quantity end as popularity"
    )
    return merge.most_popular(rows, "query", [F.col("id")]).select("query", "id")


@check("a21_legend", """
 SELECT DISTINCT upper(left(s, 1)) || substr(s, 2) AS trace, '#888' AS color FROM (SELECT lower(c_mktsegment) AS s FROM customer)""")
def a21(spark, d):
    from bandstand.plans.charts import legend

    points = table(spark, d, "customer").select(F.lower("c_mktsegment").alias("subgenre"))
    return legend(merge.with_color(points, SUBGENRE_COLORS, DEFAULT_COLOR))
