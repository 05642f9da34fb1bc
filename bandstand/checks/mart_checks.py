"""Staging, marts and the aggregates, windows and sorts they are made of."""

from __future__ import annotations

from pyspark.sql import functions as F

from bandstand.checks import shapes
from bandstand.checks.registry import check
from bandstand.checks.shapes import CHECK_SETTINGS as S
from bandstand.checks.shapes import sql, table
from bandstand.checks.source_checks import LEGACY_SQL, legacy
from bandstand.functions import numbers, ordering, tiers
from bandstand.functions.ranking import top_per_key
from bandstand.ml import prep
from bandstand.operators import quality
from bandstand.plans import catalogue, health, staging
from bandstand.runtime import scratch_path
from bandstand.sources import silver

_NO_TAGS = "artist_name, musicbrainz_id, musicbrainz_name, listeners, play_count, subgenre, source_tag, country, formed_year, bio_summary, mb_resolution_score, ingestion_date"


@check("p2_stage_artists", sql(f"SELECT {_NO_TAGS} FROM artists", "artists"))
def p2(spark, d):
    return shapes.artists(spark, d)


@check("p3_stage_albums", sql("SELECT * FROM albums", "albums"))
def p3(spark, d):
    return shapes.albums(spark, d)


@check("f2_positive_listeners", sql("SELECT subgenre, count(*) AS artists FROM silver_history WHERE listeners > 0 GROUP BY 1", "silver_history"))
def f2(spark, d):
    staged = staging.stage_artists(shapes.silver_artists(spark, d, history=True), latest_only=False)
    return staged.groupBy("subgenre").agg(F.count("*").alias("artists"))


@check("f3_titled_and_dated", sql("SELECT type AS album_type, count(*) AS albums, count(*) FILTER (first_release_date = '') AS empty_dates FROM silver_albums WHERE title IS NOT NULL AND first_release_date IS NOT NULL GROUP BY 1", "silver_albums"))
def f3(spark, d):
    return shapes.albums(spark, d).groupBy("album_type").agg(
        F.count("*").alias("albums"), F.count_if(F.col("first_release_date") == "").alias("empty_dates")
    )


def stored_history(spark, d) -> str:
    """Cleaned tables with two dates, stored the way the pipeline stores them."""
    base = scratch_path(spark, "silver")
    rows = shapes.silver_artists(spark, d, history=True).withColumns(
        {"lastfm_mbid": F.col("mbid"), "subgenre_tags": F.array().cast("array<struct<tag:string,valid_from:string,valid_to:string>>")}
    )
    silver.write_silver(rows, base, "artists")
    releases = shapes.silver_albums(spark, d).withColumns({"subgenre": F.lit("all"), "date": F.lit("1999-06-17")})
    silver.write_silver(releases, base, "albums")
    older = releases.withColumns({"title": F.concat("title", F.lit(" (draft)")), "date": F.lit("1999-06-10")})
    silver.write_silver(older.where(F.col("title").isNotNull()), base, "albums")
    return base


@check("u3_all_partitions", sql("SELECT subgenre, date, count(*) AS artists FROM silver_history GROUP BY 1, 2", "silver_history"))
def u3(spark, d):
    return silver.read_silver(spark, stored_history(spark, d), "artists").groupBy("subgenre", "date").agg(F.count("*").alias("artists"))


@check("u3_latest_snapshot", sql("SELECT subgenre, max(date) AS date, count(*) AS artists FROM silver_history h WHERE date = (SELECT max(date) FROM silver_history i WHERE i.subgenre = h.subgenre) GROUP BY 1", "silver_history"))
def u3_latest(spark, d):
    latest = silver.read_latest(spark, stored_history(spark, d), "artists")
    return latest.groupBy("subgenre").agg(F.max("date").alias("date"), F.count("*").alias("artists"))


@check("u3_newest_of_a_frame", sql("SELECT subgenre, max(date) AS date, count(*) AS artists FROM silver_history h WHERE date = (SELECT max(date) FROM silver_history i WHERE i.subgenre = h.subgenre) GROUP BY 1", "silver_history"))
def u3_frame(spark, d):
    latest = silver.latest_snapshot(shapes.silver_artists(spark, d, history=True))
    return latest.groupBy("subgenre").agg(F.max("date").alias("date"), F.count("*").alias("artists"))


@check("p2_stage_latest_stored", sql("SELECT * FROM artists", "artists"))
def p2_stored(spark, d):
    return staging.stage_stored(spark, stored_history(spark, d))[0].drop("subgenre_tags")


@check("p3_stage_latest_stored", sql("SELECT * FROM albums", "albums"))
def p3_stored(spark, d):
    return staging.stage_stored(spark, stored_history(spark, d))[1]


@check("mart_artist_features_stored", sql("SELECT * FROM features", "features"))
def features_stored(spark, d):
    return catalogue.artist_features(*staging.stage_stored(spark, stored_history(spark, d)), S)


def facets(spark, d):
    return health.scene_facets(health.scene_cells(shapes.artists(spark, d), S))


_STATS = """
 SELECT subgenre, count(*) AS total_artists, CAST(sum(listeners) AS BIGINT) AS total_listeners,
  CAST(sum(listeners) AS DOUBLE) / count(*) AS avg_listeners, max(listeners) AS max_listeners, min(formed_year) AS oldest_band_year
 FROM artists GROUP BY 1"""


@check("a1_scene_totals", sql(_STATS, "artists"))
def a1(spark, d):
    return health.scene_stats(facets(spark, d)).select(
        "subgenre", "total_artists", "total_listeners", "avg_listeners", "max_listeners", "oldest_band_year"
    )


_QUANTILES = """
 SELECT subgenre, quantile_disc(listeners, 0.5) AS median_listeners, quantile_disc(listeners, 0.9) AS p90_listeners,
  quantile_disc(CAST(formed_year AS DOUBLE), 0.5) AS median_formed_year FROM artists GROUP BY 1"""


@check("a2_scene_percentiles", sql(_QUANTILES, "artists"))
def a2(spark, d):
    years = health.scene_stats(facets(spark, d)).select("subgenre", "median_formed_year")
    return health.scene_quantiles(shapes.artists(spark, d)).join(years, "subgenre")


@check("a3_conditional_counts", sql("""
 SELECT subgenre, count(*) FILTER (listeners >= 3000000) AS breakout_artists, count(*) FILTER (listeners < 1800000) AS underground_artists,
  count(*) FILTER (listeners BETWEEN 1800000 AND 2999999) AS rising_artists, count(formed_year) AS artists_with_formed_year,
  count(country) AS artists_with_country FROM artists GROUP BY 1""", "artists"))
def a3(spark, d):
    return health.scene_stats(facets(spark, d)).select(
        "subgenre", "breakout_artists", "underground_artists", "rising_artists", "artists_with_formed_year", "artists_with_country"
    )


@check("a4_distinct_countries", sql("SELECT subgenre, count(DISTINCT country) AS country_count FROM artists GROUP BY 1", "artists"))
def a4(spark, d):
    return health.scene_stats(facets(spark, d)).select("subgenre", "country_count")


_DECADES = """
 SELECT subgenre, CAST(floor(formed_year / 10) * 10 AS INTEGER) AS formation_decade, CAST(sum(listeners) AS BIGINT) AS decade_total_listeners,
  count(*) AS decade_artist_count FROM artists WHERE formed_year IS NOT NULL GROUP BY 1, 2"""


@check("a5_decade_totals", sql(_DECADES, "artists"))
def a5(spark, d):
    return health.decade_totals(facets(spark, d))


_COUNTRIES = """
 SELECT subgenre, country, CAST(sum(listeners) AS BIGINT) AS country_listeners, count(*) AS country_artist_count
 FROM artists WHERE country IS NOT NULL GROUP BY 1, 2"""


@check("a6_country_totals", sql(_COUNTRIES, "artists"))
def a6(spark, d):
    return health.country_totals(facets(spark, d))


@check("f5_group_null_filters", sql("""
 SELECT 'formed_year' AS facet, count(*) AS groups, CAST(sum(n) AS BIGINT) AS artists FROM (SELECT count(*) AS n FROM artists WHERE formed_year IS NOT NULL GROUP BY subgenre, CAST(floor(formed_year / 10) AS INTEGER))
 UNION ALL SELECT 'country', count(*), CAST(sum(n) AS BIGINT) FROM (SELECT count(*) AS n FROM artists WHERE country IS NOT NULL GROUP BY subgenre, country)""", "artists"))
def f5(spark, d):
    facts = facets(spark, d)
    decades = health.decade_totals(facts).agg(F.count("*").alias("groups"), F.sum("decade_artist_count").alias("artists"))
    countries = health.country_totals(facts).agg(F.count("*").alias("groups"), F.sum("country_artist_count").alias("artists"))
    return decades.withColumn("facet", F.lit("formed_year")).unionByName(countries.withColumn("facet", F.lit("country")))


@check("w2_golden_era", sql("""
 SELECT subgenre, formation_decade AS golden_era_decade, decade_total_listeners AS golden_era_total_listeners, decade_artist_count AS golden_era_artist_count
 FROM (SELECT *, row_number() OVER (PARTITION BY subgenre ORDER BY decade_total_listeners DESC, formation_decade) AS era_rank FROM decades) WHERE era_rank = 1""",
 "artists", decades=_DECADES))
def w2(spark, d):
    return health.golden_era(facets(spark, d))


@check("w3_top_country", sql("""
 SELECT subgenre, country AS dominant_country, country_listeners AS dominant_country_listeners
 FROM (SELECT *, row_number() OVER (PARTITION BY subgenre ORDER BY country_listeners DESC, country) AS country_rank FROM countries) WHERE country_rank = 1""",
 "artists", countries=_COUNTRIES))
def w3(spark, d):
    return health.top_country(facets(spark, d))


HEALTH_SQL = sql("""
 SELECT s.subgenre, total_artists, total_listeners, avg_listeners, median_listeners, p90_listeners, max_listeners,
  breakout_artists, rising_artists, underground_artists, round(CAST(breakout_artists AS DOUBLE) / total_artists * 100, 1) AS breakout_pct,
  avg_formed_year, median_formed_year, oldest_band_year, artists_with_formed_year,
  g.formation_decade AS golden_era_decade, g.decade_total_listeners AS golden_era_total_listeners, g.decade_artist_count AS golden_era_artist_count,
  country_count, artists_with_country, t.country AS dominant_country, t.country_listeners AS dominant_country_listeners
 FROM (SELECT subgenre, count(*) AS total_artists, CAST(sum(listeners) AS BIGINT) AS total_listeners,
   CAST(sum(listeners) AS DOUBLE) / count(*) AS avg_listeners, quantile_disc(listeners, 0.5) AS median_listeners,
   quantile_disc(listeners, 0.9) AS p90_listeners, max(listeners) AS max_listeners,
   count(*) FILTER (listeners >= 3000000) AS breakout_artists, count(*) FILTER (listeners BETWEEN 1800000 AND 2999999) AS rising_artists,
   count(*) FILTER (listeners < 1800000) AS underground_artists, CAST(sum(formed_year) AS DOUBLE) / count(formed_year) AS avg_formed_year,
   quantile_disc(CAST(formed_year AS DOUBLE), 0.5) AS median_formed_year, min(formed_year) AS oldest_band_year,
   count(formed_year) AS artists_with_formed_year, count(DISTINCT country) AS country_count, count(country) AS artists_with_country
  FROM artists GROUP BY subgenre) s
 LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY subgenre ORDER BY decade_total_listeners DESC, formation_decade) AS rn FROM decades) g ON g.subgenre = s.subgenre AND g.rn = 1
 LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY subgenre ORDER BY country_listeners DESC, country) AS rn FROM countries) t ON t.subgenre = s.subgenre AND t.rn = 1""",
 "artists", decades=_DECADES, countries=_COUNTRIES)


@check("mart_subgenre_health", HEALTH_SQL)
def mart_health(spark, d):
    return health.subgenre_health(shapes.artists(spark, d), S)


@check("j3_health_joins", sql("""
 SELECT s.subgenre, total_artists, g.golden AS golden_era_decade, t.top AS dominant_country
 FROM (SELECT subgenre, count(*) AS total_artists FROM artists GROUP BY 1) s
 LEFT JOIN (SELECT subgenre, arg_max(formation_decade, (decade_total_listeners, -formation_decade)) AS golden FROM decades GROUP BY 1) g USING (subgenre)
 LEFT JOIN (SELECT subgenre, first(country ORDER BY country_listeners DESC, country) AS top FROM countries GROUP BY 1) t USING (subgenre)""",
 "artists", decades=_DECADES, countries=_COUNTRIES))
def j3(spark, d):
    return health.subgenre_health(shapes.artists(spark, d), S).select(
        "subgenre", "total_artists", "golden_era_decade", "dominant_country"
    )


@check("a19_breakout_share", sql("SELECT subgenre, round(CAST(count(*) FILTER (listeners >= 3000000) AS DOUBLE) / count(*) * 100, 1) AS breakout_pct FROM artists GROUP BY 1", "artists"))
def a19(spark, d):
    return health.scene_stats(facets(spark, d)).select("subgenre", "breakout_pct")


@check("a7_album_facts", sql("SELECT name_key, total_albums, debut_year, last_album_year, last_release_date, studio_albums, eps, singles FROM album_facts", "album_facts"))
def a7(spark, d):
    return catalogue.album_facts(shapes.albums(spark, d)).withColumnRenamed(catalogue.KEY, "name_key").drop("avg_years_between_albums")


@check("a8_release_cadence", sql("SELECT name_key, avg_years_between_albums FROM album_facts", "album_facts"))
def a8(spark, d):
    facts = catalogue.album_facts(shapes.albums(spark, d))
    return facts.select(F.col(catalogue.KEY).alias("name_key"), "avg_years_between_albums")


_PRIMARY_COLUMNS = "artist_name, subgenre, listeners, play_count, country"


@check("w1_primary_artist", sql(f"SELECT {_PRIMARY_COLUMNS} FROM primary_artists", "primary_artists"))
def w1(spark, d):
    return catalogue.primary_artists(shapes.artists(spark, d)).select(*_PRIMARY_COLUMNS.split(", "))


@check("f6_rank_filters", sql("""
 SELECT 'artist' AS ranking, count(*) AS kept FROM primary_artists
 UNION ALL SELECT 'era', count(DISTINCT subgenre) FROM artists WHERE formed_year IS NOT NULL
 UNION ALL SELECT 'country', count(DISTINCT subgenre) FROM artists WHERE country IS NOT NULL""", "primary_artists"))
def f6(spark, d):
    facts = facets(spark, d)
    frames = {
        "artist": catalogue.primary_artists(shapes.artists(spark, d)),
        "era": health.golden_era(facts),
        "country": health.top_country(facts),
    }
    counts = [f.agg(F.count("*").alias("kept")).withColumn("ranking", F.lit(n)) for n, f in frames.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@check("j2_artists_with_albums", sql("""
 SELECT a.artist_name, a.listeners, f.total_albums, f.last_album_year FROM primary_artists a LEFT JOIN album_facts f USING (name_key)""",
 "primary_artists", "album_facts"))
def j2(spark, d):
    return catalogue.with_album_facts(shapes.artists(spark, d), shapes.albums(spark, d)).select(
        "artist_name", "listeners", "total_albums", "last_album_year"
    )


@check("mart_album_legacy", LEGACY_SQL)
def mart_legacy(spark, d):
    return legacy(spark, d)


@check("mart_artist_features", sql("SELECT * FROM features", "features"))
def mart_features(spark, d):
    return shapes.features(spark, d)


@check("e_dt3_years_since", sql("""
 SELECT a.artist_name, 2002 - f.last_album_year AS years_since_last_release, f.last_album_year - a.formed_year AS active_career_years,
  2002 - a.formed_year AS band_age_years FROM primary_artists a LEFT JOIN album_facts f USING (name_key)""", "primary_artists", "album_facts"))
def e_dt3(spark, d):
    rows = catalogue.with_album_facts(shapes.artists(spark, d), shapes.albums(spark, d))
    from bandstand.functions.dates import years_since

    return rows.select(
        "artist_name",
        years_since(F.col("last_album_year"), S.as_of_year).alias("years_since_last_release"),
        (F.col("last_album_year") - F.col("formed_year")).alias("active_career_years"),
        years_since(F.col("formed_year"), S.as_of_year).alias("band_age_years"),
    )


@check("e_c1_listener_tier", sql("SELECT artist_name, subgenre, CASE WHEN listeners >= 3000000 THEN 'breakout' WHEN listeners < 1800000 THEN 'underground' ELSE 'rising' END AS listener_tier FROM artists", "artists"))
def e_c1(spark, d):
    return shapes.artists(spark, d).select("artist_name", "subgenre", tiers.listener_tier(F.col("listeners"), S).alias("listener_tier"))


@check("e_c2_breakout_label", sql("SELECT artist_name, subgenre, CASE WHEN listeners >= 3000000 THEN 1 WHEN listeners < 1800000 THEN 0 END AS is_breakout FROM artists", "artists"))
def e_c2(spark, d):
    return shapes.artists(spark, d).select("artist_name", "subgenre", tiers.breakout_label(F.col("listeners"), S).alias("is_breakout"))


@check("e_c3_legacy_quadrant", f"SELECT legacy_quadrant, count(*) AS artists FROM ({LEGACY_SQL}) GROUP BY 1")
def e_c3(spark, d):
    return legacy(spark, d).groupBy("legacy_quadrant").agg(F.count("*").alias("artists"))


@check("e_c5_prediction_tier", sql("SELECT artist_name, subgenre, CASE WHEN listeners <= 0 THEN NULL WHEN listeners <= 1800000 THEN 'Underground' WHEN listeners <= 3000000 THEN 'Rising' ELSE 'Breakout' END AS current_tier FROM artists", "artists"))
def e_c5(spark, d):
    return shapes.artists(spark, d).select("artist_name", "subgenre", tiers.prediction_tier(F.col("listeners"), S).alias("current_tier"))


@check("e_c6_zero_for_missing", sql("SELECT artist_name, total_albums, studio_albums FROM all_features", "all_features"))
def e_c6(spark, d):
    return shapes.features(spark, d, labelled_only=False).select("artist_name", "total_albums", "studio_albums")


@check("e_m1_plays_per_listener", sql("SELECT artist_name, subgenre, CASE WHEN listeners > 0 THEN round(CAST(play_count AS DOUBLE) / listeners, 1) END AS plays_per_listener FROM artists", "artists"))
def e_m1(spark, d):
    return shapes.artists(spark, d).select(
        "artist_name", "subgenre", numbers.plays_per_listener(F.col("play_count"), F.col("listeners")).alias("plays_per_listener")
    )


@check("e_m2_decade", sql("SELECT artist_name, subgenre, CAST(floor(formed_year / 10) * 10 AS INTEGER) AS formation_decade FROM artists", "artists"))
def e_m2(spark, d):
    return shapes.artists(spark, d).select("artist_name", "subgenre", numbers.decade(F.col("formed_year")).alias("formation_decade"))


@check("f4_labelled_only", sql("SELECT is_breakout, count(*) AS artists FROM features GROUP BY 1", "features"))
def f4(spark, d):
    return shapes.features(spark, d).groupBy("is_breakout").agg(F.count("*").alias("artists"))


@check("t1_mart_order", sql("SELECT artist_name, listeners, row_number() OVER (ORDER BY listeners DESC, artist_name) AS place FROM primary_artists", "primary_artists"))
def t1(spark, d):
    order = catalogue.MART_ORDER["mart_album_legacy"]
    rows = legacy(spark, d).select("artist_name", "listeners")
    return ordering.with_row_number(rows, [F.col(order[0]).desc(), F.col(order[1])], "place")


@check("t1_mart_top", sql("SELECT artist_name, current_listeners FROM features ORDER BY current_listeners DESC, artist_name", "features"))
def t1_top(spark, d):
    return catalogue.in_mart_order(shapes.features(spark, d).select("artist_name", "current_listeners"), "mart_artist_features")


@check("t3_sorted_health", sql("SELECT subgenre, total_listeners, row_number() OVER (ORDER BY total_listeners, subgenre) AS place FROM (SELECT subgenre, CAST(sum(listeners) AS BIGINT) AS total_listeners FROM artists GROUP BY 1)", "artists"))
def t3(spark, d):
    totals = health.scene_stats(facets(spark, d)).select("subgenre", "total_listeners")
    return ordering.with_row_number(totals, [F.col("total_listeners"), F.col("subgenre")], "place")


@check("t4_head", sql("SELECT artist_name, listeners, country, formed_year FROM artists ORDER BY artist_name, subgenre LIMIT 15", "artists"))
def t4(spark, d):
    return shapes.artists(spark, d).orderBy("artist_name", "subgenre").select("artist_name", "listeners", "country", "formed_year").limit(15)


@check("t5_top_countries", sql("SELECT country, count(*) AS n FROM features WHERE country IS NOT NULL GROUP BY 1 ORDER BY n DESC, country LIMIT 10", "features"))
def t5(spark, d):
    return prep.top_values(shapes.features(spark, d), "country", S.top_countries)


@check("t6_artists_per_tag", """
 SELECT o_orderpriority AS tag, o_orderkey, place FROM (SELECT o_orderpriority, o_orderkey, CAST(row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER) AS place FROM orders) WHERE place <= 500""")
def t6(spark, d):
    rows = table(spark, d, "orders").select(F.col("o_orderpriority").alias("tag"), "o_orderkey", "o_totalprice")
    kept = top_per_key(rows, ["tag"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 500, "place")
    return kept.select("tag", "o_orderkey", "place")


@check("a12_non_null_profile", sql("""
 SELECT (SELECT count(*) FROM artists) AS total_rows, 'country' AS column_name, count(country) AS non_null FROM artists
 UNION ALL SELECT (SELECT count(*) FROM artists), 'formed_year', count(formed_year) FROM artists
 UNION ALL SELECT (SELECT count(*) FROM artists), 'musicbrainz_id', count(musicbrainz_id) FROM artists""", "artists"))
def a12(spark, d):
    return quality.non_null_profile(shapes.artists(spark, d), ["country", "formed_year", "musicbrainz_id"])


@check("q1_not_null", sql("""
 SELECT 'artists' AS table_name, 'lastfm_name' AS column_name, count(*) FILTER (lastfm_name IS NULL) AS failures, 'pass' AS status FROM silver_artists
 UNION ALL SELECT 'artists', 'listeners', count(*) FILTER (listeners IS NULL), 'pass' FROM silver_artists
 UNION ALL SELECT 'albums', 'artist_name', count(*) FILTER (artist_name IS NULL), 'pass' FROM silver_albums
 UNION ALL SELECT 'albums', 'title', count(*) FILTER (title IS NULL), CASE WHEN count(*) FILTER (title IS NULL) > 0 THEN 'fail' ELSE 'pass' END FROM silver_albums""",
 "silver_artists", "silver_albums"))
def q1(spark, d):
    first = quality.not_null_check(shapes.silver_artists(spark, d), "artists", quality.NOT_NULL["artists"])
    return first.unionByName(quality.not_null_check(shapes.silver_albums(spark, d), "albums", quality.NOT_NULL["albums"]))


@check("q2_freshness", """
 SELECT status, as_of, newest, CAST(date_diff('day', CAST(newest AS DATE), CAST(as_of AS DATE)) AS INTEGER) AS age_days FROM (
  SELECT max(strftime(ts, '%Y-%m-%d')) AS newest FROM events), (VALUES ('2024-02-07', 'pass'), ('2024-02-08', 'warn'), ('2024-02-14', 'warn'), ('2024-02-15', 'error')) v(as_of, status)""")
def q2(spark, d):
    dated = table(spark, d, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("date"))
    out = None
    for day in ("2024-02-07", "2024-02-08", "2024-02-14", "2024-02-15"):
        one = quality.freshness(dated, F.lit(day).cast("date"), S).withColumn("as_of", F.lit(day))
        out = one if out is None else out.unionByName(one)
    return out


@check("q3_table_profile", sql("""
 SELECT (SELECT count(*) FROM silver_albums) AS total_rows, 'title' AS column_name, count(title) AS non_null FROM silver_albums
 UNION ALL SELECT (SELECT count(*) FROM silver_albums), 'first_release_date', count(first_release_date) FROM silver_albums
 UNION ALL SELECT (SELECT count(*) FROM silver_albums), 'release_year', count(release_year) FROM silver_albums""", "silver_albums"))
def q3(spark, d):
    return quality.non_null_profile(shapes.silver_albums(spark, d), ["title", "first_release_date", "release_year"])


@check("x4_duplicate_keys", sql("SELECT lower(trim(artist_name)) AS name_key, count(*) AS copies FROM artists GROUP BY 1 HAVING count(*) > 1", "artists"))
def x4(spark, d):
    keyed = shapes.artists(spark, d).withColumn("name_key", F.lower(F.trim("artist_name")))
    return quality.duplicate_keys(keyed, ["name_key"])
