"""The given tables in the shapes the engine works on, each with the same shape in SQL.

Every shape is a projection, join or aggregate of the whole tables; nothing is sampled or cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from bandstand.settings import Settings

# Thresholds that split the given tables into all branches.
CHECK_SETTINGS = Settings(
    breakout_listeners=3_000_000,
    underground_listeners=1_800_000,
    giant_listeners=2_400_000,
    dormancy_years=3,
    as_of_year=2002,
    last_text_year=2026,
)
RUN_DATE = "1999-06-17"


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _spend(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").groupBy("o_custkey").agg(
        F.expr("sum(cast(round(o_totalprice * 100) as bigint)) div 100").alias("spend")
    )


def silver_artists(spark: SparkSession, d: str, history: bool = False) -> DataFrame:
    """Customers as artists. Every fourth one also appears, differently spelled, in a second scene;
    with ``history`` every tenth also has an older snapshot."""
    copies = "array(0, 1)" if not history else "array(0, 1, 2)"
    base = (
        table(spark, d, "customer")
        .join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(_spend(spark, d), F.col("c_custkey") == F.col("o_custkey"))
        .withColumn("copy", F.explode(F.expr(copies)))
        .where("copy = 0 or (copy = 1 and c_custkey % 4 = 0) or (copy = 2 and c_custkey % 10 = 0)")
    )
    linked = "c_custkey % 5 <> 0"
    return base.selectExpr(
        "case when copy = 1 then concat('  ', upper(c_name), ' ') else c_name end as lastfm_name",
        f"case when {linked} then concat('mb-', cast(c_custkey as string)) end as mbid",
        f"case when {linked} then upper(c_name) end as mb_name",
        "case when copy = 1 then greatest(spend - (c_custkey % 8) * 1000, 1) else spend end as listeners",
        "spend * (1 + c_custkey % 20) + (spend * (c_custkey % 10)) div 10 as play_count",
        "lower(c_mktsegment) as source_tag",
        "case when n_regionkey <> 4 then n_name end as country",
        "case when c_custkey % 7 <> 0 then cast(1960 + c_custkey % 66 as double) end as formed_year",
        "concat('bio of ', c_name) as bio_summary",
        f"case when {linked} then cast(9000 + c_custkey % 1000 as double) / 100 end as mb_resolution_score",
        "case when copy = 1 then 'crossover' else lower(c_mktsegment) end as subgenre",
        "case when copy = 2 then '1999-06-10' else '1999-06-17' end as date",
    )


def _silver_artists_sql(history: bool) -> str:
    return f"""
 SELECT CASE WHEN copy = 1 THEN '  ' || upper(c_name) || ' ' ELSE c_name END AS lastfm_name,
  CASE WHEN c_custkey % 5 <> 0 THEN 'mb-' || c_custkey END AS mbid,
  CASE WHEN c_custkey % 5 <> 0 THEN upper(c_name) END AS mb_name,
  CASE WHEN copy = 1 THEN greatest(spend - (c_custkey % 8) * 1000, 1) ELSE spend END AS listeners,
  CAST(spend * (1 + c_custkey % 20) + (spend * (c_custkey % 10)) // 10 AS BIGINT) AS play_count,
  lower(c_mktsegment) AS source_tag,
  CASE WHEN n_regionkey <> 4 THEN n_name END AS country,
  CASE WHEN c_custkey % 7 <> 0 THEN CAST(1960 + c_custkey % 66 AS DOUBLE) END AS formed_year,
  'bio of ' || c_name AS bio_summary,
  CASE WHEN c_custkey % 5 <> 0 THEN CAST(9000 + c_custkey % 1000 AS DOUBLE) / 100 END AS mb_resolution_score,
  CASE WHEN copy = 1 THEN 'crossover' ELSE lower(c_mktsegment) END AS subgenre,
  CASE WHEN copy = 2 THEN '1999-06-10' ELSE '1999-06-17' END AS date
 FROM customer JOIN nation ON c_nationkey = n_nationkey
 JOIN (SELECT o_custkey, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) // 100 AS BIGINT) AS spend
       FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey
 JOIN (VALUES (0), (1), (2)) AS v(copy)
   ON copy = 0 OR (copy = 1 AND c_custkey % 4 = 0){" OR (copy = 2 AND c_custkey % 10 = 0)" if history else ""}"""


def raw_albums(spark: SparkSession, d: str) -> DataFrame:
    """Orders as raw releases, with missing titles, missing, empty, partial and broken dates.

    An artist's releases are moved back by up to five years, so that some are active and some dormant.
    Some releases belong to names that are no artist's, or to a name with that one release only.
    """
    return (
        table(spark, d, "orders")
        .withColumn("released", F.expr("add_months(o_orderdate, -12 * cast(o_custkey % 6 as int))"))
        .selectExpr(
            "concat('rg-', cast(o_orderkey as string)) as mbid",
            "case when o_orderkey % 97 <> 0 then concat('Release ', cast(o_orderkey as string)) end as title",
            "case o_orderpriority when '1-URGENT' then 'Album' when '2-HIGH' then 'EP'"
            " when '3-MEDIUM' then 'Single' else 'Other' end as type",
            "case when o_orderkey % 101 = 0 then null when o_orderkey % 89 = 0 then ''"
            " when o_orderkey % 83 = 0 then 'unknown'"
            " when o_orderkey % 13 = 0 then date_format(released, 'yyyy')"
            " when o_orderkey % 17 = 0 then date_format(released, 'yyyy-MM')"
            " else date_format(released, 'yyyy-MM-dd') end as first_release_date",
            "concat(case when o_orderkey % 5 = 0 then ' CUSTOMER#' else 'Customer#' end, lpad(cast(o_custkey as string), 9, '0'),"
            " case o_custkey % 7 when 0 then ' trio' when 1 then concat(' guest ', cast(o_orderkey as string)) else '' end)"
            " as artist_name",
            "concat('mb-', cast(o_custkey as string)) as artist_mbid",
            "o_orderkey as _seq",
            "'registry' as source",
            "'betrayal_tracker' as subgenre",
            "'1999-06-17' as date",
        )
    )


_RAW_ALBUMS_SQL = """
 SELECT 'rg-' || o_orderkey AS mbid,
  CASE WHEN o_orderkey % 97 <> 0 THEN 'Release ' || o_orderkey END AS title,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Album' WHEN '2-HIGH' THEN 'EP' WHEN '3-MEDIUM' THEN 'Single' ELSE 'Other' END AS type,
  CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 89 = 0 THEN '' WHEN o_orderkey % 83 = 0 THEN 'unknown'
   WHEN o_orderkey % 13 = 0 THEN strftime(released, '%Y') WHEN o_orderkey % 17 = 0 THEN strftime(released, '%Y-%m')
   ELSE strftime(released, '%Y-%m-%d') END AS first_release_date,
  CASE WHEN o_orderkey % 5 = 0 THEN ' CUSTOMER#' ELSE 'Customer#' END || lpad(CAST(o_custkey AS VARCHAR), 9, '0')
   || CASE o_custkey % 7 WHEN 0 THEN ' trio' WHEN 1 THEN ' guest ' || o_orderkey ELSE '' END AS artist_name,
  'mb-' || o_custkey AS artist_mbid, o_orderkey
 FROM (SELECT *, o_orderdate - to_years(CAST(o_custkey % 6 AS INTEGER)) AS released FROM orders)"""

_SILVER_ALBUMS_SQL = """
 SELECT artist_name, artist_mbid, mbid AS album_id, title, type, first_release_date,
  CAST(year(TRY_CAST(CASE length(first_release_date) WHEN 4 THEN first_release_date || '-01-01'
   WHEN 7 THEN first_release_date || '-01' ELSE first_release_date END AS DATE)) AS BIGINT) AS release_year
 FROM raw_albums"""


def raw_artist_info(spark: SparkSession, d: str) -> DataFrame:
    """Parts as raw artist records: repeated names in several spellings, counts and tags in all shapes."""
    return table(spark, d, "part").selectExpr(
        "case p_partkey % 5 when 1 then initcap(p_name) when 2 then concat(' ', p_name, '\\t') else p_name end as name",
        "case when p_partkey % 2 = 0 then concat('id-', cast(p_partkey as string)) end as mbid",
        "named_struct("
        "'listeners', case p_partkey % 11 when 0 then format_number(p_partkey * 7919 % 150000, 0)"
        " when 1 then concat(' ', cast(p_partkey * 7919 % 150000 as string), ' ') when 2 then '' when 3 then null"
        " when 4 then 'abc' when 5 then '61000.5' else cast(p_partkey * 7919 % 150000 as string) end,"
        "'playcount', case when p_partkey % 13 <> 0 then cast((p_partkey * 7919 % 150000) * p_size as string) end) as stats",
        "case p_partkey % 4"
        " when 0 then concat('{\"tag\":[{\"name\":\" ', p_type, ' \"},{\"name\":\"', p_brand, '\"},{\"name\":\"\"}]}')"
        " when 1 then concat('{\"tag\":{\"name\":\"', p_type, '\"}}')"
        " when 2 then '\"\"' end as tags",
        "named_struct("
        "'summary', case p_partkey % 6 when 2 then concat('They began 19', cast(50 + p_size as string)) when 5 then null"
        " else repeat(concat(p_name, ' '), 60) end,"
        "'content', case p_partkey % 6 when 0 then concat('The band formed in ', cast(1960 + p_size as string), ' in town')"
        " when 1 then concat('FOUNDED\\n in 2005, later formed in ', cast(1960 + p_size as string))"
        " when 2 then '' when 3 then 'started in 9999' when 4 then 'no year here' end) as bio",
        "p_brand as _source_tag",
        "p_partkey as _seq",
        "'charts' as source",
        "lower(p_type) as subgenre",
        "'1999-06-17' as date",
    )


# Flat record of each raw artist, written independently of the raw JSON: what cleaning must give.
_FLAT_ARTISTS_SQL = """
 SELECT p_partkey AS _seq, lower(p_type) AS subgenre, p_brand AS source_tag,
  CASE p_partkey % 5 WHEN 1 THEN upper(left(split_part(p_name, ' ', 1), 1)) || substr(split_part(p_name, ' ', 1), 2) || ' '
    || upper(left(split_part(p_name, ' ', 2), 1)) || substr(split_part(p_name, ' ', 2), 2) ELSE p_name END AS lastfm_name,
  p_name AS name_key,
  CASE WHEN p_partkey % 2 = 0 THEN 'id-' || p_partkey ELSE '' END AS lastfm_mbid,
  CASE WHEN p_partkey % 11 IN (2, 3, 4, 5) THEN NULL ELSE p_partkey * 7919 % 150000 END AS listeners,
  CASE WHEN p_partkey % 13 <> 0 THEN (p_partkey * 7919 % 150000) * p_size END AS play_count,
  CASE p_partkey % 4 WHEN 0 THEN [lower(p_type), lower(p_brand)] WHEN 1 THEN [lower(p_type)] ELSE CAST([] AS VARCHAR[]) END AS tags,
  CASE p_partkey % 6 WHEN 0 THEN 1960 + p_size WHEN 1 THEN 2005 WHEN 2 THEN CASE WHEN 1950 + p_size >= 1960 AND p_size < 50 THEN 1950 + p_size END END AS formed_year,
  CASE p_partkey % 6 WHEN 2 THEN 'They began 19' || (50 + p_size) WHEN 5 THEN '' ELSE left(repeat(p_name || ' ', 60), 500) END AS bio_summary
 FROM part"""


def raw_metadata(spark: SparkSession, d: str) -> DataFrame:
    """Parts as landed match results: several per name, in all three outcomes."""
    return table(spark, d, "part").selectExpr(
        "case when p_partkey % 3 = 0 then initcap(p_name) else p_name end as lastfm_name",
        "concat('mb-', cast(p_partkey as string)) as mbid",
        "upper(p_name) as mb_name",
        "'Group' as type",
        "case when p_partkey % 4 <> 0 then p_brand end as country",
        "case when p_partkey % 3 <> 1 then cast(1960 + p_size as int) end as formed_year",
        "'' as disambiguation",
        "cast(p_size as int) as mb_score",
        "cast(50 + p_size as double) as similarity_score",
        "case when p_size >= 30 then 'auto_accepted' when p_size >= 20 then 'review_required' else 'rejected' end"
        " as resolution_status",
        "p_partkey as _seq",
        "'registry' as source",
        "lower(p_type) as subgenre",
        "'1999-06-17' as date",
    )


_RAW_METADATA_SQL = """
 SELECT CASE WHEN p_partkey % 3 = 0 THEN upper(left(split_part(p_name, ' ', 1), 1)) || substr(split_part(p_name, ' ', 1), 2) || ' '
    || upper(left(split_part(p_name, ' ', 2), 1)) || substr(split_part(p_name, ' ', 2), 2) ELSE p_name END AS lastfm_name,
  'mb-' || p_partkey AS mbid, upper(p_name) AS mb_name,
  CASE WHEN p_partkey % 4 <> 0 THEN p_brand END AS country,
  CASE WHEN p_partkey % 3 <> 1 THEN 1960 + p_size END AS formed_year,
  CAST(50 + p_size AS DOUBLE) AS similarity_score,
  CASE WHEN p_size >= 30 THEN 'auto_accepted' WHEN p_size >= 20 THEN 'review_required' ELSE 'rejected' END AS resolution_status,
  p_partkey AS _seq, lower(p_type) AS subgenre
 FROM part"""


def raw_weekly(spark: SparkSession, d: str) -> DataFrame:
    """Events as one-entry weekly snapshots, in both JSON shapes, with missing and broken values."""
    return table(spark, d, "events").selectExpr(
        "case when event_id % 53 <> 0 then date_format(date_trunc('week', ts), 'yyyy-MM-dd') end as _week_start",
        "date_format(date_trunc('week', ts) + interval 7 days, 'yyyy-MM-dd') as _week_end",
        "concat(case when event_id % 3 = 0 then '{\"artist\":[' else '[' end,"
        " case when event_id % 47 = 0 then '7,' else '' end,"
        " '{\"name\":\"', case when event_id % 43 = 0 then '' else concat('artist ', cast(user_id as string)) end, '\",',"
        " case when event_id % 4 = 0 then '\"listeners\":\"\",\"playcount\":\"' else '\"listeners\":\"' end,"
        " case when event_id % 41 = 0 then 'many' else cast(cast(round(value * 100) as bigint) as string) end, '\"}',"
        " case when event_id % 3 = 0 then ']}' else ']' end) as topartists",
        "event_id as _seq",
        "'charts' as source",
        "event_type as subgenre",
        "'2024-02-01' as date",
    )


_WEEKLY_SQL = """
 SELECT 'artist ' || user_id AS artist_name, strftime(date_trunc('week', ts), '%Y-%m-%d') AS week_start,
  CAST(round(value * 100) AS BIGINT) AS listeners, event_type AS subgenre
 FROM events WHERE event_id % 53 <> 0 AND event_id % 43 <> 0 AND event_id % 41 <> 0"""


def candidates(spark: SparkSession, d: str) -> DataFrame:
    """Line items as landed search results: one row per query and candidate."""
    return table(spark, d, "lineitem").selectExpr(
        "concat('Part Band ', cast(l_partkey as string)) as query",
        "l_orderkey * 10 + l_linenumber as pos",
        "concat('e-', cast(l_orderkey as string), '-', cast(l_linenumber as string)) as id",
        "case l_linenumber when 1 then concat(cast(l_partkey as string), ' band part')"
        " when 2 then concat('Part Bnd ', cast(l_partkey as string))"
        " when 3 then concat('The Part Band of ', cast(l_suppkey as string)) else concat('Solo ', cast(l_suppkey as string)) end as name",
        "case when l_returnflag = 'R' then 'Group' when l_returnflag = 'A' then 'Person' end as type",
        "l_linestatus as country",
        "case when l_orderkey % 9 <> 0 then cast(l_quantity as int) end as score",
        "case when l_linenumber % 3 = 0 then date_format(l_shipdate, 'yyyy') when l_linenumber % 3 = 1"
        " then date_format(l_shipdate, 'yyyy-MM-dd') else '19' end as life_span_begin",
        "cast(null as string) as disambiguation",
    )


_CANDIDATES_SQL = """
 SELECT 'Part Band ' || l_partkey AS query, l_orderkey * 10 + l_linenumber AS pos,
  'e-' || l_orderkey || '-' || l_linenumber AS id,
  CASE l_linenumber WHEN 1 THEN l_partkey || ' band part' WHEN 2 THEN 'Part Bnd ' || l_partkey
   WHEN 3 THEN 'The Part Band of ' || l_suppkey ELSE 'Solo ' || l_suppkey END AS name,
  CASE l_returnflag WHEN 'R' THEN 'Group' WHEN 'A' THEN 'Person' END AS type,
  l_linestatus AS country, CASE WHEN l_orderkey % 9 <> 0 THEN CAST(l_quantity AS INTEGER) END AS score,
  CASE l_linenumber % 3 WHEN 0 THEN strftime(l_shipdate, '%Y') WHEN 1 THEN strftime(l_shipdate, '%Y-%m-%d') ELSE '19' END AS life_span_begin
 FROM lineitem"""

_STAGED_ARTISTS_SQL = """
 SELECT lastfm_name AS artist_name, mbid AS musicbrainz_id, mb_name AS musicbrainz_name, listeners, play_count, subgenre,
  source_tag, country, CAST(formed_year AS INTEGER) AS formed_year, bio_summary, mb_resolution_score, date AS ingestion_date
 FROM silver_artists WHERE listeners > 0"""
_STAGED_ALBUMS_SQL = """
 SELECT artist_name, artist_mbid, album_id AS musicbrainz_album_id, title AS album_title, type AS album_type,
  first_release_date, CAST(release_year AS INTEGER) AS release_year
 FROM silver_albums WHERE title IS NOT NULL AND first_release_date IS NOT NULL"""
_ALBUM_FACTS_SQL = """
 SELECT lower(trim(artist_name)) AS name_key, count(*) AS total_albums, min(release_year) AS debut_year,
  max(release_year) AS last_album_year, max(first_release_date) AS last_release_date,
  CASE WHEN count(*) > 1 THEN CAST(max(release_year) - min(release_year) AS DOUBLE) / (count(*) - 1) END AS avg_years_between_albums,
  count(*) FILTER (album_type = 'Album') AS studio_albums, count(*) FILTER (album_type = 'EP') AS eps,
  count(*) FILTER (album_type = 'Single') AS singles
 FROM albums GROUP BY 1"""
_PRIMARY_SQL = """
 SELECT * FROM (SELECT *, lower(trim(artist_name)) AS name_key, row_number() OVER (PARTITION BY lower(trim(artist_name))
  ORDER BY listeners DESC, subgenre, artist_name) AS rn FROM artists) WHERE rn = 1"""
_FEATURES_SQL = """
 SELECT a.artist_name, a.musicbrainz_id, a.subgenre, a.country, a.formed_year, a.mb_resolution_score,
  2002 - a.formed_year AS band_age_years, coalesce(f.total_albums, 0) AS total_albums, coalesce(f.studio_albums, 0) AS studio_albums,
  f.debut_year, f.last_album_year AS latest_album_year, f.avg_years_between_albums,
  2002 - f.last_album_year AS years_since_last_release, a.listeners AS current_listeners, a.play_count,
  CASE WHEN a.listeners > 0 THEN round(CAST(a.play_count AS DOUBLE) / a.listeners, 1) END AS plays_per_listener,
  CASE WHEN a.listeners >= 3000000 THEN 1 WHEN a.listeners < 1800000 THEN 0 END AS is_breakout
 FROM primary_artists a LEFT JOIN album_facts f ON a.name_key = f.name_key"""

_PARTS = {
    "silver_artists": (_silver_artists_sql(False), ()),
    "silver_history": (_silver_artists_sql(True), ()),
    "raw_albums": (_RAW_ALBUMS_SQL, ()),
    "silver_albums": (_SILVER_ALBUMS_SQL, ("raw_albums",)),
    "flat_artists": (_FLAT_ARTISTS_SQL, ()),
    "raw_metadata": (_RAW_METADATA_SQL, ()),
    "weekly": (_WEEKLY_SQL, ()),
    "candidates": (_CANDIDATES_SQL, ()),
    "artists": (_STAGED_ARTISTS_SQL, ("silver_artists",)),
    "albums": (_STAGED_ALBUMS_SQL, ("silver_albums",)),
    "album_facts": (_ALBUM_FACTS_SQL, ("albums",)),
    "primary_artists": (_PRIMARY_SQL, ("artists",)),
    "all_features": (_FEATURES_SQL, ("primary_artists", "album_facts")),
    "features": ("SELECT * FROM all_features WHERE is_breakout IS NOT NULL", ("all_features",)),
}


def sql(body: str, *shapes: str, **extra: str) -> str:
    """``body`` with the named shapes (and what they need) as leading CTEs; ``extra`` adds CTEs after them."""
    order: list[str] = []

    def need(name: str) -> None:
        for inner in _PARTS[name][1]:
            need(inner)
        if name not in order:
            order.append(name)

    for shape in shapes:
        need(shape)
    ctes = [f"{n} AS ({_PARTS[n][0]})" for n in order] + [f"{n} AS ({q})" for n, q in extra.items()]
    return f"WITH {', '.join(ctes)} {body}" if ctes else body


def artists(spark: SparkSession, d: str) -> DataFrame:
    from bandstand.plans.staging import stage_artists

    return stage_artists(silver_artists(spark, d), latest_only=False)


def silver_albums(spark: SparkSession, d: str) -> DataFrame:
    from bandstand.plans.silver_build import build_albums

    return build_albums(raw_albums(spark, d))


def albums(spark: SparkSession, d: str) -> DataFrame:
    from bandstand.plans.staging import stage_albums

    return stage_albums(silver_albums(spark, d), latest_only=False)


def features(spark: SparkSession, d: str, labelled_only: bool = True) -> DataFrame:
    from bandstand.plans.catalogue import artist_features

    return artist_features(artists(spark, d), albums(spark, d), CHECK_SETTINGS, labelled_only)


def stored_features(spark: SparkSession, d: str) -> DataFrame:
    """The labelled feature mart as a stored table, the way models read it."""
    from bandstand.runtime import scratch_path
    from bandstand.sources.marts import materialize

    return materialize(features(spark, d), scratch_path(spark, "gold"), "mart_artist_features")
