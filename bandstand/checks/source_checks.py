"""S1-S15: landing, cleaned tables, marts, exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from bandstand.checks import shapes
from bandstand.checks.registry import check
from bandstand.checks.shapes import CHECK_SETTINGS, sql, table
from bandstand.operators.merge import fill_missing
from bandstand.operators.weekly import flatten_weekly
from bandstand.plans import catalogue, health
from bandstand.plans.silver_build import build_albums, build_artists
from bandstand.runtime import scratch_path
from bandstand.schemas import BRONZE, MARTS, columns_of
from bandstand.sources import bronze, marts, silver

DATASETS = {
    "artist_info": shapes.raw_artist_info,
    "weekly_charts": shapes.raw_weekly,
    "artist_metadata": shapes.raw_metadata,
    "artist_albums": shapes.raw_albums,
}


def land(spark, d, *names):
    base = scratch_path(spark, "bronze")
    for name in names:
        raw = shapes.raw_artist_info if name == "tag_artists" else DATASETS[name]
        frame = raw(spark, d)
        bronze.write_bronze(frame.select(*columns_of(BRONZE[name]), *bronze.PARTITIONS), base, name)
    return base


@check("s1_land_raw", """
 SELECT 'charts' AS source, lower(p_type) AS subgenre, '1999-06-17' AS date, count(*) AS records,
  CAST(sum(p_partkey) AS BIGINT) AS seq_sum FROM part GROUP BY 2""")
def s1(spark, d):
    base = land(spark, d, "artist_info")
    return (
        bronze.read_artist_info(spark, base)
        .groupBy("source", "subgenre", "date")
        .agg(F.count("*").alias("records"), F.sum("_seq").alias("seq_sum"))
    )


@check("s2_read_raw_partitions", """
 SELECT 'landed' AS part, lower(p_type) AS subgenre, count(*) AS records FROM part GROUP BY 2
 UNION ALL SELECT 'missing', 'none', 0""")
def s2(spark, d):
    base = land(spark, d, "artist_info")
    landed = (
        bronze.read_bronze(spark, base, "artist_info", source="charts", date=shapes.RUN_DATE)
        .groupBy(F.lit("landed").alias("part"), "subgenre")
        .agg(F.count("*").alias("records"))
    )
    missing = bronze.read_bronze(spark, base, "artist_info", date="1900-01-01").agg(F.count("*").alias("records"))
    return landed.unionByName(missing.select(F.lit("missing").alias("part"), F.lit("none").alias("subgenre"), "records"))


@check("s3_typed_readers", sql("""
 SELECT 'tag_artists' AS dataset, count(*) AS records, CAST(sum(p_partkey) AS BIGINT) AS seq_sum FROM part
 UNION ALL SELECT 'artist_info', count(*), CAST(sum(p_partkey) AS BIGINT) FROM part
 UNION ALL SELECT 'weekly_charts', count(*), CAST(sum(event_id) AS BIGINT) FROM events
 UNION ALL SELECT 'artist_metadata', count(*), CAST(sum(p_partkey) AS BIGINT) FROM part
 UNION ALL SELECT 'artist_albums', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM raw_albums""", "raw_albums"))
def s3(spark, d):
    readers = {
        "tag_artists": bronze.read_tag_artists,
        "artist_info": bronze.read_artist_info,
        "weekly_charts": bronze.read_weekly_charts,
        "artist_metadata": bronze.read_artist_metadata,
        "artist_albums": bronze.read_artist_albums,
    }
    base = land(spark, d, *readers)
    out = None
    for name, read in readers.items():
        one = read(spark, base).agg(F.count("*").alias("records"), F.sum("_seq").alias("seq_sum")).withColumn(
            "dataset", F.lit(name)
        )
        out = one if out is None else out.unionByName(one)
    return out


@check("s4_strict_reader", "SELECT lower(p_type) AS subgenre, count(DISTINCT p_name) AS names FROM part GROUP BY 1")
def s4(spark, d):
    listed = bronze.require(bronze.read_tag_artists(spark, land(spark, d, "tag_artists")), "tag_artists")
    return listed.groupBy("subgenre").agg(F.count_distinct(F.lower(F.regexp_replace("name", r"^\s+|\s+$", ""))).alias("names"))


def stored_artists(spark, d):
    base = scratch_path(spark, "silver")
    built = build_artists(shapes.raw_artist_info(spark, d), shapes.raw_metadata(spark, d), ["_seq"], CHECK_SETTINGS)
    silver.write_silver(built, base, "artists")
    return base


_DEDUPED = """SELECT subgenre, name_key, max(listeners) AS listeners FROM flat_artists WHERE listeners >= 50000 GROUP BY 1, 2"""


@check("s5_write_silver_artists", sql("""
 SELECT subgenre, '1999-06-17' AS date, count(*) AS artists, CAST(sum(listeners) AS BIGINT) AS listeners
 FROM deduped GROUP BY 1""", "flat_artists", deduped=_DEDUPED))
def s5(spark, d):
    return (
        silver.read_silver(spark, stored_artists(spark, d), "artists")
        .groupBy("subgenre", "date")
        .agg(F.count("*").alias("artists"), F.sum("listeners").alias("listeners"))
    )


@check("s6_write_silver_albums_weekly", sql("""
 SELECT 'albums' AS table_name, subgenre, count(*) AS records, CAST(sum(release_year) AS BIGINT) AS total
 FROM (SELECT 'betrayal_tracker' AS subgenre, release_year FROM silver_albums) GROUP BY 2
 UNION ALL SELECT 'weekly_charts', subgenre, count(*), CAST(sum(listeners) AS BIGINT) FROM weekly GROUP BY 2""",
 "silver_albums", "weekly"))
def s6(spark, d):
    base = scratch_path(spark, "silver")
    silver.write_silver(build_albums(shapes.raw_albums(spark, d)), base, "albums")
    silver.write_silver(flatten_weekly(shapes.raw_weekly(spark, d)), base, "weekly_charts")

    def totals(name, column):
        return (
            silver.read_silver(spark, base, name)
            .groupBy(F.lit(name).alias("table_name"), "subgenre")
            .agg(F.count("*").alias("records"), F.sum(column).alias("total"))
        )

    return totals("albums", "release_year").unionByName(totals("weekly_charts", "listeners"))


@check("s7_external_tables", sql("""
 SELECT subgenre, count(*) AS artists, max(listeners) AS top FROM deduped GROUP BY 1""", "flat_artists", deduped=_DEDUPED))
def s7(spark, d):
    silver.register(spark, stored_artists(spark, d), ("artists",))
    out = spark.sql("SELECT subgenre, count(*) AS artists, max(listeners) AS top FROM artists GROUP BY subgenre")
    return out


@check("s7_catalog_table", sql("""
 SELECT subgenre, '1999-06-17' AS date, count(*) AS artists, max(listeners) AS top FROM deduped WHERE subgenre <> 'focus' GROUP BY 1""", "flat_artists", deduped=_DEDUPED))
def s7_catalog(spark, d):
    silver.create_external_table(spark, stored_artists(spark, d), "artists", "catalogued_artists")
    return spark.sql("SELECT subgenre, date, count(*) AS artists, max(listeners) AS top FROM catalogued_artists WHERE subgenre <> 'focus' GROUP BY subgenre, date")


@check("s8_declared_types", sql("""
 SELECT 'bigint' AS listeners_type, 'double' AS year_type, 'string' AS date_type,
  'array<struct<tag:string,valid_from:string,valid_to:string>>' AS tags_type, count(*) AS artists FROM deduped""",
 "flat_artists", deduped=_DEDUPED))
def s8(spark, d):
    stored = silver.read_silver(spark, stored_artists(spark, d), "artists")
    kinds = {"listeners_type": "listeners", "year_type": "formed_year", "date_type": "date", "tags_type": "subgenre_tags"}
    return stored.groupBy(*[F.typeof(c).alias(n) for n, c in kinds.items()]).agg(F.count("*").alias("artists"))


_LEGACY_BODY = """
 SELECT a.artist_name, a.musicbrainz_id, a.subgenre, a.country, a.formed_year, a.listeners, a.play_count,
  f.total_albums, f.studio_albums, f.eps, f.singles, f.debut_year, f.last_album_year, f.last_release_date,
  f.avg_years_between_albums, 2002 - f.last_album_year AS years_since_last_release,
  f.last_album_year - a.formed_year AS active_career_years,
  CASE WHEN a.listeners >= 3000000 THEN 'breakout' WHEN a.listeners < 1800000 THEN 'underground' ELSE 'rising' END AS listener_tier,
  CASE WHEN 2002 - f.last_album_year <= 3 THEN CASE WHEN a.listeners >= 2400000 THEN 'Active Giants' ELSE 'Hustling' END
   WHEN 2002 - f.last_album_year > 3 THEN CASE WHEN a.listeners >= 2400000 THEN 'Legends' ELSE 'Fading' END END AS legacy_quadrant
 FROM primary_artists a LEFT JOIN album_facts f ON a.name_key = f.name_key"""
LEGACY_SQL = sql(_LEGACY_BODY, "primary_artists", "album_facts")


def legacy(spark, d):
    return catalogue.album_legacy(shapes.artists(spark, d), shapes.albums(spark, d), CHECK_SETTINGS)


@check("s9_view_and_table", LEGACY_SQL)
def s9(spark, d):
    staged = marts.stage_view(shapes.artists(spark, d), "stg_artists")
    built = catalogue.album_legacy(staged, shapes.albums(spark, d), CHECK_SETTINGS)
    return marts.materialize(built, scratch_path(spark, "gold"), "mart_album_legacy")


@check("s10_export_csv", sql("""
 SELECT 'mart_album_legacy' AS mart, count(*) AS records FROM primary_artists
 UNION ALL SELECT 'mart_artist_features', count(*) FROM features
 UNION ALL SELECT 'mart_subgenre_health', count(DISTINCT subgenre) FROM artists""", "features"))
def s10(spark, d):
    base, arts = scratch_path(spark, "export"), shapes.artists(spark, d)
    frames = {
        "mart_album_legacy": legacy(spark, d),
        "mart_artist_features": shapes.features(spark, d),
        "mart_subgenre_health": health.subgenre_health(arts, CHECK_SETTINGS),
    }
    out = None
    for name, frame in frames.items():
        path = marts.export_csv(frame.select(*columns_of(MARTS[name])), f"{base}/{name}")
        one = marts.read_csv(spark, path, name).agg(F.count("*").alias("records")).withColumn("mart", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return out


# CSV does not tell an empty text from a missing one: both come back as null.
@check("s11_read_csv", f"SELECT * REPLACE (nullif(last_release_date, '') AS last_release_date) FROM ({LEGACY_SQL})")
def s11(spark, d):
    path = marts.export_csv(legacy(spark, d), scratch_path(spark, "legacy-csv"))
    return marts.read_csv(spark, path, "mart_album_legacy")


def popularity_records(spark, d):
    return table(spark, d, "part").selectExpr(
        "concat('rec-', cast(p_partkey as string)) as record",
        "case when p_partkey % 7 <> 0 then cast(p_partkey as string) end as id",
        "case when p_partkey % 3 <> 0 then cast(p_size as bigint) end as popularity",
        "'profiles' as source",
        "lower(p_type) as subgenre",
        "'1999-06-17' as date",
    )


def full_profiles(spark, d):
    """Quantity shipped per part, as the profile fetched by id."""
    return table(spark, d, "lineitem").groupBy(F.col("l_partkey").cast("string").alias("id")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("popularity")
    )


FILLED_SQL = """
 SELECT 'rec-' || p_partkey AS record, CASE WHEN p_partkey % 7 <> 0 THEN CAST(p_partkey AS VARCHAR) END AS id,
  CASE WHEN p_partkey % 3 <> 0 THEN p_size WHEN p_partkey % 7 <> 0 THEN q END AS popularity
 FROM part LEFT JOIN (SELECT l_partkey, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q FROM lineitem GROUP BY 1) ON l_partkey = p_partkey"""


@check("s13_rewrite_raw_partitions", FILLED_SQL)
def s13(spark, d):
    base, name = scratch_path(spark, "bronze"), "profiles"
    bronze.write_bronze(popularity_records(spark, d), base, name)
    full = full_profiles(spark, d)
    bronze.rewrite_partitions(spark, base, name, lambda df: fill_missing(df, full, "id", "popularity").drop("filled"))
    return bronze.read_bronze(spark, base, name).select("record", "id", "popularity")


@check("s14_list_objects", "SELECT lower(p_type) AS subgenre, true AS has_bytes FROM part GROUP BY 1")
def s14(spark, d):
    base = land(spark, d, "artist_info")
    files = bronze.list_objects(spark, f"{base}/artist_info")
    return files.groupBy(F.regexp_extract("path", "subgenre=([^/]+)", 1).alias("subgenre")).agg(
        (F.sum("bytes") > 0).alias("has_bytes")
    )
