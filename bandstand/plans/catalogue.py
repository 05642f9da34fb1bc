"""Per-artist marts: album legacy and the model's feature table.

Both are the same shape: album facts per normalised name, the largest row per normalised name, and a left
join on that name. All three steps hash on the same key, so the join adds no shuffle of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bandstand.functions.dates import years_since
from bandstand.functions.numbers import cadence, plays_per_listener
from bandstand.functions.ranking import first_per_key
from bandstand.functions.text import name_key
from bandstand.functions.tiers import breakout_label, legacy_quadrant, listener_tier
from bandstand.settings import DEFAULTS, Settings

KEY = "_name_key"

# The order in which the marts are read.
MART_ORDER = {
    "mart_subgenre_health": ["total_listeners", "subgenre"],
    "mart_album_legacy": ["listeners", "artist_name"],
    "mart_artist_features": ["current_listeners", "artist_name"],
}


def album_facts(albums: DataFrame) -> DataFrame:
    """Release counts and years per normalised artist name."""
    kind = F.col("album_type")
    return (
        albums.groupBy(name_key(F.col("artist_name")).alias(KEY))
        .agg(
            F.count("*").alias("total_albums"),
            F.min("release_year").alias("debut_year"),
            F.max("release_year").alias("last_album_year"),
            F.max("first_release_date").alias("last_release_date"),
            F.count_if(kind == "Album").alias("studio_albums"),
            F.count_if(kind == "EP").alias("eps"),
            F.count_if(kind == "Single").alias("singles"),
        )
        .withColumn(
            "avg_years_between_albums",
            cadence(F.col("total_albums"), F.col("debut_year"), F.col("last_album_year")),
        )
    )


def primary_artists(artists: DataFrame) -> DataFrame:
    """One row per normalised name: most listeners, then subgenre and spelling in order."""
    keyed = artists.withColumn(KEY, name_key(F.col("artist_name")))
    return first_per_key(keyed, [KEY], [F.col("listeners").desc(), F.col("subgenre"), F.col("artist_name")])


def with_album_facts(artists: DataFrame, albums: DataFrame) -> DataFrame:
    return primary_artists(artists).join(album_facts(albums), KEY, "left")


def album_legacy(artists: DataFrame, albums: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    since = years_since(F.col("last_album_year"), s.as_of_year)
    return with_album_facts(artists, albums).select(
        "artist_name", "musicbrainz_id", "subgenre", "country", "formed_year", "listeners", "play_count",
        "total_albums", "studio_albums", "eps", "singles", "debut_year", "last_album_year",
        "last_release_date", "avg_years_between_albums",
        since.alias("years_since_last_release"),
        (F.col("last_album_year") - F.col("formed_year")).alias("active_career_years"),
        listener_tier(F.col("listeners"), s).alias("listener_tier"),
        legacy_quadrant(since, F.col("listeners"), s).alias("legacy_quadrant"),
    )


def artist_features(
    artists: DataFrame, albums: DataFrame, s: Settings = DEFAULTS, labelled_only: bool = True
) -> DataFrame:
    """Feature table. ``labelled_only`` leaves the ambiguous band out; scoring reads all rows."""
    zero = F.lit(0).cast("bigint")
    table = with_album_facts(artists, albums).select(
        "artist_name", "musicbrainz_id", "subgenre", "country", "formed_year", "mb_resolution_score",
        years_since(F.col("formed_year"), s.as_of_year).alias("band_age_years"),
        F.coalesce("total_albums", zero).alias("total_albums"),
        F.coalesce("studio_albums", zero).alias("studio_albums"),
        "debut_year",
        F.col("last_album_year").alias("latest_album_year"),
        "avg_years_between_albums",
        years_since(F.col("last_album_year"), s.as_of_year).alias("years_since_last_release"),
        F.col("listeners").alias("current_listeners"),
        "play_count",
        plays_per_listener(F.col("play_count"), F.col("listeners")).alias("plays_per_listener"),
        breakout_label(F.col("listeners"), s).alias("is_breakout"),
    )
    return table.where(F.col("is_breakout").isNotNull()) if labelled_only else table


def in_mart_order(df: DataFrame, mart: str) -> DataFrame:
    """Stored tables have no order; apply the mart's order when it is read."""
    value, tie = MART_ORDER[mart]
    return df.orderBy(F.col(value).desc(), F.col(tie))
