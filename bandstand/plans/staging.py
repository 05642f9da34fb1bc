"""Staging models: renames, casts and safety filters over the cleaned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from bandstand.sources.silver import latest_snapshot, read_latest


def stage_artists(artists: DataFrame, latest_only: bool = True) -> DataFrame:
    """One row per artist, subgenre (and date, when not only the latest snapshot is wanted)."""
    source = latest_snapshot(artists) if latest_only else artists
    return source.where(F.col("listeners").isNotNull() & (F.col("listeners") > 0)).select(
        F.col("lastfm_name").alias("artist_name"),
        F.col("mbid").alias("musicbrainz_id"),
        F.col("mb_name").alias("musicbrainz_name"),
        F.col("listeners").cast("bigint").alias("listeners"),
        F.col("play_count").cast("bigint").alias("play_count"),
        "subgenre",
        "source_tag",
        *[c for c in ("subgenre_tags",) if c in artists.columns],
        "country",
        F.col("formed_year").cast("int").alias("formed_year"),
        "bio_summary",
        F.col("mb_resolution_score").cast("double").alias("mb_resolution_score"),
        F.col("date").alias("ingestion_date"),
    )


def stage_albums(albums: DataFrame, latest_only: bool = True) -> DataFrame:
    """Titled releases with a date text (an empty one passes)."""
    source = latest_snapshot(albums) if latest_only else albums
    return source.where(F.col("title").isNotNull() & F.col("first_release_date").isNotNull()).select(
        "artist_name",
        "artist_mbid",
        F.col("album_id").alias("musicbrainz_album_id"),
        F.col("title").alias("album_title"),
        F.col("type").alias("album_type"),
        "first_release_date",
        F.col("release_year").cast("int").alias("release_year"),
    )


def stage_stored(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    """Artists and albums of the newest snapshots of the stored tables; their dates come from the folders, not from rows."""
    return stage_artists(read_latest(spark, base, "artists"), latest_only=False), stage_albums(read_latest(spark, base, "albums"), latest_only=False)
