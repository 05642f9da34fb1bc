"""Raw landing zone to cleaned tables, all subgenres in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bandstand.functions.dates import release_year
from bandstand.operators.cleaning import clean_artists, deduplicate_artists
from bandstand.operators.merge import merge_metadata
from bandstand.settings import DEFAULTS, Settings


def build_artists(info: DataFrame, metadata: DataFrame, order: list[str], s: Settings = DEFAULTS) -> DataFrame:
    """Clean, floor, de-duplicate per scene and merge the accepted metadata."""
    cleaned = clean_artists(info, s, keep=tuple(order))
    return merge_metadata(deduplicate_artists(cleaned, order), metadata, order)


def build_albums(raw: DataFrame) -> DataFrame:
    """Add the release year and give the release id its table name."""
    return raw.select(
        "artist_name",
        "artist_mbid",
        F.col("mbid").alias("album_id"),
        "title",
        "type",
        "first_release_date",
        release_year(F.col("first_release_date")).cast("bigint").alias("release_year"),
        "subgenre",
        "date",
    )
