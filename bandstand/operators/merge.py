"""Lookups and enrichment joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bandstand.functions.ranking import first_per_key, last_per_key
from bandstand.functions.similarity import token_sort_ratio
from bandstand.functions.tiers import match_status
from bandstand.runtime import Scratch
from bandstand.settings import DEFAULTS, Settings

ACCEPTED = "auto_accepted"


def stored_lookup(df: DataFrame) -> DataFrame:
    """A lookup with one row per key, written down once.

    Read back, it is shuffled for the join alone (or broadcast, if its size is small), so adaptive execution can
    split the rows of a hot key on the other side over many tasks. Joined as the window leaves it, it could not.
    """
    return Scratch(df.sparkSession, "lookup").write(df)


def metadata_lookup(metadata: DataFrame, order: list[str], within: tuple[str, ...] = ("subgenre", "date")) -> DataFrame:
    """One metadata row per exact artist name: the last one landed."""
    named = metadata.where(F.coalesce("lastfm_name", F.lit("")) != "")
    return last_per_key(named, [*within, "lastfm_name"], order)


def merge_metadata(
    artists: DataFrame, metadata: DataFrame, order: list[str], within: tuple[str, ...] = ("subgenre", "date")
) -> DataFrame:
    """Add the accepted metadata of the exact same name; everything else stays null.

    On an accepted match the formed year is replaced even by null; otherwise the year from the text
    stays.
    """
    keys = [*within, "lastfm_name"]
    lookup = metadata_lookup(metadata, order, within).where(F.col("resolution_status") == ACCEPTED)
    found = lookup.select(
        *keys,
        F.lit(True).alias("_hit"),
        "mbid",
        "mb_name",
        "country",
        F.col("formed_year").alias("_year"),
        F.col("similarity_score").alias("mb_resolution_score"),
    )
    year = F.when(F.col("_hit"), F.col("_year")).otherwise(F.col("formed_year")).cast("double")
    return artists.join(found, keys, "left").withColumn("formed_year", year).drop("_hit", "_year")


def info_of_listed(listed: DataFrame, info: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The info record of each listed, named artist; artists without one are left out.

    Info is reduced to the last record per key, so a name that is landed often on both sides does not
    multiply.
    """
    return listed.where(F.coalesce("name", F.lit("")) != "").join(stored_lookup(last_per_key(info, keys, order)), keys, "inner")


def exact_then_folded(left: DataFrame, lookup: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Look a name up as it is written, else in lower case (last lookup row wins in both).

    The two lookups are reduced to one row per key before they are joined.
    """
    named = lookup.where(F.coalesce(F.col(key), F.lit("")) != "")
    rest = [c for c in lookup.columns if c not in (key, *order)]
    exact = stored_lookup(
        last_per_key(named, [key], order).select(F.col(key).alias("_exact"), F.struct(*rest).alias("_by_name"))
    )
    folded = stored_lookup(
        last_per_key(named.withColumn("_folded", F.lower(key)), ["_folded"], order).select("_folded", F.struct(*rest).alias("_by_fold"))
    )
    hit = F.coalesce("_by_name", "_by_fold")
    return (
        left.join(exact, F.col(key) == F.col("_exact"), "left")
        .join(folded, F.lower(key) == F.col("_folded"), "left")
        .select(*left.columns, hit.alias("_hit"))
        .select(*left.columns, "_hit.*")
    )


def resolve_profiles(artists: DataFrame, profiles: DataFrame, order: list[str], s: Settings = DEFAULTS) -> DataFrame:
    """Match artists to landed profile records by name and grade each match.

    ``profiles`` has ``lastfm_name`` (the name searched for) and ``match`` (the record found).
    """
    hit = exact_then_folded(artists, profiles.select("lastfm_name", "match", *order), "lastfm_name", order)
    score = token_sort_ratio(F.col("lastfm_name"), F.coalesce("match.name", F.lit("")))
    graded = hit.withColumn("_score", F.when(F.col("match").isNotNull(), score))
    return graded.select(
        *artists.columns,
        F.col("match.id").alias("spotify_id"),
        F.col("match.name").alias("spotify_name"),
        F.col("match.popularity").alias("spotify_popularity"),
        F.col("match.followers").alias("spotify_followers"),
        F.coalesce("match.genres", F.array().cast("array<string>")).alias("spotify_genres"),
        match_status(F.col("_score"), s).alias("entity_resolution_status"),
        F.coalesce(F.bround("_score", 2), F.lit(0.0)).alias("entity_resolution_score"),
    )


def attach_by_id(tracks: DataFrame, features: DataFrame, track_id: str, feature_id: str, name: str, order: list[str]) -> DataFrame:
    """Embed the feature record with the track's id; unknown ids get null, null lookups are dropped."""
    known = last_per_key(features.where(F.col(feature_id).isNotNull()), [feature_id], order)
    record = stored_lookup(
        known.select(F.col(feature_id).alias("_fid"), F.struct(*[c for c in features.columns if c not in order]).alias(name))
    )
    return tracks.join(record, F.col(track_id) == F.col("_fid"), "left").drop("_fid")


def fill_missing(records: DataFrame, full: DataFrame, key: str, value: str) -> DataFrame:
    """Fill ``value`` from ``full`` where it is null and the record has an id that is known there."""
    new = first_per_key(full.where(F.col(key).isNotNull()), [key], [F.col(value).asc_nulls_last()]).select(
        F.col(key).alias("_key"), F.col(value).alias("_new"), F.lit(True).alias("_hit")
    )
    needs = F.col(value).isNull() & F.col(key).isNotNull() & F.coalesce("_hit", F.lit(False))
    return (
        records.join(stored_lookup(new), F.col(key) == F.col("_key"), "left")
        .withColumn("filled", needs)
        .withColumn(value, F.when(needs, F.col("_new")).otherwise(F.col(value)))
        .drop("_key", "_new", "_hit")
    )


def most_popular(candidates: DataFrame, query: str, order: list[Column]) -> DataFrame:
    """The candidate of each query with the highest popularity (missing counts as 0), first on ties."""
    return first_per_key(candidates, [query], [F.coalesce("popularity", F.lit(0)).desc(), *order])


def expand_tracks(artists: DataFrame, albums: DataFrame, tracks: DataFrame) -> DataFrame:
    """Artist to its albums and singles to their tracks, each track with its context embedded."""
    kept = albums.where(F.col("album_type").isin("album", "single"))
    album = F.struct(
        F.col("album_id").alias("id"),
        F.col("album_name").alias("name"),
        "release_date",
        "album_type",
    )
    return (
        artists.join(kept, "artist_id")
        .withColumn("_album", album)
        .select("artist_id", "lastfm_name", F.struct("artist_id", "artist_name").alias("_artist"), "_album", "album_id")
        .join(tracks, "album_id")
    )


def focus_only(df: DataFrame, column: str, names: tuple[str, ...]) -> DataFrame:
    return df.where(F.col(column).isin(*names))


def denied_out(df: DataFrame, column: str, names: tuple[str, ...]) -> DataFrame:
    """Drop deny-listed names whatever their case; rows without a name stay."""
    return df.where(~F.coalesce(F.lower(column).isin(*names), F.lit(False)))


def with_color(df: DataFrame, colors: dict[str, str], default: str) -> DataFrame:
    table = F.create_map(*[F.lit(x) for kv in colors.items() for x in kv])
    return df.withColumn("color", F.coalesce(F.try_element_at(table, F.col("subgenre")), F.lit(default)))
