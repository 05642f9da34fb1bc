"""Declared schemas of every stored table (column types are never inferred)."""

from __future__ import annotations

TAG_STRUCT = "STRUCT<tag: STRING, valid_from: STRING, valid_to: STRING>"

# Raw datasets. ``tags`` and ``topartists`` come in several JSON shapes, so the reader keeps the
# nested text as it is and the cleaning step parses it.
BRONZE = {
    "tag_artists": "name STRING, _seq BIGINT",
    "profiles": "record STRING, id STRING, popularity BIGINT",
    "artist_info": (
        "name STRING, mbid STRING, stats STRUCT<listeners: STRING, playcount: STRING>, tags STRING, "
        "bio STRUCT<summary: STRING, content: STRING>, _source_tag STRING, _seq BIGINT"
    ),
    "weekly_charts": "_week_start STRING, _week_end STRING, topartists STRING, _seq BIGINT",
    "artist_metadata": (
        "lastfm_name STRING, mbid STRING, mb_name STRING, type STRING, country STRING, "
        "formed_year INT, disambiguation STRING, mb_score INT, similarity_score DOUBLE, "
        "resolution_status STRING, _seq BIGINT"
    ),
    "artist_albums": (
        "mbid STRING, title STRING, type STRING, first_release_date STRING, artist_name STRING, "
        "artist_mbid STRING, _seq BIGINT"
    ),
    "match_candidates": (
        "query STRING, pos BIGINT, id STRING, name STRING, type STRING, country STRING, score INT, "
        "life_span_begin STRING, disambiguation STRING"
    ),
}
BRONZE_PARTITIONS = "source STRING, subgenre STRING, date STRING"

SILVER = {
    "artists": (
        "lastfm_name STRING, lastfm_mbid STRING, mbid STRING, mb_name STRING, listeners BIGINT, "
        f"play_count BIGINT, source_tag STRING, subgenre_tags ARRAY<{TAG_STRUCT}>, country STRING, "
        "formed_year DOUBLE, bio_summary STRING, mb_resolution_score DOUBLE"
    ),
    "albums": (
        "artist_name STRING, artist_mbid STRING, album_id STRING, title STRING, type STRING, "
        "first_release_date STRING, release_year BIGINT"
    ),
    "weekly_charts": "artist_name STRING, week_start STRING, listeners BIGINT",
}
SILVER_PARTITIONS = "subgenre STRING, date STRING"

MARTS = {
    "mart_subgenre_health": (
        "subgenre STRING, total_artists BIGINT, total_listeners BIGINT, avg_listeners DOUBLE, "
        "median_listeners BIGINT, p90_listeners BIGINT, max_listeners BIGINT, breakout_artists BIGINT, "
        "rising_artists BIGINT, underground_artists BIGINT, breakout_pct DOUBLE, avg_formed_year DOUBLE, "
        "median_formed_year DOUBLE, oldest_band_year INT, artists_with_formed_year BIGINT, "
        "golden_era_decade INT, golden_era_total_listeners BIGINT, golden_era_artist_count BIGINT, "
        "country_count BIGINT, artists_with_country BIGINT, dominant_country STRING, "
        "dominant_country_listeners BIGINT"
    ),
    "mart_album_legacy": (
        "artist_name STRING, musicbrainz_id STRING, subgenre STRING, country STRING, formed_year INT, "
        "listeners BIGINT, play_count BIGINT, total_albums BIGINT, studio_albums BIGINT, eps BIGINT, "
        "singles BIGINT, debut_year INT, last_album_year INT, last_release_date STRING, "
        "avg_years_between_albums DOUBLE, years_since_last_release INT, active_career_years INT, "
        "listener_tier STRING, legacy_quadrant STRING"
    ),
    "mart_artist_features": (
        "artist_name STRING, musicbrainz_id STRING, subgenre STRING, country STRING, formed_year INT, "
        "mb_resolution_score DOUBLE, band_age_years INT, total_albums BIGINT, studio_albums BIGINT, "
        "debut_year INT, latest_album_year INT, avg_years_between_albums DOUBLE, "
        "years_since_last_release INT, current_listeners BIGINT, play_count BIGINT, "
        "plays_per_listener DOUBLE, is_breakout INT"
    ),
    "breakout_predictions": (
        "artist_name STRING, subgenre STRING, country STRING, formed_year INT, current_listeners BIGINT, "
        "total_albums BIGINT, breakout_probability DOUBLE, top_breakout_factor STRING, "
        "top_factor_shap DOUBLE, current_tier STRING"
    ),
    "shap_importance": "feature STRING, mean_abs_shap DOUBLE",
}
# The columns the model reads from the feature mart.
MODEL_COLUMNS = (
    "artist_name", "subgenre", "country", "formed_year", "band_age_years", "total_albums",
    "studio_albums", "avg_years_between_albums", "years_since_last_release", "plays_per_listener",
    "mb_resolution_score", "current_listeners", "is_breakout",
)


def columns_of(ddl: str) -> list[str]:
    """Top-level column names of a DDL string."""
    names, depth, start = [], 0, True
    for token in ddl.replace("<", " < ").replace(">", " > ").replace(",", " , ").split():
        if token == "<":
            depth += 1
        elif token == ">":
            depth -= 1
        elif token == "," and depth == 0:
            start = True
            continue
        if start and token not in "<>,":
            names.append(token)
            start = False
    return names
