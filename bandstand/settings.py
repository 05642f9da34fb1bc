"""Thresholds and fixed values. Every operator takes its thresholds from a ``Settings``."""

from __future__ import annotations

from dataclasses import dataclass

# The scenes the tables are partitioned by.
SUBGENRES = (
    "metalcore",
    "deathcore",
    "melodic metalcore",
    "progressive metal",
    "symphonic metal",
    "djent",
    "nu-metal",
    "black metal",
    "melodic death metal",
)

# Chart colour per scene, and the colour of any other scene.
SUBGENRE_COLORS = {
    "metalcore": "#E63946",
    "deathcore": "#1D3557",
    "melodic metalcore": "#FF6B6B",
    "progressive metal": "#2A9D8F",
    "symphonic metal": "#8338EC",
    "djent": "#FB8500",
    "nu-metal": "#023E8A",
    "black metal": "#212529",
    "melodic death metal": "#457B9D",
}
DEFAULT_COLOR = "#888"

# Lower-cased names left out of the charts.
DENIED_ARTISTS = (
    "justin bieber", "lady gaga", "taylor swift", "rihanna", "beyonce",
    "katy perry", "ariana grande", "drake", "kanye west", "eminem",
)

# Artists whose full discography is kept.
FOCUS_ARTISTS = (
    "Bring Me the Horizon", "Asking Alexandria", "In Flames", "Architects",
    "Spiritbox", "Bad Omens", "Motionless in White", "Parkway Drive",
)
FOCUS_PARTITION = "betrayal_tracker"

# Model inputs, in matrix order.
NUMERIC_FEATURES = (
    "band_age_years",
    "total_albums",
    "studio_albums",
    "avg_years_between_albums",
    "years_since_last_release",
    "plays_per_listener",
    "mb_resolution_score",
)
CATEGORICAL_FEATURES = ("subgenre", "country_encoded")


@dataclass(frozen=True)
class Settings:
    listener_floor: int = 50_000
    breakout_listeners: int = 1_000_000
    underground_listeners: int = 200_000
    giant_listeners: int = 500_000
    dormancy_years: int = 3
    as_of_year: int = 2026
    accept_score: float = 90.0
    review_score: float = 70.0
    first_year: int = 1960
    last_text_year: int | None = None  # None: the current year
    last_structured_year: int = 2025
    bio_chars: int = 500
    top_countries: int = 10
    test_share: float = 0.2
    seed: int = 42
    folds: int = 5
    warn_days: int = 8
    error_days: int = 15


DEFAULTS = Settings()
