"""Classification expressions. Each takes its thresholds from ``Settings``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from bandstand.settings import DEFAULTS, Settings


def listener_tier(listeners: Column, s: Settings = DEFAULTS) -> Column:
    return (
        F.when(listeners >= s.breakout_listeners, "breakout")
        .when(listeners < s.underground_listeners, "underground")
        .otherwise("rising")
    )


def breakout_label(listeners: Column, s: Settings = DEFAULTS) -> Column:
    """1 / 0, and null in the ambiguous band between the two thresholds."""
    return F.when(listeners >= s.breakout_listeners, 1).when(listeners < s.underground_listeners, 0)


def legacy_quadrant(years_dormant: Column, listeners: Column, s: Settings = DEFAULTS) -> Column:
    active, big = years_dormant <= s.dormancy_years, listeners >= s.giant_listeners
    return (
        F.when(active & big, "Active Giants")
        .when(~active & big, "Legends")
        .when(active & ~big, "Hustling")
        .when(~active & ~big, "Fading")
    )


def engagement_quadrant(engaged: Column, large: Column) -> Column:
    return (
        F.when(engaged & large, "Giants")
        .when(engaged, "Cult Heroes")
        .when(large, "Mainstream")
        .otherwise("Struggling")
    )


def prediction_tier(listeners: Column, s: Settings = DEFAULTS) -> Column:
    """Right-closed bins, unlike ``listener_tier``: a value on a threshold belongs below it."""
    return (
        F.when(listeners <= 0, None)
        .when(listeners <= s.underground_listeners, "Underground")
        .when(listeners <= s.breakout_listeners, "Rising")
        .when(listeners.isNotNull(), "Breakout")
    )


def match_status(score: Column, s: Settings = DEFAULTS) -> Column:
    """Tier of an unrounded similarity score; no score means no candidate."""
    return (
        F.when(score >= s.accept_score, "auto_accepted")
        .when(score >= s.review_score, "review_required")
        .otherwise("rejected")
    )
