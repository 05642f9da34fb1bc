"""Datasets behind the four charts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bandstand.functions.numbers import clip, clip_or, log_bound
from bandstand.functions.ordering import exact_medians
from bandstand.functions.text import artist_label, millions_label, percent_label, title_case
from bandstand.functions.tiers import engagement_quadrant
from bandstand.operators.merge import denied_out, with_color
from bandstand.settings import DEFAULT_COLOR, DENIED_ARTISTS, SUBGENRE_COLORS

FLOOR = 50_000
MAX_PLAYS = 500


def golden_era_points(features: DataFrame) -> DataFrame:
    """Scatter of formation year against listeners; dot size is engagement."""
    kept = denied_out(features, "artist_name", DENIED_ARTISTS).dropna(subset=["formed_year", "current_listeners"])
    size = clip_or(F.col("plays_per_listener"), 0.0, 200.0, 20.0)
    return with_color(kept.where(F.col("current_listeners") > FLOOR), SUBGENRE_COLORS, DEFAULT_COLOR).select(
        "artist_name",
        "subgenre",
        title_case(F.col("subgenre")).alias("trace"),
        F.col("formed_year").alias("x"),
        F.col("current_listeners").alias("y"),
        clip(size, 6.0, 28.0).alias("size"),
        "color",
        "plays_per_listener",
        "total_albums",
    )


def golden_era_axis(points: DataFrame) -> DataFrame:
    """Bounds of the logarithmic listener axis."""
    return points.agg(F.max("y").alias("_max")).select(
        F.log10(F.lit(float(FLOOR))).alias("y_low"), log_bound(F.col("_max"), 1.5).alias("y_high")
    )


def engagement_rows(features: DataFrame) -> DataFrame:
    plays = F.col("plays_per_listener")
    kept = denied_out(features, "artist_name", DENIED_ARTISTS).dropna(subset=["plays_per_listener", "current_listeners"])
    return kept.where((F.col("current_listeners") > FLOOR) & (plays > 0) & (plays < MAX_PLAYS))


def engagement_medians(rows: DataFrame) -> DataFrame:
    """One row: the exact medians that cut the chart into quadrants."""
    medians = exact_medians(rows, ["current_listeners", "plays_per_listener"])
    at = lambda name: F.max(F.when(F.col("feature") == name, F.col("median")))
    return medians.agg(
        at("current_listeners").alias("med_listeners"), at("plays_per_listener").alias("med_engagement")
    )


def engagement_points(features: DataFrame) -> DataFrame:
    """Plays per listener against listeners, with the quadrant of each artist."""
    rows = engagement_rows(features)
    medians = engagement_medians(rows).first()
    return rows.select(
        "artist_name",
        "subgenre",
        F.col("plays_per_listener").alias("x"),
        F.col("current_listeners").alias("y"),
        "band_age_years",
        engagement_quadrant(
            F.col("plays_per_listener") >= F.lit(medians["med_engagement"]),
            F.col("current_listeners") >= F.lit(medians["med_listeners"]),
        ).alias("quadrant"),
    )


def engagement_boxes(features: DataFrame) -> DataFrame:
    """The four shaded rectangles and their names, from medians and axis maxima."""
    rows = engagement_rows(features)
    edges = rows.agg(
        (F.max("current_listeners") * 1.3).alias("max_l"), (F.max("plays_per_listener") * 1.1).alias("max_e")
    )
    medians = engagement_medians(rows).first()
    zero, floor = F.lit(0.0), F.lit(float(FLOOR))
    e, l = F.lit(medians["med_engagement"]), F.lit(medians["med_listeners"])

    def box(engaged: bool, large: bool):
        return F.struct(
            engagement_quadrant(F.lit(engaged), F.lit(large)).alias("quadrant"),
            (e if engaged else zero).alias("x0"),
            (F.col("max_e") if engaged else e).alias("x1"),
            (l if large else floor).alias("y0"),
            (F.col("max_l") if large else l).alias("y1"),
        )

    return edges.select(F.inline(F.array(box(True, True), box(False, True), box(True, False), box(False, False))))


def health_bars(health: DataFrame) -> DataFrame:
    """Bars of total listeners and bubbles of breakout rate, smallest scene first."""
    return (
        with_color(health, SUBGENRE_COLORS, DEFAULT_COLOR)
        .select(
            "subgenre",
            title_case(F.col("subgenre")).alias("subgenre_label"),
            "color",
            "total_listeners",
            millions_label(F.col("total_listeners")).alias("bar_text"),
            F.col("golden_era_decade").alias("bubble_x"),
            F.col("breakout_pct").alias("bubble_y"),
            clip(F.col("total_artists").cast("double"), 5.0, 60.0).alias("bubble_size"),
        )
        .orderBy("total_listeners", "subgenre")
    )


def breakout_ranking(predictions: DataFrame, n: int = 20) -> DataFrame:
    """The n underground artists most likely to break out, shown smallest first."""
    top = (
        denied_out(predictions, "artist_name", DENIED_ARTISTS)
        .where(F.col("current_tier") == "Underground")
        .orderBy(F.col("breakout_probability").desc(), "artist_name")
        .limit(n)
    )
    pct = F.col("breakout_probability") * 100
    return (
        with_color(top, SUBGENRE_COLORS, DEFAULT_COLOR)
        .withColumns(
            {
                "prob_pct": pct,
                "prob_text": percent_label(pct),
                "label": artist_label(F.col("artist_name"), F.col("subgenre")),
            }
        )
        .orderBy("breakout_probability", F.col("artist_name").desc())
    )


def legend(points: DataFrame) -> DataFrame:
    """One colour entry per scene that occurs."""
    return points.select(title_case(F.col("subgenre")).alias("trace"), "color").distinct()


def axis_max(points: DataFrame, column: str, factor: float) -> DataFrame:
    return points.agg((F.max(column) * factor).alias("axis_max"))
