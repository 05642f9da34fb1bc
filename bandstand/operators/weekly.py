"""Weekly chart snapshots to one row per artist and week."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from bandstand.functions.dates import week_start

ENTRY = "name STRING, listeners STRING, playcount STRING"


def flatten_weekly(raw: DataFrame) -> DataFrame:
    """Explode the chart entries; ``topartists`` may be an object that holds the list, or the list."""
    # Entries are taken as text first, so that one that is no object drops out alone.
    wrapped = F.from_json("topartists", "artist ARRAY<STRING>")["artist"]
    bare = F.from_json("topartists", "ARRAY<STRING>")
    is_list = F.ltrim("topartists").startswith("[")
    entries = F.transform(F.when(is_list, bare).otherwise(wrapped), lambda e: F.from_json(e, ENTRY))
    rows = (
        raw.where(F.coalesce("_week_start", F.lit("")) != "")
        .select(F.col("_week_start").alias("week_start"), "subgenre", "date", F.explode(entries).alias("e"))
        .where(F.col("e").isNotNull())
    )
    count = F.coalesce(_truthy("e.listeners"), _truthy("e.playcount"))
    return (
        rows.select(
            F.col("e.name").alias("artist_name"),
            "week_start",
            F.trim(count).try_cast("bigint").alias("listeners"),
            "subgenre",
            "date",
        )
        .where((F.coalesce("artist_name", F.lit("")) != "") & F.col("listeners").isNotNull())
    )


def _truthy(column: str):
    return F.nullif(F.col(column), F.lit(""))


def weekly_totals(weekly: DataFrame) -> DataFrame:
    """One row per artist and week, whatever the scene; an artist has one row per calendar week at most."""
    return weekly.groupBy("artist_name", "week_start").agg(F.sum("listeners").alias("listeners"))


def listener_velocity(weekly: DataFrame) -> DataFrame:
    """Change and growth against the artist's previous week on the chart."""
    by_week = W.partitionBy("artist_name").orderBy("week_start")
    before = F.lag("listeners").over(by_week)
    return weekly_totals(weekly).withColumn("previous", before).withColumn("change", F.col("listeners") - F.col("previous"))


def change_around_releases(weekly: DataFrame, albums: DataFrame, weeks: int = 4) -> DataFrame:
    """Listeners in the ``weeks`` before and after each release week.

    Releases are reduced to one row per artist and week, like the chart rows, so both sides of the
    window hold one row per artist and calendar week at most, and no pairs are built. A week that is no
    date lies in no window and drops out.
    """
    totals = weekly_totals(weekly).select("artist_name", "week_start", "listeners", F.lit(0).cast("bigint").alias("releases"))
    released = (
        albums.where(F.try_to_date("first_release_date").isNotNull())
        .withColumn("week_start", week_start(F.try_to_date("first_release_date")))
        .groupBy("artist_name", "week_start")
        .agg(F.count("*").alias("releases"))
        .select("artist_name", "week_start", F.lit(None).cast("bigint").alias("listeners"), "releases")
    )
    merged = (
        totals.unionByName(released)
        .groupBy("artist_name", "week_start")
        .agg(F.sum("listeners").alias("listeners"), F.sum("releases").alias("releases"))
        .withColumn("_day", F.unix_date(F.try_to_date("week_start")))
        .where(F.col("_day").isNotNull())
    )
    span = W.partitionBy("artist_name").orderBy("_day")
    return (
        merged.withColumns(
            {
                "listeners_before": F.sum("listeners").over(span.rangeBetween(-7 * weeks, -1)),
                "listeners_after": F.sum("listeners").over(span.rangeBetween(0, 7 * weeks - 1)),
            }
        )
        .where(F.col("releases") > 0)
        .select("artist_name", F.col("week_start").alias("release_week"), "releases", "listeners_before", "listeners_after")
    )
