"""Data-quality checks, profiles and stage counts as result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bandstand.functions.text import dedupe_key
from bandstand.operators.merge import ACCEPTED
from bandstand.settings import DEFAULTS, Settings

# The not-null promises of the stored tables.
NOT_NULL = {"artists": ["lastfm_name", "listeners"], "albums": ["artist_name", "title"]}


def not_null_check(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """One row per column: how many rows break the promise, and whether the check passes. One pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in columns])
    return (
        counts.select(F.inline(rows))
        .withColumn("table_name", F.lit(table))
        .withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))
    )


def freshness(df: DataFrame, as_of: Column, s: Settings = DEFAULTS) -> DataFrame:
    """Age of the newest partition date, graded; a newest date that cannot be read is an error."""
    age = F.datediff(as_of, F.try_to_date("newest"))
    return df.agg(F.max("date").alias("newest")).select(
        "newest",
        age.alias("age_days"),
        F.when(age.isNull() & F.col("newest").isNotNull(), "error").when(age > s.error_days, "error").when(age > s.warn_days, "warn").otherwise("pass").alias("status"),
    )


def non_null_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Row count and non-null count per column, in one pass."""
    counts = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("non_null")) for c in columns])
    return counts.select(F.col("_rows").alias("total_rows"), F.inline(rows))



def stage_counts(raw_flat: DataFrame, metadata: DataFrame, order: list[str], s: Settings = DEFAULTS) -> DataFrame:
    """Rows read, above the floor, after de-duplication and merged, per subgenre and date.

    ``raw_flat`` is the flattened raw table before the floor, ``metadata`` the lookup with one row per name and
    date, ``order`` the encounter order of the records. The raw rows are reduced to one row per artist key and
    date first; only those are joined and counted again. A match without an id counts as not merged.
    """
    passes = F.col("listeners") >= s.listener_floor
    per_key = (
        raw_flat.withColumn("_key", dedupe_key(F.col("lastfm_name")))
        .groupBy("subgenre", "date", "_key")
        .agg(
            F.count("*").alias("n_read"),
            F.count_if(passes).alias("n_floor"),
            F.max_by(F.when(passes, F.col("lastfm_name")), F.struct(F.coalesce(F.when(passes, F.col("listeners")), F.lit(-1)), *[-F.col(c) for c in order])).alias("lastfm_name"),
        )
    )
    accepted = metadata.where((F.col("resolution_status") == ACCEPTED) & F.col("mbid").isNotNull()).select(
        "subgenre", "date", "lastfm_name", F.lit(1).alias("_hit")
    )
    merged = per_key.join(accepted, ["subgenre", "date", "lastfm_name"], "left")
    return merged.groupBy("subgenre", "date").agg(
        F.sum("n_read").alias("read_rows"),
        F.sum("n_floor").alias("floor_rows"),
        F.count_if(F.col("n_floor") > 0).alias("deduped_rows"),
        F.count_if((F.col("n_floor") > 0) & F.col("_hit").isNotNull()).alias("merged_rows"),
    )


def status_tally(matches: DataFrame) -> DataFrame:
    """Lookups per outcome; a name without any candidate counts as rejected."""
    status = F.coalesce("resolution_status", F.lit("rejected"))
    return matches.groupBy(status.alias("resolution_status")).agg(F.count("*").alias("lookups"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Grain check: keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)
