"""Raw artist records to typed, floored and de-duplicated rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from bandstand.functions.tags import raw_tags, tag_structs
from bandstand.functions.text import dedupe_key, first_text, founding_year, parse_count, strip_space, truncate
from bandstand.settings import DEFAULTS, Settings

CONTEXT = ["subgenre", "date"]


def flatten_artists(raw: DataFrame, s: Settings = DEFAULTS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Nested raw record to the flat typed record; ``keep`` carries order columns along."""
    last_year = F.lit(s.last_text_year) if s.last_text_year else F.year(F.current_date())
    empty = F.lit("")
    return raw.select(
        strip_space(F.coalesce("name", empty)).alias("lastfm_name"),
        F.coalesce("mbid", empty).alias("lastfm_mbid"),
        parse_count(F.col("stats.listeners")).alias("listeners"),
        parse_count(F.col("stats.playcount")).alias("play_count"),
        tag_structs(raw_tags(F.col("tags")), F.col("date")).alias("subgenre_tags"),
        F.coalesce("_source_tag", empty).alias("source_tag"),
        founding_year(first_text(F.col("bio.content"), F.col("bio.summary")), s.first_year, last_year).alias(
            "formed_year"
        ),
        truncate(F.coalesce("bio.summary", empty), s.bio_chars).alias("bio_summary"),
        *CONTEXT,
        *keep,
    )


def above_floor(df: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Keep artists at or above the listener floor; unreadable counts go too."""
    return df.where(F.col("listeners") >= s.listener_floor)


def clean_artists(raw: DataFrame, s: Settings = DEFAULTS, keep: tuple[str, ...] = ()) -> DataFrame:
    return above_floor(flatten_artists(raw, s, keep), s)


def deduplicate_artists(df: DataFrame, order: list[str], within: tuple[str, ...] = ("subgenre", "date")) -> DataFrame:
    """One row per artist name: the largest one (first on ties), with the tags of all its copies.

    Each tag is kept once, at its first position and with its last value. ``order`` is the encounter order
    of the records. ``within`` limits the merge to a partition; an empty tuple merges across scenes.

    One pass over the records: tags are exploded and reduced per ``(key, tag)``, and the record itself
    goes with its first tag only. The second step gathers the distinct tags of a key, so a name
    that holds a third of all rows is never gathered row by row.
    """
    keys = [*within, "_key"]
    tags = "subgenre_tags"
    rest = [c for c in df.columns if c not in (tags, *within, *order)]
    smallest = F.lit(-(1 << 62)).cast("bigint")
    record = F.struct(*rest)
    # The record is part of its first tag's entry, or of one entry without a tag; the others hold none.
    tagged = F.transform(
        tags, lambda t, i: F.struct(i.alias("_pos"), t.alias("_tag"), F.when(i == 0, record).alias("_record"))
    )
    tag_type = df.schema[tags].dataType.elementType.simpleString()
    bare = F.array(F.struct(F.lit(None).cast("int").alias("_pos"), F.lit(None).cast(tag_type).alias("_tag"), record.alias("_record")))
    rows = df.withColumn("_key", dedupe_key(F.col("lastfm_name"))).select(
        *keys,
        *order,
        # Smallest first: most listeners, then the order of the records.
        F.struct((-F.coalesce("listeners", smallest)).alias("_less"), *order).alias("_rank"),
        F.inline(F.when(F.coalesce(F.size(tags), F.lit(0)) > 0, tagged).otherwise(bare)),
    )
    carrier = F.coalesce("_pos", F.lit(0)) == 0
    place = F.struct(*order, "_pos")
    per_tag = rows.groupBy(*keys, F.col("_tag.tag").alias("_name")).agg(
        F.min(F.when(F.col("_tag").isNotNull(), place)).alias("_first"),
        F.max_by("_tag", place).alias("_tag"),
        F.min_by("_record", F.when(carrier, F.col("_rank"))).alias("_record"),
        F.min(F.when(carrier, F.col("_rank"))).alias("_rank"),
    )
    gathered = F.array_sort(F.collect_list(F.when(F.col("_first").isNotNull(), F.struct("_first", "_tag"))))
    merged = per_tag.groupBy(*keys).agg(
        F.min_by("_record", "_rank").alias("_record"), F.transform(gathered, lambda x: x["_tag"]).alias(tags)
    )
    return merged.select(*within, tags, "_record.*").select(*[c for c in df.columns if c not in order])


def distinct_last(values: Column, key: str) -> Column:
    """Array of structs with one entry per ``key``: first position, last value."""
    keys = F.array_distinct(F.transform(values, lambda v: v[key]))
    last = F.reverse(values)
    return F.transform(keys, lambda k: F.element_at(F.filter(last, lambda v: v[key] == k), 1))
