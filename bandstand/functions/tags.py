"""Tag arrays: parsing the raw JSON shapes and building validity structs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from bandstand.functions.text import dedupe_key


def one_or_many(json_text: Column, field: str, element: str) -> Column:
    """``field`` of a JSON object as an array, whether it holds a list, one object or nothing."""
    many = F.from_json(json_text, f"{field} ARRAY<{element}>")[field]
    one = F.from_json(json_text, f"{field} {element}")[field]
    return F.filter(F.coalesce(many, F.array(one)), lambda x: x.isNotNull())


def raw_tags(json_text: Column) -> Column:
    return one_or_many(json_text, "tag", "STRUCT<name: STRING>")


def tag_structs(tags: Column, valid_from: Column) -> Column:
    """Open validity interval per named tag; the end stays null until the tag goes away."""
    named = F.filter(tags, lambda t: F.coalesce(t["name"], F.lit("")) != "")
    return F.transform(
        named,
        lambda t: F.struct(
            dedupe_key(t["name"]).alias("tag"),
            valid_from.alias("valid_from"),
            F.lit(None).cast("string").alias("valid_to"),
        ),
    )


def tag_diversity(tags: Column) -> Column:
    return F.size(F.array_distinct(F.transform(tags, lambda t: t["tag"])))
