"""String expressions (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the phrase that announces a founding year.
FOUNDING_PHRASE = r"(?i)(?:formed|founded|started|began)[^\d]{0,10}(\d{4})"


def strip_space(c: Column) -> Column:
    """Strip every kind of white space; SQL ``trim`` strips blanks only."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def name_key(c: Column) -> Column:
    """The join key of the marts: blanks trimmed, lower case."""
    return F.lower(F.trim(c))


def dedupe_key(c: Column) -> Column:
    """The key of the cleaning step: all white space stripped, lower case."""
    return F.lower(strip_space(c))


def parse_count(c: Column) -> Column:
    """Count text such as ``"1,234"`` to a long; anything else is null."""
    return strip_space(F.regexp_replace(c, ",", "")).try_cast("bigint")


def first_text(*cols: Column) -> Column:
    """The first column that is neither null nor empty, else the empty string."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], F.lit(""))


def founding_year(c: Column, first_year: int, last_year: Column) -> Column:
    """Year of the first founding phrase in a text, null when out of bounds."""
    year = F.nullif(F.regexp_extract(c, FOUNDING_PHRASE, 1), F.lit("")).try_cast("int")
    return bounded_year(year, F.lit(first_year), last_year)


def bounded_year(year: Column, first_year: Column, last_year: Column) -> Column:
    return F.when(year.between(first_year, last_year), year)


def title_case(c: Column) -> Column:
    """Capitalise each run of letters, so ``nu-metal`` gives ``Nu-Metal`` (``initcap`` would not)."""
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|\P{L}+)"), 1)
    cap = F.transform(runs, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, 2, 1 << 30))))
    return F.array_join(cap, "")


def artist_label(name: Column, subgenre: Column) -> Column:
    return F.concat(name, F.lit(" ("), title_case(subgenre), F.lit(")"))


def millions_label(c: Column) -> Column:
    """``12345678`` to ``12.3M``; ties go to the even digit."""
    return F.format_string("%.1fM", F.bround(c / F.lit(1e6), 1))


def percent_label(c: Column) -> Column:
    return F.format_string("%.1f%%", F.bround(c, 1))


def truncate(c: Column, chars: int) -> Column:
    return F.substring(c, 1, chars)
