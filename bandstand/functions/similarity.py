"""Name similarity: Indel ratio of the token-sorted names, 0 to 100."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import IntegerType

from bandstand.functions.text import dedupe_key


def sorted_tokens(c: Column) -> Column:
    """Lower-cased, stripped, tokens in code-point order and joined by one blank."""
    tokens = F.split(dedupe_key(c), r"(?U)\s+")
    return F.array_join(F.array_sort(tokens), " ")


@F.pandas_udf(IntegerType())
def lcs_length(a: pd.Series, b: pd.Series) -> pd.Series:
    """Longest common subsequence, one machine-wide bit row per string (Hyyro 2004)."""
    return pd.Series([None if x is None or y is None else _lcs(x, y) for x, y in zip(a, b)], dtype="Int32")


def _lcs(a: str, b: str) -> int:
    if a == b:
        return len(a)
    places: dict[str, int] = {}
    for i, ch in enumerate(a):
        places[ch] = places.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & places.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def indel_ratio(a: Column, b: Column) -> Column:
    """100 for equal names; only those that differ are handed to Python."""
    total = F.length(a) + F.length(b)
    differ = F.when(a != b, a)
    ratio = F.lit(200.0) * lcs_length(differ, b) / F.nullif(total, F.lit(0))
    return F.when(a == b, F.lit(100.0)).otherwise(ratio)


def token_sort_ratio(a: Column, b: Column) -> Column:
    return indel_ratio(sorted_tokens(a), sorted_tokens(b))
