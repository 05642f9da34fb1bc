"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def to_number(c: Column) -> Column:
    """Numeric cast that turns bad text into null instead of failing."""
    return c.try_cast("double")


def cast_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    """Cast the listed columns that exist; bad values become null."""
    return df.withColumns({c: to_number(F.col(c)) for c in cols if c in df.columns})


def decade(year: Column) -> Column:
    return (F.floor(year / 10) * 10).cast("int")


def clip(c: Column, low: float, high: float) -> Column:
    """Clip to a range; null stays null (``greatest`` and ``least`` would skip it)."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def clip_or(c: Column, low: float, high: float, default: float) -> Column:
    return F.coalesce(clip(c, low, high), F.lit(default))


def round_even(c: Column, digits: int) -> Column:
    return F.bround(c, digits)


def plays_per_listener(plays: Column, listeners: Column) -> Column:
    return F.when(listeners > 0, F.round(plays.cast("double") / listeners, 1))


def share_pct(part: Column, whole: Column) -> Column:
    return F.round(part.cast("double") / whole * 100, 1)


def cadence(n: Column, first: Column, last: Column) -> Column:
    """Mean gap between n releases; null for a single one."""
    return F.when(n > 1, (last - first).cast("double") / (n - 1))


def log_bound(c: Column, factor: float) -> Column:
    return F.log10(c * F.lit(factor))
