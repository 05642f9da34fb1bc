"""First row per key, as a window that Spark prunes before the shuffle.

``row_number() == 1`` becomes a ``WindowGroupLimit`` in the plan: each map task keeps one row per key, so
a key that holds a third of the table still sends only one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return top_per_key(df, keys, order, 1)


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str = "_rn") -> DataFrame:
    ranked = df.withColumn(rank, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    kept = ranked.where(F.col(rank) <= n)
    return kept.drop(rank) if rank == "_rn" else kept


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """What a lookup dict built in ``order`` would hold: the last row of each key."""
    return first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order])


def top_factor(values: Column, names: Column) -> Column:
    """Entry of ``names`` at the largest absolute value (first on ties)."""
    at = arg_max_abs(values)
    return F.element_at(names, at)


def arg_max_abs(values: Column) -> Column:
    """1-based position of the largest absolute value, first on ties."""
    sizes = F.transform(values, lambda v: F.abs(v))
    return F.array_position(sizes, F.array_max(sizes)).cast("int")
