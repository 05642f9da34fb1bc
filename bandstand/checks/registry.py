"""Registered queries: a Spark function over ``(spark, sf_dir)`` and, where SQL can say it, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        assert name not in QUERIES, name
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add
