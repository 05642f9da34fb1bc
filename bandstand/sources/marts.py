"""Stored marts, CSV exports and run metrics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from bandstand.schemas import MARTS, columns_of

# Values are kept as they are, outer blanks included.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def materialize(df: DataFrame, base: str, mart: str) -> DataFrame:
    """Store a mart as Parquet and give back the stored table."""
    path = f"{base}/{mart}"
    df.select(*columns_of(MARTS[mart])).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(MARTS[mart]).parquet(path)


def stage_view(df: DataFrame, name: str) -> DataFrame:
    """Staging models are views: nothing is stored and Catalyst sees through them."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def export_csv(df: DataFrame, path: str) -> str:
    """CSV with a header, one file per task."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, mart: str) -> DataFrame:
    """An exported mart or result, with its declared schema."""
    return spark.read.options(**CSV_OPTIONS).schema(MARTS[mart]).csv(path)


def append_run_metrics(spark: SparkSession, path: str, run: str, params: dict, metrics: DataFrame) -> DataFrame:
    """Add the one-row metrics frame of a training run, with its parameters, to the metrics table."""
    row = metrics.withColumns(
        {
            "run_name": F.lit(run),
            "logged_at": F.lit(dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)),
            "params": F.create_map(*[F.lit(str(x)) for kv in sorted(params.items()) for x in kv]),
        }
    )
    row.write.mode("append").parquet(path)
    return spark.read.parquet(path)
