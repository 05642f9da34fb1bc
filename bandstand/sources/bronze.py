"""Raw landing zone: gzipped JSON below ``source=/subgenre=/date=``, one folder per dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bandstand.schemas import BRONZE, BRONZE_PARTITIONS
from bandstand.runtime import path_exists, remove_path, scratch_path

PARTITIONS = ["source", "subgenre", "date"]


class MissingUpstream(FileNotFoundError):
    """A required raw dataset has no rows."""


def write_bronze(df: DataFrame, base: str, dataset: str) -> str:
    """Land raw records as they are; the three partition columns become folders.

    The rebalance hint lets adaptive execution size the write tasks: small partitions get one file, a
    partition that holds a third of all rows is split over many tasks.
    """
    path = f"{base}/{dataset}"
    (
        df.hint("rebalance", *PARTITIONS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS)
        .option("compression", "gzip")
        .json(path)
    )
    return path


def read_bronze(
    spark: SparkSession,
    base: str,
    dataset: str,
    *,
    source: str | None = None,
    subgenre: str | None = None,
    date: str | None = None,
    json_arrays: bool = False,
) -> DataFrame:
    """Declared-schema read with partition pruning; a partition that is not there gives no rows.

    ``json_arrays`` reads files that hold one JSON array each. ``_file`` and ``_row`` give the order
    of the records within their file (a gzip file is read by one task, front to back).
    """
    schema = f"{BRONZE[dataset]}, {BRONZE_PARTITIONS}"
    path = f"{base}/{dataset}"
    df = (
        spark.read.schema(schema)
        .option("multiLine", str(json_arrays).lower())
        .option("ignoreMissingFiles", "true")
        .json(path)
        if path_exists(spark, path)
        else spark.createDataFrame([], schema)
    )
    for column, value in (("source", source), ("subgenre", subgenre), ("date", date)):
        if value is not None:
            df = df.where(F.col(column) == value)
    return df


def with_record_order(df: DataFrame) -> DataFrame:
    """Add the encounter order of file records: file, block in it, row in it."""
    return df.withColumns(
        {
            "_file": F.col("_metadata.file_path"),
            "_block": F.col("_metadata.file_block_start"),
            "_row": F.monotonically_increasing_id(),
        }
    )


def read_tag_artists(spark: SparkSession, base: str, **part: str) -> DataFrame:
    return read_bronze(spark, base, "tag_artists", **part)


def read_artist_info(spark: SparkSession, base: str, **part: str) -> DataFrame:
    return read_bronze(spark, base, "artist_info", **part)


def read_weekly_charts(spark: SparkSession, base: str, **part: str) -> DataFrame:
    return read_bronze(spark, base, "weekly_charts", **part)


def read_artist_metadata(spark: SparkSession, base: str, **part: str) -> DataFrame:
    return read_bronze(spark, base, "artist_metadata", **part)


def read_artist_albums(spark: SparkSession, base: str, **part: str) -> DataFrame:
    return read_bronze(spark, base, "artist_albums", **part)


def require(df: DataFrame, what: str) -> DataFrame:
    """Fail when an upstream dataset is missing (``isEmpty`` reads one row)."""
    if df.isEmpty():
        raise MissingUpstream(f"{what}: nothing landed; run its ingestion first")
    return df


def rewrite_partitions(spark: SparkSession, base: str, dataset: str, change, **part: str) -> None:
    """Read, change and replace exactly the partitions that ``part`` names, for example a subgenre and a day.

    Spark cannot overwrite files it is reading, so the changed rows are written beside the table first;
    after a failure in the second step the staged copy is whole and the step can be repeated. A partition
    that the change leaves without rows goes.
    """
    rows = read_bronze(spark, base, dataset, **part)
    # One row per folder that is about to be replaced.
    before = {tuple(r) for r in rows.select(*PARTITIONS).distinct().collect()}
    staged = scratch_path(spark, f"staged-{dataset}")
    write_bronze(change(rows), staged, dataset)
    changed = read_bronze(spark, staged, dataset)
    after = {tuple(r) for r in changed.select(*PARTITIONS).distinct().collect()}
    write_bronze(changed, base, dataset)
    for gone in before - after:
        folder = "/".join(f"{name}={_escaped(spark, value)}" for name, value in zip(PARTITIONS, gone))
        remove_path(spark, f"{base}/{dataset}/{folder}")
    remove_path(spark, staged)


def _escaped(spark: SparkSession, value: str | None) -> str:
    """A partition value as it stands in a folder's name."""
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "__HIVE_DEFAULT_PARTITION__" if value is None else names.escapePathName(value)


def list_objects(spark: SparkSession, path: str) -> DataFrame:
    """Landed files and their sizes; the file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", F.col("length").alias("bytes"))
    )


def first_containing(df: DataFrame, column: str, text: str, order: list[Column]) -> DataFrame:
    """The first record whose column contains ``text``, else the first record."""
    hit = F.coalesce(F.col(column).contains(text), F.lit(False))
    return df.orderBy(hit.desc(), *order).limit(1)
