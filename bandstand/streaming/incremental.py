"""Incremental cleaning: newly landed raw files are picked up once each, by their checkpoint."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bandstand.operators.cleaning import clean_artists, deduplicate_artists
from bandstand.operators.merge import merge_metadata
from bandstand.plans.silver_build import build_artists
from bandstand.runtime import path_exists
from bandstand.schemas import BRONZE, BRONZE_PARTITIONS
from bandstand.settings import DEFAULTS, Settings
from bandstand.sources import bronze as landing, silver

ORDER = ["_seq"]
FILE_ORDER = ["_file", "_block", "_row"]


def clean_new_files(spark: SparkSession, bronze: str, cleaned: str, checkpoint: str, s: Settings = DEFAULTS) -> None:
    """Clean every raw artist file that has not been seen and append it to the cleaned table.

    Parsing and the listener floor look at one record at a time, so the stream keeps no state; the file
    sink commits each batch once, also after a restart.
    """
    stream = spark.readStream.schema(f"{BRONZE['artist_info']}, {BRONZE_PARTITIONS}").json(f"{bronze}/artist_info")
    query = (
        clean_artists(stream, s, keep=tuple(ORDER))
        .writeStream.format("parquet")
        .option("path", cleaned)
        .option("checkpointLocation", checkpoint)
        .partitionBy("subgenre", "date")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def publish(cleaned: DataFrame, metadata: DataFrame, since: str | None = None) -> DataFrame:
    """De-duplicated and merged artists of the cleaned partitions from ``since`` on (pruned by date)."""
    rows = cleaned.where(F.col("date") >= since) if since else cleaned
    return merge_metadata(deduplicate_artists(rows, ORDER), metadata, ORDER)


def rebuild_touched(spark: SparkSession, raw: str, cleaned: str, checkpoint: str, s: Settings = DEFAULTS) -> None:
    """Keep the cleaned artist table up to date with the landed files: each micro-batch rebuilds what it touches.

    The stream only says which partitions got files. These are built anew from all their landed records, de-duplicated
    and merged, and replace the stored ones; all other partitions stay as they are. So the table equals one full build,
    in whatever pieces the files landed, and a batch that is repeated after a failure gives the same partitions once
    more. Records are ordered by file and place in it. Metadata that lands later counts when its partition is
    touched next. A partition whose records all miss the floor is not stored.
    """
    stream = spark.readStream.schema(f"{BRONZE['artist_info']}, {BRONZE_PARTITIONS}").json(f"{raw}/artist_info")

    def rebuild(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        # One row per folder that got files.
        touched = [(r["subgenre"], r["date"]) for r in batch.select(*silver.PARTITIONS).distinct().collect()]
        if not touched:
            return
        info = landing.with_record_order(landing.read_artist_info(session, raw).where(_in_partitions(touched)))
        metadata = landing.read_artist_metadata(session, raw)
        if path_exists(session, f"{raw}/artist_metadata"):
            metadata = landing.with_record_order(metadata)
        else:  # nothing landed: no files to take an order from
            metadata = metadata.selectExpr("*", "'' as _file", "0L as _block", "0L as _row")
        silver.write_silver(build_artists(info, metadata, FILE_ORDER, s), cleaned, "artists")

    query = (
        stream.select(*silver.PARTITIONS)
        .writeStream.foreachBatch(rebuild)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _in_partitions(parts: list[tuple[str | None, str | None]]) -> Column:
    """Rows of the given subgenres and dates, nulls included: a filter on folders."""
    wanted = silver.on_dates([(subgenre, date) for subgenre, date in parts if subgenre is not None and date is not None])
    for subgenre, date in parts:
        if subgenre is None or date is None:
            wanted = wanted | (F.col("subgenre").eqNullSafe(F.lit(subgenre)) & F.col("date").eqNullSafe(F.lit(date)))
    return wanted
