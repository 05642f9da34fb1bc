"""Tag history and similar-artist edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from bandstand.runtime import Scratch, folder_names, path_exists

INTERVALS = "artist_name STRING, tag STRING, valid_from STRING, valid_to STRING"


def tag_intervals(snapshots: DataFrame) -> DataFrame:
    """Validity intervals of each artist's tags from dated snapshots (``valid_to`` null: still there).

    An interval ends at the first later snapshot of the artist that lacks the tag. A tag that comes back
    opens a new interval. Every window holds at most one row per snapshot date.
    """
    dates = snapshots.groupBy("artist_name", "date").agg(F.lit(1).alias("_"))
    step = W.partitionBy("artist_name").orderBy("date")
    numbered = dates.select(
        "artist_name", "date", F.row_number().over(step).alias("_n"), F.lead("date").over(step).alias("_next")
    )
    seen = snapshots.select("artist_name", "date", F.explode("tags").alias("tag")).distinct()
    rows = seen.join(numbered, ["artist_name", "date"])
    by_tag = W.partitionBy("artist_name", "tag").orderBy("_n")
    island = F.col("_n") - F.row_number().over(by_tag)
    return (
        rows.withColumn("_island", island)
        .groupBy("artist_name", "tag", "_island")
        .agg(F.min("date").alias("valid_from"), F.max_by("_next", "_n").alias("valid_to"))
        .drop("_island")
    )


def extend_intervals(open_intervals: DataFrame, snapshot: DataFrame, date: str) -> DataFrame:
    """The open intervals after one more snapshot, of a later day than all before; the ones it ends have ``valid_to``.

    A tag that an artist of the snapshot no longer has ends on its date, a tag that was not open begins there. Artists
    without a row in the snapshot keep theirs. Only open intervals and one day are read, however long the history is.
    A null artist has no history; a null tag is a tag like any other; rows may repeat.
    """
    named = snapshot.where(F.col("artist_name").isNotNull())
    present = named.select("artist_name").distinct().withColumn("_present", F.lit(True))
    before = open_intervals.join(present, "artist_name", "left").select(
        "artist_name", "tag", "valid_from", F.coalesce("_present", F.lit(False)).alias("_present"), F.lit(False).alias("_seen")
    )
    now = named.select("artist_name", F.explode("tags").alias("tag")).select(
        "artist_name", "tag", F.lit(None).cast("string").alias("valid_from"), F.lit(True).alias("_present"), F.lit(True).alias("_seen")
    )
    return (
        before.unionByName(now)
        .groupBy("artist_name", "tag")
        .agg(F.min("valid_from").alias("valid_from"), F.bool_or("_present").alias("_present"), F.bool_or("_seen").alias("_seen"))
        .select(
            "artist_name",
            "tag",
            F.coalesce("valid_from", F.lit(date)).alias("valid_from"),
            F.when(F.col("_present") & ~F.col("_seen"), F.lit(date)).alias("valid_to"),
        )
    )


def store_day(spark: SparkSession, base: str, snapshot: DataFrame, date: str) -> None:
    """Merge the snapshot of one day into the stored tag history; days have to come in order.

    ``ended/date=`` holds what ended on a day, ``open/date=`` what was open after it. Both folders of the day are
    overwritten, so a day that failed or is repeated does no harm; the open ones come last and make the day whole.
    A day before the newest stored one is refused: the days after it would have to be merged again.
    """
    stored = _whole_days(spark, base)
    if stored and stored[-1] > date:
        raise ValueError(f"{date} comes before the stored {stored[-1]}")
    earlier = [day for day in stored if day < date]
    after = f"{base}/open/date={date}"
    was_open = (
        spark.read.schema(INTERVALS).parquet(f"{base}/open/date={earlier[-1]}") if earlier else spark.createDataFrame([], INTERVALS)
    )
    scratch = Scratch(spark, "tag-history")
    merged = scratch.write(extend_intervals(was_open, snapshot, date))
    merged.where(F.col("valid_to").isNotNull()).write.mode("overwrite").parquet(f"{base}/ended/date={date}")
    merged.where(F.col("valid_to").isNull()).write.mode("overwrite").parquet(after)
    scratch.drop(merged)


def stored_intervals(spark: SparkSession, base: str) -> DataFrame:
    """The whole tag history: all that ended by the newest whole day and all that is open after it."""
    days = _whole_days(spark, base)
    if not days:
        return spark.createDataFrame([], INTERVALS)
    ended = spark.read.schema(INTERVALS).parquet(*[f"{base}/ended/date={day}" for day in days])
    return ended.unionByName(spark.read.schema(INTERVALS).parquet(f"{base}/open/date={days[-1]}"))


def _whole_days(spark: SparkSession, base: str) -> list[str]:
    days = folder_names(spark, f"{base}/open", "date=")
    return [day.removeprefix("date=") for day in days if path_exists(spark, f"{base}/open/{day}/_SUCCESS")]


def similar_edges(info: DataFrame) -> DataFrame:
    """Directed edges from landed similar-artist lists (``name``, ``similar`` array of names)."""
    return (
        info.select(F.col("name").alias("src"), F.explode("similar").alias("dst"))
        .where((F.coalesce("dst", F.lit("")) != "") & (F.col("src") != F.col("dst")))
        .distinct()
    )


def edge_degrees(edges: DataFrame) -> DataFrame:
    """Out- and in-degree per artist."""
    ends = F.array(
        F.struct(F.col("src").alias("name"), F.lit(1).alias("out"), F.lit(0).alias("into")),
        F.struct(F.col("dst").alias("name"), F.lit(0).alias("out"), F.lit(1).alias("into")),
    )
    return (
        edges.select(F.inline(ends)).groupBy("name").agg(F.sum("out").alias("out_degree"), F.sum("into").alias("in_degree"))
    )
