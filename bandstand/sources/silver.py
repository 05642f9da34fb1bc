"""Cleaned tables: Parquet below ``subgenre=/date=`` with declared schemas."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bandstand.runtime import folder_names, has_data
from bandstand.schemas import SILVER, SILVER_PARTITIONS, columns_of

PARTITIONS = ["subgenre", "date"]
MOST_LISTED = 1000
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # folder of a null


def write_silver(df: DataFrame, base: str, table: str) -> str:
    """Overwrite the partitions the frame has rows for; without rows nothing is written.

    The rebalance hint lets adaptive execution split a partition that holds a third of all rows over
    many write tasks and gives small partitions one file each.
    """
    path = f"{base}/{table}"
    (
        df.select(*columns_of(SILVER[table]), *PARTITIONS)
        .hint("rebalance", *PARTITIONS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )
    return path


def read_silver(spark: SparkSession, base: str, table: str) -> DataFrame:
    """All subgenres and dates of a table as one relation; ``date`` stays text."""
    return spark.read.schema(f"{SILVER[table]}, {SILVER_PARTITIONS}").parquet(f"{base}/{table}")


def register(spark: SparkSession, base: str, tables: tuple[str, ...] = ("artists", "albums")) -> None:
    """(Re-)create the views over the stored tables."""
    for table in tables:
        read_silver(spark, base, table).createOrReplaceTempView(table)


def create_external_table(spark: SparkSession, base: str, table: str, name: str | None = None) -> None:
    """Drop, create and discover partitions: the catalog variant of ``register``. ``name`` is the table's unless given."""
    name = name or table
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({SILVER[table]}, {SILVER_PARTITIONS}) USING parquet "
        f"PARTITIONED BY ({', '.join(PARTITIONS)}) LOCATION '{base}/{table}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {name}")


def newest_dates(spark: SparkSession, base: str, table: str) -> list[tuple[str, str]]:
    """Newest ``date`` of each ``subgenre`` of a stored table, from the names of its folders: no row is read.

    A folder without data files does not count, nor does the folder of a null. There is one entry per subgenre.
    """
    found = []
    for scene in folder_names(spark, f"{base}/{table}", "subgenre="):
        dates = folder_names(spark, f"{base}/{table}/{scene}", "date=")
        named = sorted(((unquote(x.removeprefix("date=")), x) for x in dates if x != f"date={NO_VALUE}"), reverse=True)
        newest = next((date for date, folder in named if has_data(spark, f"{base}/{table}/{scene}/{folder}")), None)
        if newest is not None and scene != f"subgenre={NO_VALUE}":
            found.append((unquote(scene.removeprefix("subgenre=")), newest))
    return found


def read_latest(spark: SparkSession, base: str, table: str) -> DataFrame:
    """The newest snapshot of each subgenre of a stored table: folders are listed, older ones are never scanned."""
    stored, newest = read_silver(spark, base, table), newest_dates(spark, base, table)
    if len(newest) > MOST_LISTED:
        return stored.join(spark.createDataFrame(newest, "subgenre STRING, date STRING"), PARTITIONS, "left_semi")
    return stored.where(on_dates(newest))


def on_dates(newest: list[tuple[str, str]]) -> Column:
    """Rows of the given subgenres on the given dates: literals that prune folders before the scan."""
    by_date: dict[str, list[str]] = {}
    for subgenre, date in newest:
        by_date.setdefault(date, []).append(subgenre)
    wanted = F.lit(False)
    for date, subgenres in sorted(by_date.items()):
        wanted = wanted | ((F.col("date") == date) & F.col("subgenre").isin(*subgenres))
    return wanted


def latest_snapshot(df: DataFrame) -> DataFrame:
    """Rows of the newest ``date`` of each subgenre of any frame; of a stored table ``read_latest`` finds them cheaper.

    The newest dates are aggregated from the rows while the plan is built: a row per subgenre. As literals in the
    filter they prune the older folders before the scan. With more subgenres than a filter should list, the newest dates
    are joined instead.
    """
    newest = df.where(F.col("subgenre").isNotNull()).groupBy("subgenre").agg(F.max("date").alias("date"))
    rows = newest.limit(MOST_LISTED + 1).collect()
    if len(rows) > MOST_LISTED:
        return df.join(newest, PARTITIONS, "left_semi")
    return df.where(on_dates([(r["subgenre"], r["date"]) for r in rows if r["date"] is not None]))
