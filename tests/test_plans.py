"""Plan shapes that have to hold whatever the data size."""

import re

import pytest
from pyspark.sql import functions as F

from bandstand.checks import QUERIES, shapes
from bandstand.functions.ranking import first_per_key
from bandstand.operators import merge
from bandstand.operators.cleaning import deduplicate_artists
from bandstand.plans import catalogue, health

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["mart_subgenre_health", "mart_album_legacy", "mart_artist_features", "a9_dedupe_artists", "j1_merge_metadata",
     "j8_link_names", "j8_match_landed_candidates", "x1_tag_intervals", "x5_change_around_releases", "v1_golden_era_points"],
)
def test_no_cross_products_and_no_single_task_windows(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # A window over one row per partition (the offsets of running totals) is as small as the number of tasks.
    single = re.findall(r"Window \[(.*)\n(?:.*\n){0,3}.*Exchange SinglePartition", text)
    assert all("[_part#" in window for window in single)


def stored(spark, tmp_path):
    base = str(tmp_path)
    shapes.artists(spark, FOLDER).drop("subgenre_tags").write.parquet(f"{base}/artists")
    shapes.albums(spark, FOLDER).write.parquet(f"{base}/albums")
    return spark.read.parquet(f"{base}/artists"), spark.read.parquet(f"{base}/albums")


def test_legacy_joins_without_an_extra_shuffle(spark, tmp_path):
    artists, albums = stored(spark, tmp_path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(catalogue.album_legacy(artists, albums))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 2  # one per table
    assert "WindowGroupLimit" in text and "SortMergeJoin" in text
    assert "bio_summary" not in text  # unused columns are not read


def test_health_reads_only_what_it_needs(spark, tmp_path):
    artists, _ = stored(spark, tmp_path)
    text = plan(health.subgenre_health(artists))
    assert text.count("FileScan") == 1  # the percentiles read counts that are written down while the plan is built
    for columns in re.findall(r"ReadSchema: struct<(.*?)>", text):
        assert set(re.findall(r"(\w+):", columns)) <= {"subgenre", "listeners", "formed_year", "country"}


def test_filters_reach_the_scan(spark, tmp_path):
    base = f"{tmp_path}/silver"
    shapes.silver_artists(spark, FOLDER).write.partitionBy("subgenre", "date").parquet(base)
    from bandstand.plans.staging import stage_artists

    one = stage_artists(spark.read.parquet(base), latest_only=False).where(F.col("subgenre") == "building")
    text = plan(one.select("artist_name"))
    assert "PushedFilters: [IsNotNull(listeners), GreaterThan(listeners,0)]" in text
    assert "PartitionFilters: [isnotnull(subgenre" in text
    assert "ReadSchema: struct<lastfm_name:string,listeners:bigint>" in text


def test_first_per_key_is_cut_before_the_shuffle(spark):
    df = spark.range(10).withColumn("k", F.col("id") % 2)
    text = plan(first_per_key(df, ["k"], [F.col("id")]))
    assert "row_number(), 1, Partial" in text


def hot_names(spark, n=60_000):
    """A third of the rows under one name, in many partitions."""
    name = F.when(F.col("id") % 3 == 0, F.lit("Hot Name")).otherwise(F.concat(F.lit("n"), F.col("id").cast("string")))
    tag = lambda v: F.struct(v.alias("tag"), F.lit("d").alias("valid_from"), F.lit(None).cast("string").alias("valid_to"))
    return spark.range(0, n, 1, 8).select(
        name.alias("lastfm_name"),
        F.col("id").alias("listeners"),
        F.array(tag(F.concat(F.lit("t"), (F.col("id") % 5).cast("string")))).alias("subgenre_tags"),
        F.lit("s").alias("subgenre"),
        F.lit("d").alias("date"),
        F.col("id").alias("_seq"),
    )


def test_hot_artist_is_merged_from_its_distinct_tags(spark):
    n = 60_000
    out = deduplicate_artists(hot_names(spark, n), ["_seq"])
    assert out.count() == n - n // 3 + 1
    hot = out.where("lastfm_name = 'Hot Name'").first()
    assert hot["listeners"] == n - 3 and [t["tag"] for t in hot["subgenre_tags"]] == ["t0", "t3", "t1", "t4", "t2"]


def test_hot_artist_in_the_marts(spark):
    artists = hot_names(spark).select(
        F.col("lastfm_name").alias("artist_name"), F.lit("m").alias("musicbrainz_id"), "subgenre", F.lit("SE").alias("country"),
        F.lit(1990).alias("formed_year"), F.col("listeners"), F.col("listeners").alias("play_count"),
        F.lit(1.0).alias("mb_resolution_score"),
    )
    albums = hot_names(spark).select(
        F.col("lastfm_name").alias("artist_name"), F.lit("Album").alias("album_type"),
        (F.lit(1990) + F.col("listeners") % 30).cast("int").alias("release_year"), F.lit("1990").alias("first_release_date"),
    )
    out = catalogue.album_legacy(artists, albums)
    hot = out.where("artist_name = 'Hot Name'").collect()
    assert [(r["total_albums"], r["listeners"]) for r in hot] == [(20_000, 59_997)]
    assert out.count() == 40_001


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def skewed(spark):
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("join", ["exact_then_folded", "info_of_listed", "attach_by_id", "fill_missing"])
def test_hot_key_of_a_lookup_is_split(spark, skewed, join):
    n = 120_000
    key = F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id")))
    many = spark.range(0, n, 1, 8).select(key.alias("name"), F.sha2(F.col("id").cast("string"), 256).alias("value"))
    few = spark.range(0, 2_000, 1, 4).select(
        F.when(F.col("id") == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") * 2 + 1)).alias("name"), F.col("id").alias("found"), F.col("id").alias("seq")
    )
    out = {
        "exact_then_folded": lambda: merge.exact_then_folded(many, few, "name", ["seq"]),
        "info_of_listed": lambda: merge.info_of_listed(many, few, ["name"], ["seq"]),
        "attach_by_id": lambda: merge.attach_by_id(many, few, "name", "name", "record", ["seq"]),
        "fill_missing": lambda: merge.fill_missing(many, few.select("name", F.lit("v").alias("value")), "name", "value"),
    }[join]()
    execution = out._jdf.queryExecution()
    assert execution.toRdd().count() == (n if join != "info_of_listed" else n // 2 + 1_999)
    assert "skew=true" in execution.executedPlan().toString()
