import gzip
import json

import pytest
from pyspark.sql import functions as F

from bandstand.operators.cleaning import clean_artists
from bandstand.schemas import BRONZE, MARTS, SILVER, columns_of
from bandstand.settings import Settings
from bandstand.sources import bronze, marts, silver
from bandstand.streaming import incremental

INFO = (
    "name STRING, mbid STRING, stats STRUCT<listeners: STRING, playcount: STRING>, tags STRING, "
    "bio STRUCT<summary: STRING, content: STRING>, _source_tag STRING, _seq BIGINT, source STRING, subgenre STRING, date STRING"
)


def info(spark, *rows):
    return spark.createDataFrame(
        [(n, None, (str(c), "1"), None, ("s", "formed in 1999"), "t", i, "charts", s, d) for i, (n, c, s, d) in enumerate(rows)], INFO
    )


def test_columns_of_declared_schemas():
    assert columns_of("a INT, b STRUCT<c: INT, d: ARRAY<STRING>>, e STRING") == ["a", "b", "e"]
    assert columns_of(SILVER["albums"])[-1] == "release_year" and len(columns_of(MARTS["mart_subgenre_health"])) == 22


def test_raw_round_trip_and_pruning(spark, tmp_path):
    base = str(tmp_path)
    bronze.write_bronze(info(spark, ("Ünø", 5, "black metal", "2024-01-01"), ("B", 6, "djent", "2024-01-01")), base, "artist_info")
    back = bronze.read_artist_info(spark, base, subgenre="black metal")
    assert [(r["name"], r["stats"]["listeners"], r["date"]) for r in back.collect()] == [("Ünø", "5", "2024-01-01")]
    assert "PartitionFilters: [isnotnull(subgenre" in back._jdf.queryExecution().toString()
    assert bronze.read_artist_info(spark, base, date="1999-01-01").count() == 0
    assert bronze.read_tag_artists(spark, base).count() == 0
    with pytest.raises(bronze.MissingUpstream):
        bronze.require(bronze.read_tag_artists(spark, base), "tag_artists")
    assert bronze.list_objects(spark, f"{base}/artist_info").where("bytes > 0").count() == 2


def test_one_array_per_file(spark, tmp_path):
    folder = tmp_path / "artist_info" / "source=charts" / "subgenre=djent" / "date=2024-01-01"
    folder.mkdir(parents=True)
    records = [{"name": f"n{i}", "stats": {"listeners": "60000"}, "tags": {"tag": {"name": "x"}}, "extra": 1} for i in range(5)]
    (folder / "artist_info.json.gz").write_bytes(gzip.compress(json.dumps(records).encode()))
    df = bronze.with_record_order(bronze.read_bronze(spark, str(tmp_path), "artist_info", json_arrays=True))
    rows = df.orderBy("_file", "_block", "_row").collect()
    assert [r["name"] for r in rows] == [f"n{i}" for i in range(5)]
    assert rows[0]["tags"] == '{"tag":{"name":"x"}}' and rows[0]["subgenre"] == "djent"


def test_writing_one_day_leaves_the_others(spark, tmp_path):
    base, s = str(tmp_path), Settings()
    extra = {c: F.lit(None).cast("string") for c in ("mbid", "mb_name", "country")} | {"mb_resolution_score": F.lit(1.0)}

    def day(*rows):
        return clean_artists(info(spark, *rows), s).withColumns(extra)

    silver.write_silver(day(("A", 60_000, "a", "2024-01-01"), ("B", 60_000, "b", "2024-01-01")), base, "artists")
    silver.write_silver(day(("C", 60_000, "a", "2024-01-02")), base, "artists")
    silver.write_silver(day(("A2", 70_000, "a", "2024-01-01")), base, "artists")
    silver.write_silver(day(("low", 1, "b", "2024-01-01")), base, "artists")  # no rows left: nothing is written
    stored = silver.read_silver(spark, base, "artists")
    got = sorted((r["subgenre"], r["date"], r["lastfm_name"]) for r in stored.collect())
    assert got == [("a", "2024-01-01", "A2"), ("a", "2024-01-02", "C"), ("b", "2024-01-01", "B")]
    latest = silver.latest_snapshot(stored)
    assert sorted(r["lastfm_name"] for r in latest.collect()) == ["B", "C"]
    silver.register(spark, base, ("artists",))
    assert spark.sql("SELECT count(*) FROM artists WHERE formed_year = 1999").first()[0] == 3
    spark.catalog.dropTempView("artists")


def test_external_table_discovers_partitions(spark, tmp_path):
    base = str(tmp_path)
    albums = spark.createDataFrame(
        [("a", "m", "x", "t", "Album", "2010", 2010, "focus", "2024-01-01")], f"{SILVER['albums']}, subgenre STRING, date STRING"
    )
    silver.write_silver(albums, base, "albums")
    for _ in range(2):  # safe to repeat
        silver.create_external_table(spark, base, "albums")
    assert spark.sql("SELECT date, release_year FROM albums").collect() == [("2024-01-01", 2010)]
    spark.sql("DROP TABLE albums")


def test_rewrite_of_the_partitions_it_reads(spark, tmp_path):
    base = str(tmp_path)
    bronze.write_bronze(info(spark, ("a", 1, "x", "d"), ("b", 2, "y", "d")), base, "artist_info")
    bronze.rewrite_partitions(spark, base, "artist_info", lambda df: df.withColumn("name", F.upper("name")))
    assert sorted(r["name"] for r in bronze.read_artist_info(spark, base).collect()) == ["A", "B"]


def test_rewrite_replaces_named_partitions_only_and_drops_emptied_ones(spark, tmp_path):
    base = str(tmp_path)
    bronze.write_bronze(info(spark, ("a", 1, "x y", "d"), ("b", 2, "y", "d"), ("c", 3, "y", "e")), base, "artist_info")
    bronze.rewrite_partitions(spark, base, "artist_info", lambda df: df.where("name <> 'a'"), subgenre="x y")
    assert sorted(r["name"] for r in bronze.read_artist_info(spark, base).collect()) == ["b", "c"]
    bronze.rewrite_partitions(spark, base, "artist_info", lambda df: df.withColumn("name", F.upper("name")), subgenre="y", date="d")
    assert sorted(r["name"] for r in bronze.read_artist_info(spark, base).collect()) == ["B", "c"]


def test_latest_snapshot_reads_no_older_folder(spark, tmp_path):
    base = str(tmp_path)
    for date in ("2024-01-01", "2024-01-02", "2024-01-03"):
        rows = spark.range(3).selectExpr("concat('n', id) AS lastfm_name", "id + 60000 AS listeners", "'a' AS subgenre", f"'{date}' AS date")
        from bandstand.schemas import SILVER, columns_of

        have = set(rows.columns)
        typed = spark.createDataFrame([], SILVER["artists"]).schema
        full = rows.select(*[F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in typed if f.name in columns_of(SILVER["artists"])], "subgenre", "date")
        silver.write_silver(full, base, "artists")
    latest = silver.latest_snapshot(silver.read_silver(spark, base, "artists"))
    files = latest.select("_metadata.file_path").distinct().collect()
    assert files and all("date=2024-01-03" in r["file_path"] for r in files)
    assert "date=2024-01-01" not in str(latest.inputFiles()) or "PartitionFilters: [" in latest._jdf.queryExecution().toString()


def test_newest_dates_come_from_folder_names_alone(spark, tmp_path):
    base = str(tmp_path)
    columns = "artist_name string, subgenre string, date string, week_start string, listeners long"
    rows = [("n", scene, date, "w", 1) for scene, date in [("a/b c", "2024-01-01"), ("a/b c", "2024-02-01"), ("x", "2024-01-03"), (None, "2024-09-09"), ("y", None)]]
    silver.write_silver(spark.createDataFrame(rows, columns), base, "weekly_charts")
    (tmp_path / "weekly_charts" / "subgenre=x" / "date=2025-01-01").mkdir()
    (tmp_path / "weekly_charts" / "subgenre=x" / "date=2025-01-01" / "_SUCCESS").touch()
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("newest", "listing")
    assert sorted(silver.newest_dates(spark, base, "weekly_charts")) == [("a/b c", "2024-02-01"), ("x", "2024-01-03")]
    assert list(tracker.getJobIdsForGroup("newest")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    latest = silver.read_latest(spark, base, "weekly_charts")
    assert sorted((r["subgenre"], r["date"]) for r in latest.collect()) == [("a/b c", "2024-02-01"), ("x", "2024-01-03")]
    assert silver.newest_dates(spark, base, "albums") == []


def test_csv_keeps_text_as_it_is(spark, tmp_path):
    names = [' outer ', 'quote " and, comma', "Motörhead"]
    df = spark.createDataFrame([(n, 0.5) for n in names], "feature STRING, mean_abs_shap DOUBLE")
    path = marts.export_csv(df, str(tmp_path / "csv"))
    assert sorted(r["feature"] for r in marts.read_csv(spark, path, "shap_importance").collect()) == sorted(names)


def test_run_metrics_are_appended(spark, tmp_path):
    path = str(tmp_path / "runs")
    one = spark.createDataFrame([(0.9,)], "roc_auc DOUBLE")
    marts.append_run_metrics(spark, path, "first", {"rounds": 3}, one)
    log = marts.append_run_metrics(spark, path, "second", {"rounds": 5}, one)
    assert sorted((r["run_name"], r["params"]["rounds"]) for r in log.collect()) == [("first", "3"), ("second", "5")]


def test_stream_picks_up_each_file_once(spark, tmp_path):
    base, cleaned, state = str(tmp_path / "b"), str(tmp_path / "c"), str(tmp_path / "s")
    bronze.write_bronze(info(spark, ("A", 60_000, "x", "2024-01-01"), ("low", 5, "x", "2024-01-01")), base, "artist_info")
    incremental.clean_new_files(spark, base, cleaned, state)
    incremental.clean_new_files(spark, base, cleaned, state)
    bronze.write_bronze(info(spark, ("B", 70_000, "x", "2024-01-02")), base, "artist_info")
    incremental.clean_new_files(spark, base, cleaned, state)
    rows = spark.read.parquet(cleaned)
    assert sorted(r["lastfm_name"] for r in rows.collect()) == ["A", "B"]


def test_declared_raw_schemas_have_an_order_column():
    assert all("_seq" in columns_of(ddl) for name, ddl in BRONZE.items() if name not in ("match_candidates", "profiles"))
