"""Tag history merged day by day, and cleaned partitions kept up by the stream."""

import random

import pytest
from pyspark.sql import functions as F

from bandstand.operators import history
from bandstand.plans import silver_build
from bandstand.schemas import BRONZE, columns_of
from bandstand.sources import bronze, silver
from bandstand.streaming import incremental

SNAPSHOT = "artist_name STRING, date STRING, tags ARRAY<STRING>"


def days_of(rng, n):
    names = ["a", "b", "c", "d", None]
    rows = []
    for k in range(n):
        for name in names:
            for _ in range(rng.choice([0, 1, 1, 2])):  # absent, or one or more rows
                rows.append((name, f"2024-01-{k + 1:02d}", rng.choice([[], ["x"], ["x", "y"], ["y", None], ["z", "z"]])))
    return rows


def test_daily_merges_equal_the_full_run(spark, tmp_path, rows):
    data = spark.createDataFrame(days_of(random.Random(3), 6), SNAPSHOT)
    base = str(tmp_path / "history")
    assert history.stored_intervals(spark, base).count() == 0
    for day in sorted(r.date for r in data.select("date").distinct().collect()):
        history.store_day(spark, base, data.where(F.col("date") == day), day)
        so_far = data.where(F.col("date") <= day)
        columns = ["artist_name", "tag", "valid_from", "valid_to"]
        assert rows(history.stored_intervals(spark, base), *columns) == rows(history.tag_intervals(so_far), *columns)
    history.store_day(spark, base, data.where(F.col("date") == day), day)
    assert rows(history.stored_intervals(spark, base), *columns) == rows(history.tag_intervals(data), *columns)
    with pytest.raises(ValueError):
        history.store_day(spark, base, data, "2024-01-01")


def test_two_batches_equal_one_full_build(spark, tmp_path, rows):
    base, cleaned, state = (str(tmp_path / n) for n in ("bronze", "cleaned", "state"))
    given = {"mbid": "''", "stats": "named_struct('listeners', cast(60000 + id % 7 * 1000 as string), 'playcount', '9')", "name": "concat('Band ', id % 40)"}
    given |= {"tags": "concat('{\"tag\":[{\"name\":\"t', id % 5, '\"}]}')", "bio": "named_struct('summary', 'x', 'content', 'formed in 1980')"}
    given |= {"_source_tag": "'t'", "source": "'charts'", "subgenre": "concat('s', id % 3)", "date": "concat('2024-01-0', 1 + id % 2)"}
    made = spark.range(300).selectExpr("id", *[f"{e} as {n}" for n, e in given.items()])
    columns = [c for c in columns_of(BRONZE["artist_info"]) if c in made.columns]

    def metadata():
        found = bronze.read_artist_metadata(spark, base)
        return bronze.with_record_order(found) if (tmp_path / "bronze" / "artist_metadata").exists() else found.selectExpr("*", "'' as _file", "0L as _block", "0L as _row")

    def land(df):
        df.select(*columns, *bronze.PARTITIONS).write.mode("append").partitionBy(*bronze.PARTITIONS).json(f"{base}/artist_info")
        incremental.rebuild_touched(spark, base, cleaned, state)

    land(made.where("id < 200"))
    untouched = set((tmp_path / "cleaned" / "artists" / "subgenre=s0").rglob("*.parquet"))
    matched = spark.range(40).selectExpr("id", "concat('Band ', id) as lastfm_name", "'m' as mbid", "'auto_accepted' as resolution_status", "1980 as formed_year")
    matched = matched.selectExpr("*", "'match' as source", "concat('s', id % 3) as subgenre", "'2024-01-02' as date")
    matched.drop("id").write.mode("append").partitionBy(*bronze.PARTITIONS).json(f"{base}/artist_metadata")
    land(made.where("id >= 200 and id % 3 <> 0"))
    assert untouched and untouched == set((tmp_path / "cleaned" / "artists" / "subgenre=s0").rglob("*.parquet"))
    info = bronze.with_record_order(bronze.read_artist_info(spark, base)).where("subgenre <> 's0'")
    full = silver_build.build_artists(info, metadata(), incremental.FILE_ORDER)
    kept = silver.read_silver(spark, cleaned, "artists").where("subgenre <> 's0'")
    assert rows(kept) == rows(full.select(*kept.columns)) and kept.count() > 0
