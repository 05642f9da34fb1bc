from pyspark.sql import functions as F

from bandstand.operators import cleaning, merge, quality, weekly
from bandstand.settings import Settings

TAGS = "ARRAY<STRUCT<tag: STRING, valid_from: STRING, valid_to: STRING>>"
CLEAN = f"lastfm_name STRING, listeners BIGINT, subgenre_tags {TAGS}, subgenre STRING, date STRING, _seq BIGINT"


def tag(name, day="d1"):
    return (name, day, None)


def cleaned(spark, *records):
    return spark.createDataFrame([(n, c, t, s, "d", i) for i, (n, c, t, s) in enumerate(records)], CLEAN)


def test_duplicates_keep_the_largest_row_and_all_tags(spark):
    df = cleaned(
        spark,
        ("In Flames", 100, [tag("melodeath", "d1"), tag("metal", "d1")], "a"),
        ("IN FLAMES", 300, [tag("gothenburg"), tag("metal", "d2")], "a"),
        (" in flames\t", 300, [tag("late")], "a"),
        ("In Flames", 50, [], "b"),
    )
    out = cleaning.deduplicate_artists(df, ["_seq"])
    got = {(r["subgenre"], r["lastfm_name"], r["listeners"]): [tuple(t) for t in r["subgenre_tags"]] for r in out.collect()}
    # Base: strictly larger wins, first of equals stays. Tags: first position, last value.
    assert got == {
        ("a", "IN FLAMES", 300): [tag("melodeath"), tag("metal", "d2"), tag("gothenburg"), tag("late")],
        ("b", "In Flames", 50): [],
    }


def test_dedupe_is_idempotent_and_can_cross_scenes(spark, rows):
    df = cleaned(spark, ("A", 1, [tag("x")], "a"), ("a", 2, [tag("y")], "b"), ("B", 1, [], "b"))
    once = cleaning.deduplicate_artists(df, ["_seq"])
    again = cleaning.deduplicate_artists(once.withColumn("_seq", F.lit(0)), ["_seq"])
    assert rows(once, "lastfm_name", "listeners", "subgenre") == rows(again, "lastfm_name", "listeners", "subgenre")
    everywhere = cleaning.deduplicate_artists(df, ["_seq"], within=())
    assert rows(everywhere, "lastfm_name", "listeners") == [("B", 1), ("a", 2)]


def test_floor(spark):
    df = spark.createDataFrame([(49_999,), (50_000,), (None,)], "listeners BIGINT")
    assert [r[0] for r in cleaning.above_floor(df, Settings()).collect()] == [50_000]


def test_distinct_last(spark):
    df = spark.createDataFrame([([("a", 1), ("b", 2), ("a", 3)],)], "v ARRAY<STRUCT<k: STRING, n: INT>>")
    (got,) = df.select(cleaning.distinct_last(F.col("v"), "k")).first()
    assert [tuple(x) for x in got] == [("a", 3), ("b", 2)]


META = "lastfm_name STRING, mbid STRING, mb_name STRING, country STRING, formed_year INT, similarity_score DOUBLE, resolution_status STRING, subgenre STRING, date STRING, _seq BIGINT"


def test_merge_only_accepts_exact_accepted_names(spark):
    artists = spark.createDataFrame(
        [(n, 2000, "a", "d") for n in ("acc", "accnull", "review", "rejected", "none", "twice", "Case")],
        "lastfm_name STRING, formed_year INT, subgenre STRING, date STRING",
    )
    meta = spark.createDataFrame(
        [
            ("acc", "m1", "ACC", "SE", 1990, 99.0, "auto_accepted", "a", "d", 0),
            ("accnull", "m2", "X", None, None, 95.0, "auto_accepted", "a", "d", 1),
            ("review", "m3", "X", "US", 1991, 80.0, "review_required", "a", "d", 2),
            ("rejected", "m4", "X", "US", 1992, 10.0, "rejected", "a", "d", 3),
            ("twice", "m5", "X", "US", 1993, 99.0, "auto_accepted", "a", "d", 4),
            ("twice", "m6", "X", "US", 1994, 60.0, "rejected", "a", "d", 5),
            ("case", "m7", "X", "US", 1995, 99.0, "auto_accepted", "a", "d", 6),
            ("none", "m8", "X", "US", 1996, 99.0, "auto_accepted", "b", "d", 7),
            ("", "m9", "X", "US", 1996, 99.0, "auto_accepted", "a", "d", 8),
        ],
        META,
    )
    got = {r["lastfm_name"]: (r["mbid"], r["formed_year"]) for r in merge.merge_metadata(artists, meta, ["_seq"]).collect()}
    assert got == {
        "acc": ("m1", 1990.0), "accnull": ("m2", None), "review": (None, 2000.0), "rejected": (None, 2000.0),
        "none": (None, 2000.0), "twice": (None, 2000.0), "Case": (None, 2000.0),
    }


def test_weekly_shapes(spark, rows):
    raw = spark.createDataFrame(
        [
            ("w1", '{"artist":[{"name":"a","listeners":"5"},7,{"name":"","listeners":"5"}]}'),
            ("w1", '[{"name":"b","listeners":"","playcount":"9"},{"name":"c","listeners":"many"}]'),
            ("w1", '[{"name":"d"}]'),
            ("w1", None),
            ("w1", '{"other":1}'),
            (None, '[{"name":"e","listeners":"5"}]'),
            ("", '[{"name":"f","listeners":"5"}]'),
        ],
        "_week_start STRING, topartists STRING",
    ).withColumns({"subgenre": F.lit("s"), "date": F.lit("d")})
    assert rows(weekly.flatten_weekly(raw), "artist_name", "week_start", "listeners") == [("a", "w1", 5), ("b", "w1", 9)]


def test_deny_list_keeps_missing_names(spark):
    df = spark.createDataFrame([("DRAKE",), (None,), ("Gojira",)], "n STRING")
    assert [r[0] for r in merge.denied_out(df, "n", ("drake",)).collect()] == [None, "Gojira"]


def test_fill_missing_touches_only_null_values_with_a_known_id(spark, rows):
    records = spark.createDataFrame([("1", None), ("2", 5), (None, None), ("9", None)], "id STRING, popularity BIGINT")
    full = spark.createDataFrame([("1", 50), ("2", 60)], "id STRING, popularity BIGINT")
    assert rows(merge.fill_missing(records, full, "id", "popularity"), "id", "popularity") == [
        ("1", 50), ("2", 5), ("9", None), (None, None),
    ]


def test_quality_results(spark, rows):
    df = spark.createDataFrame([("a", 1), (None, 2)], "lastfm_name STRING, listeners BIGINT")
    got = rows(quality.not_null_check(df, "artists", ["lastfm_name", "listeners"]), "column_name", "failures", "status")
    assert got == [("lastfm_name", 1, "fail"), ("listeners", 0, "pass")]
    days = spark.createDataFrame([("2024-01-01",), ("2023-12-01",)], "date STRING")
    ages = {}
    for day in ("2024-01-09", "2024-01-10", "2024-01-16", "2024-01-17"):
        ages[day] = quality.freshness(days, F.lit(day).cast("date")).first()["status"]
    assert list(ages.values()) == ["pass", "warn", "warn", "error"]
    assert rows(quality.duplicate_keys(df.union(df), ["lastfm_name"])) == [("a", 2), (None, 2)]


def test_tally_counts_missing_as_rejected(spark, rows):
    df = spark.createDataFrame([("auto_accepted",), (None,), ("rejected",)], "resolution_status STRING")
    assert rows(quality.status_tally(df)) == [("auto_accepted", 1), ("rejected", 2)]
