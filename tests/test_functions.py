from pyspark.sql import functions as F

from bandstand.functions import dates, numbers, tags, text, tiers
from bandstand.settings import Settings


def one(spark, expr, schema, values):
    """``expr`` over single-column values, in input order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {schema}")
    return [r["out"] for r in df.select("i", expr(F.col("v")).alias("out")).orderBy("i").collect()]


def test_count_text(spark):
    values = ["1,234", " 60000 ", "", None, "abc", "49999", "12.5", "\t7\n", "1,000,000"]
    assert one(spark, text.parse_count, "STRING", values) == [1234, 60000, None, None, None, 49999, None, 7, 1000000]


def test_founding_year_takes_the_first_phrase_within_bounds(spark):
    values = [
        "Formed in 1999", "founded\n in 1987", "began 1959", "started in 9999", "no year", None,
        "formed 2001, founded 1990", "FORMED: 1975.", "formed a very long time ago in 1999", "started in 20015",
    ]
    got = one(spark, lambda c: text.founding_year(c, 1960, F.lit(2026)), "STRING", values)
    assert got == [1999, 1987, None, None, None, None, 2001, 1975, None, 2001]


def test_text_falls_back_when_empty(spark):
    df = spark.createDataFrame([("a", "b"), ("", "b"), (None, "b"), (None, None), ("", "")], "c STRING, s STRING")
    assert [r[0] for r in df.select(text.first_text(F.col("c"), F.col("s"))).collect()] == ["a", "b", "b", "", ""]


def test_title_case_restarts_after_any_non_letter(spark):
    values = ["nu-metal", "melodic death metal", "DJENT", "don't", "", None, "2nd wave"]
    assert one(spark, text.title_case, "STRING", values) == [
        "Nu-Metal", "Melodic Death Metal", "Djent", "Don'T", "", None, "2Nd Wave",
    ]


def test_keys_strip_different_blanks(spark):
    assert one(spark, text.name_key, "STRING", ["  In Flames ", "\tIn Flames"]) == ["in flames", "\tin flames"]
    assert one(spark, text.dedupe_key, "STRING", ["  In Flames ", "\tIn Flames\n"]) == ["in flames", "in flames"]


def test_labels(spark):
    assert one(spark, text.millions_label, "BIGINT", [12_345_678, 1_250_000, 49_999]) == ["12.3M", "1.2M", "0.0M"]
    assert one(spark, text.percent_label, "DOUBLE", [66.3, 5.0]) == ["66.3%", "5.0%"]


def test_life_span_year(spark):
    values = ["2010-05-11", "2010-05", "2010", "", None, "20", "abcd", "1959", "2025", "2026"]
    got = one(spark, lambda c: dates.life_span_year(c, 1960, 2025), "STRING", values)
    assert got == [2010, 2010, 2010, None, None, None, None, None, 2025, None]


def test_release_year_reads_partial_dates(spark):
    values = ["2010-05-11", "2010-05", "2010", "", None, "abcd", "2010-13-01"]
    assert one(spark, dates.release_year, "STRING", values) == [2010, 2010, 2010, None, None, None, None]


def test_periods_walk_back_without_gaps(spark):
    got = dates.week_calendar(spark, "2024-03-01", 3).orderBy("period").collect()
    assert [(r["_week_start"], r["_week_end"]) for r in got] == [
        ("2024-02-23", "2024-03-01"), ("2024-02-16", "2024-02-23"), ("2024-02-09", "2024-02-16"),
    ]


def test_clip_keeps_null_until_filled(spark):
    assert one(spark, lambda c: numbers.clip(c, 0.0, 200.0), "DOUBLE", [-1.0, None, 7.0, 300.0]) == [0.0, None, 7.0, 200.0]
    assert one(spark, lambda c: numbers.clip_or(c, 0.0, 200.0, 20.0), "DOUBLE", [None, 300.0]) == [20.0, 200.0]


def test_half_even(spark):
    assert one(spark, lambda c: numbers.round_even(c, 3), "DOUBLE", [0.0625, 0.1875]) == [0.062, 0.188]


def test_every_listener_count_has_one_tier(spark):
    values = [0, 199_999, 200_000, 499_999, 500_000, 999_999, 1_000_000]
    assert one(spark, tiers.listener_tier, "BIGINT", values) == [
        "underground", "underground", "rising", "rising", "rising", "rising", "breakout",
    ]
    assert one(spark, tiers.breakout_label, "BIGINT", values) == [0, 0, None, None, None, None, 1]
    assert one(spark, tiers.prediction_tier, "BIGINT", [*values, 1_000_001, None]) == [
        None, "Underground", "Underground", "Rising", "Rising", "Rising", "Rising", "Breakout", None,
    ]


def test_legacy_quadrants(spark):
    s = Settings()
    df = spark.createDataFrame(
        [(3, 500_000), (4, 500_000), (3, 499_999), (4, 499_999), (None, 900_000)], "y INT, n BIGINT"
    )
    got = [r[0] for r in df.select(tiers.legacy_quadrant(F.col("y"), F.col("n"), s)).collect()]
    assert got == ["Active Giants", "Legends", "Hustling", "Fading", None]


def test_match_status_uses_the_unrounded_score(spark):
    got = one(spark, tiers.match_status, "DOUBLE", [100.0, 90.0, 89.999, 70.0, 69.999, None])
    assert got == ["auto_accepted", "auto_accepted", "review_required", "review_required", "rejected", "rejected"]


def test_tags_of_every_raw_shape(spark):
    values = [
        '{"tag":[{"name":" Death Metal "},{"name":""},{"name":null},{"url":"x"}]}',
        '{"tag":{"name":"Djent"}}', '""', None, '{"tag":[]}', "{}",
    ]
    got = one(spark, lambda c: tags.tag_structs(tags.raw_tags(c), F.lit("2024-01-01")), "STRING", values)
    plain = [[tuple(t) for t in x] for x in got]
    assert plain == [[("death metal", "2024-01-01", None)], [("djent", "2024-01-01", None)], [], [], [], []]


def test_bad_numbers_become_null(spark):
    df = spark.createDataFrame([("1.5", "x"), ("", "2")], "a STRING, b STRING")
    assert [tuple(r) for r in numbers.cast_numeric(df, ["a", "b", "absent"]).collect()] == [(1.5, None), (None, 2.0)]
