"""Chart datasets, weekly series and tag history."""

from __future__ import annotations

from pyspark.sql import functions as F

from bandstand.checks import shapes
from bandstand.checks.registry import check
from bandstand.checks.shapes import CHECK_SETTINGS as S
from bandstand.checks.shapes import sql, table
from bandstand.operators import history, weekly
from bandstand.plans import charts, health
from bandstand.runtime import scratch_path
from bandstand.schemas import BRONZE, columns_of
from bandstand.sources import bronze, silver
from bandstand.streaming import incremental
from bandstand.checks.mart_checks import HEALTH_SQL


def every_artist(spark, d):
    return shapes.features(spark, d, labelled_only=False)


_TITLE = "upper(left(subgenre, 1)) || substr(subgenre, 2)"


@check("v1_golden_era_points", sql(f"""
 SELECT artist_name, subgenre, {_TITLE} AS trace, formed_year AS x, current_listeners AS y, least(greatest(coalesce(least(greatest(plays_per_listener, 0.0), 200.0), 20.0), 6.0), 28.0) AS size,
  '#888' AS color, plays_per_listener, total_albums FROM all_features WHERE formed_year IS NOT NULL AND current_listeners > 50000""", "all_features"))
def v1(spark, d):
    return charts.golden_era_points(every_artist(spark, d))


@check("v1_golden_era_axis", sql("""
 SELECT round(log10(50000), 9) AS y_low, round(log10(max(current_listeners) * 1.5), 9) AS y_high FROM all_features WHERE formed_year IS NOT NULL AND current_listeners > 50000""", "all_features"))
def v1_axis(spark, d):
    axis = charts.golden_era_axis(charts.golden_era_points(every_artist(spark, d)))
    return axis.select(F.round("y_low", 9).alias("y_low"), F.round("y_high", 9).alias("y_high"))


_KEPT = "SELECT * FROM all_features WHERE current_listeners > 50000 AND plays_per_listener > 0 AND plays_per_listener < 500"
_MEDIANS = "SELECT median(current_listeners) AS l, median(plays_per_listener) AS e FROM kept"


@check("v2_engagement_points", sql("""
 SELECT artist_name, subgenre, plays_per_listener AS x, current_listeners AS y, band_age_years, CASE WHEN plays_per_listener >= e THEN CASE WHEN current_listeners >= l THEN 'Giants' ELSE 'Cult Heroes' END
  ELSE CASE WHEN current_listeners >= l THEN 'Mainstream' ELSE 'Struggling' END END AS quadrant FROM kept, med""", "all_features", kept=_KEPT, med=_MEDIANS))
def v2(spark, d):
    return charts.engagement_points(every_artist(spark, d))


@check("a18_engagement_medians", sql("SELECT l AS med_listeners, e AS med_engagement FROM med", "all_features", kept=_KEPT, med=_MEDIANS))
def a18(spark, d):
    return charts.engagement_medians(charts.engagement_rows(every_artist(spark, d)))


@check("e_c4_engagement_quadrants", sql("""
 SELECT CASE WHEN plays_per_listener >= e THEN CASE WHEN current_listeners >= l THEN 'Giants' ELSE 'Cult Heroes' END
  ELSE CASE WHEN current_listeners >= l THEN 'Mainstream' ELSE 'Struggling' END END AS quadrant, count(*) AS artists FROM kept, med GROUP BY 1""", "all_features", kept=_KEPT, med=_MEDIANS))
def e_c4(spark, d):
    return charts.engagement_points(every_artist(spark, d)).groupBy("quadrant").agg(F.count("*").alias("artists"))


@check("v2_engagement_boxes", sql("""
 SELECT quadrant, round(x0, 6) AS x0, round(x1, 6) AS x1, round(y0, 6) AS y0, round(y1, 6) AS y1 FROM (
  SELECT l, e, max(current_listeners) * CAST(1.3 AS DOUBLE) AS ml, max(plays_per_listener) * CAST(1.1 AS DOUBLE) AS me FROM kept, med GROUP BY 1, 2) m,
  LATERAL (VALUES ('Giants', e, me, l, ml), ('Mainstream', CAST(0 AS DOUBLE), e, l, ml), ('Cult Heroes', e, me, CAST(50000 AS DOUBLE), l), ('Struggling', CAST(0 AS DOUBLE), e, CAST(50000 AS DOUBLE), l)) v(quadrant, x0, x1, y0, y1)""",
 "all_features", kept=_KEPT, med=_MEDIANS))
def v2_boxes(spark, d):
    boxes = charts.engagement_boxes(every_artist(spark, d))
    return boxes.select("quadrant", *[F.round(c, 6).alias(c) for c in ("x0", "x1", "y0", "y1")])


@check("v3_health_bars", f"""
 SELECT subgenre, {_TITLE} AS subgenre_label, '#888' AS color, total_listeners, printf('%.1fM', round_even(total_listeners / 1e6, 1)) AS bar_text, golden_era_decade AS bubble_x,
  breakout_pct AS bubble_y, least(greatest(CAST(total_artists AS DOUBLE), 5.0), 60.0) AS bubble_size FROM ({HEALTH_SQL})""")
def v3(spark, d):
    return charts.health_bars(health.subgenre_health(shapes.artists(spark, d), S))


@check("a22_axis_maxima", "SELECT event_type, max(value) * 1.25 AS axis_max FROM events GROUP BY 1 UNION ALL SELECT 'all', max(value) * 1.25 FROM events")
def a22(spark, d):
    rows = table(spark, d, "events")
    whole = charts.axis_max(rows, "value", 1.25).withColumn("event_type", F.lit("all"))
    per_type = rows.groupBy("event_type").agg((F.max("value") * 1.25).alias("axis_max"))
    return per_type.unionByName(whole)


_TOTALS = "SELECT artist_name, week_start, CAST(sum(listeners) AS BIGINT) AS listeners FROM weekly GROUP BY 1, 2"


@check("x3_listener_velocity", sql("""
 SELECT artist_name, week_start, listeners, lag(listeners) OVER w AS previous, listeners - lag(listeners) OVER w AS change FROM totals WINDOW w AS (PARTITION BY artist_name ORDER BY week_start)""", "weekly", totals=_TOTALS))
def x3(spark, d):
    return weekly.listener_velocity(weekly.flatten_weekly(shapes.raw_weekly(spark, d)))


@check("x5_change_around_releases", sql("""
 SELECT artist_name, release_week, releases,
  (SELECT CAST(sum(listeners) AS BIGINT) FROM totals t WHERE t.artist_name = r.artist_name AND CAST(t.week_start AS DATE) >= CAST(release_week AS DATE) - 14 AND CAST(t.week_start AS DATE) < CAST(release_week AS DATE)) AS listeners_before,
  (SELECT CAST(sum(listeners) AS BIGINT) FROM totals t WHERE t.artist_name = r.artist_name AND CAST(t.week_start AS DATE) >= CAST(release_week AS DATE) AND CAST(t.week_start AS DATE) < CAST(release_week AS DATE) + 14) AS listeners_after
 FROM (SELECT 'artist ' || user_id AS artist_name, strftime(date_trunc('week', ts), '%Y-%m-%d') AS release_week, count(*) AS releases FROM events GROUP BY 1, 2) r""", "weekly", totals=_TOTALS))
def x5(spark, d):
    released = table(spark, d, "events").selectExpr(
        "concat('artist ', cast(user_id as string)) as artist_name", "date_format(ts, 'yyyy-MM-dd') as first_release_date"
    )
    return weekly.change_around_releases(weekly.flatten_weekly(shapes.raw_weekly(spark, d)), released, weeks=2)


def tag_snapshots(spark, d):
    """Event types a user showed on a day, as the tags of a dated snapshot (one row per event)."""
    return table(spark, d, "events").select(
        F.concat(F.lit("artist "), F.col("user_id").cast("string")).alias("artist_name"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.array("event_type").alias("tags"),
    )


_INTERVALS = """
 WITH days AS (SELECT user_id, date, row_number() OVER w AS n, lead(date) OVER w AS next FROM (SELECT DISTINCT user_id, strftime(ts, '%Y-%m-%d') AS date FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY date)),
 seen AS (SELECT DISTINCT e.user_id, event_type AS tag, d.date, d.n, d.next FROM events e JOIN days d ON d.user_id = e.user_id AND d.date = strftime(ts, '%Y-%m-%d')),
 isl AS (SELECT *, n - row_number() OVER (PARTITION BY user_id, tag ORDER BY n) AS i FROM seen)
 SELECT 'artist ' || user_id AS artist_name, tag, min(date) AS valid_from, arg_max_null(next, n) AS valid_to FROM isl GROUP BY user_id, tag, i"""


@check("x1_tag_intervals", _INTERVALS)
def x1(spark, d):
    return history.tag_intervals(tag_snapshots(spark, d))


@check("x1_newest_day_merged", _INTERVALS)
def x1_day(spark, d):
    """The history of all days but the newest, stored, and the newest day merged into it."""
    snapshots, base = tag_snapshots(spark, d), scratch_path(spark, "tag-history")
    days = [r["date"] for r in snapshots.select("date").distinct().orderBy(F.desc("date")).limit(2).collect()]  # the newest two
    if len(days) < 2:
        return history.tag_intervals(snapshots)
    newest, last = days
    full = history.tag_intervals(snapshots.where(F.col("date") < newest))
    full.where(F.col("valid_to").isNotNull()).write.parquet(f"{base}/ended/date={last}")
    full.where(F.col("valid_to").isNull()).write.parquet(f"{base}/open/date={last}")
    day = snapshots.where(F.col("date") == newest)
    history.store_day(spark, base, day, newest)
    history.store_day(spark, base, day, newest)  # once more: changes nothing
    return history.stored_intervals(spark, base)


def similar_lists(spark, d):
    """Suppliers shipped on an order, as the similar artists of that order's customer."""
    orders = table(spark, d, "orders").selectExpr("o_orderkey", "concat('c', cast(o_custkey as string)) as name")
    lines = table(spark, d, "lineitem").selectExpr("l_orderkey", "concat('c', cast(l_suppkey as string)) as dst")
    return orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"]).select("name", F.array("dst").alias("similar"))


_EDGES = "SELECT DISTINCT 'c' || o_custkey AS src, 'c' || l_suppkey AS dst FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_custkey <> l_suppkey"


@check("x6_similar_edges", sql("SELECT src, dst FROM edges", edges=_EDGES))
def x6(spark, d):
    return history.similar_edges(similar_lists(spark, d))


@check("x6_edge_degrees", sql("""
 SELECT name, CAST(sum(o) AS BIGINT) AS out_degree, CAST(sum(i) AS BIGINT) AS in_degree FROM (SELECT src AS name, 1 AS o, 0 AS i FROM edges UNION ALL SELECT dst, 0, 1 FROM edges) GROUP BY 1""", edges=_EDGES))
def x6_degrees(spark, d):
    return history.edge_degrees(history.similar_edges(similar_lists(spark, d)))


_SCENES = "SELECT subgenre, count(DISTINCT name_key) AS artists, CAST(max(listeners) AS BIGINT) AS top FROM flat_artists WHERE listeners >= 50000 GROUP BY 1"


@check("x9_incremental_cleaning", sql(_SCENES, "flat_artists"))
def x9(spark, d):
    base, cleaned, state = (scratch_path(spark, n) for n in ("bronze", "cleaned", "stream"))
    raw = shapes.raw_artist_info(spark, d).select(*columns_of(BRONZE["artist_info"]), *bronze.PARTITIONS)
    bronze.write_bronze(raw, base, "artist_info")
    incremental.clean_new_files(spark, base, cleaned, state, S)
    incremental.clean_new_files(spark, base, cleaned, state, S)  # nothing new: adds nothing
    rows = incremental.publish(spark.read.parquet(cleaned).withColumn("date", F.col("date").cast("string")), shapes.raw_metadata(spark, d))
    return rows.groupBy("subgenre").agg(F.count("*").alias("artists"), F.max("listeners").alias("top"))


@check("x9_partitions_rebuilt", sql(_SCENES, "flat_artists"))
def x9_rebuilt(spark, d):
    """Records that land in two pieces, each followed by a run that rebuilds the partitions they touch."""
    base, cleaned, state = (scratch_path(spark, n) for n in ("bronze", "cleaned", "stream"))
    raw = shapes.raw_artist_info(spark, d).select(*columns_of(BRONZE["artist_info"]), *bronze.PARTITIONS)
    for piece in (0, 1):
        part = raw.where(F.pmod(F.xxhash64("name"), F.lit(2)) == piece)
        part.write.mode("append").partitionBy(*bronze.PARTITIONS).json(f"{base}/artist_info")
        incremental.rebuild_touched(spark, base, cleaned, state, S)
    return silver.read_silver(spark, cleaned, "artists").groupBy("subgenre").agg(F.count("*").alias("artists"), F.max("listeners").alias("top"))
