"""Projections, filters, scalars and the cleaning steps over raw records."""

from __future__ import annotations

from pyspark.sql import functions as F

from bandstand.checks import shapes
from bandstand.checks.registry import check
from bandstand.checks.shapes import CHECK_SETTINGS as S
from bandstand.checks.shapes import sql, table
from bandstand.functions import dates, numbers, tags, text
from bandstand.functions.ranking import arg_max_abs
from bandstand.operators import cleaning, merge, quality, weekly
from bandstand.plans.silver_build import build_artists
from bandstand.settings import SUBGENRES


def flat(spark, d):
    return cleaning.flatten_artists(shapes.raw_artist_info(spark, d), S, keep=("_seq",))


def joined_tags(column="subgenre_tags"):
    return F.concat_ws("|", F.transform(column, lambda t: t["tag"]))


@check("p1_flatten_artists", sql("""
 SELECT _seq, subgenre, source_tag, lastfm_name, lastfm_mbid, listeners, play_count, array_to_string(tags, '|') AS tags, formed_year, bio_summary FROM flat_artists""", "flat_artists"))
def p1(spark, d):
    return flat(spark, d).withColumn("tags", joined_tags()).drop("subgenre_tags", "date")


@check("f1_listener_floor", sql("SELECT _seq, listeners FROM flat_artists WHERE listeners >= 50000", "flat_artists"))
def f1(spark, d):
    return cleaning.above_floor(flat(spark, d), S).select("_seq", "listeners")


@check("e_str1_name_keys", sql("SELECT _seq, name_key FROM flat_artists", "flat_artists"))
def e_str1(spark, d):
    raw = shapes.raw_artist_info(spark, d)
    return raw.select("_seq", text.dedupe_key(F.col("name")).alias("name_key"))


@check("e_str2_parse_count", sql("SELECT _seq, listeners, play_count FROM flat_artists", "flat_artists"))
def e_str2(spark, d):
    raw = shapes.raw_artist_info(spark, d)
    return raw.select(
        "_seq",
        text.parse_count(F.col("stats.listeners")).alias("listeners"),
        text.parse_count(F.col("stats.playcount")).alias("play_count"),
    )


@check("e_str3_founding_year", sql("SELECT _seq, formed_year FROM flat_artists", "flat_artists"))
def e_str3(spark, d):
    raw = shapes.raw_artist_info(spark, d)
    body = text.first_text(F.col("bio.content"), F.col("bio.summary"))
    return raw.select("_seq", text.founding_year(body, S.first_year, F.lit(S.last_text_year)).alias("formed_year"))


@check("e_str3_year_in_documents", r"""
 SELECT doc_id, CASE WHEN y BETWEEN 1960 AND 2026 THEN y END AS formed_year FROM (
  SELECT doc_id, TRY_CAST(nullif(regexp_extract('Formed in ' || (1900 + doc_id % 150) || '. ' || text, '(?:formed|founded|started|began)[^\d]{0,10}(\d{4})', 1, 'i'), '') AS INTEGER) AS y FROM documents)""")
def e_str3_documents(spark, d):
    docs = table(spark, d, "documents").select(
        "doc_id", F.concat(F.lit("Formed in "), (1900 + F.col("doc_id") % 150).cast("string"), F.lit(". "), "text").alias("text")
    )
    return docs.select("doc_id", text.founding_year(F.col("text"), S.first_year, F.lit(S.last_text_year)).alias("formed_year"))


@check("e_str4_text_fallback", """
 SELECT conv_id, turn, CASE WHEN turn % 3 = 0 AND text <> '' THEN text WHEN turn % 2 = 0 THEN role ELSE '' END AS body FROM conversations""")
def e_str4(spark, d):
    t = table(spark, d, "conversations")
    content = F.when(F.col("turn") % 3 == 0, F.col("text")).when(F.col("turn") % 3 == 1, F.lit(""))
    summary = F.when(F.col("turn") % 2 == 0, F.col("role"))
    return t.select("conv_id", "turn", text.first_text(content, summary).alias("body"))


@check("e_str5_title_case", r"""
 SELECT doc_id, array_to_string(list_transform(regexp_extract_all(replace(lang || '-' || source, '_', ' '), '(\p{L}+|\P{L}+)'), lambda x: upper(x[1]) || lower(x[2:])), '') AS label FROM documents""")
def e_str5(spark, d):
    raw = F.replace(F.concat("lang", F.lit("-"), "source"), F.lit("_"), F.lit(" "))
    return table(spark, d, "documents").select("doc_id", text.title_case(raw).alias("label"))


@check("e_str6_artist_label", """
 SELECT p_partkey, p_name || ' (' || upper(p_type[1]) || lower(p_type[2:]) || ')' AS label FROM part""")
def e_str6(spark, d):
    return table(spark, d, "part").select("p_partkey", text.artist_label(F.col("p_name"), F.lower("p_type")).alias("label"))


@check("e_str7_number_labels", """
 SELECT o_orderkey, printf('%.1fM', round_even(CAST(round(o_totalprice) AS BIGINT) / 1e6, 1)) AS millions,
  printf('%.1f%%', round_even((o_orderkey % 1000) / 10.0, 1)) AS percent FROM orders""")
def e_str7(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey",
        text.millions_label(F.round("o_totalprice").cast("bigint")).alias("millions"),
        text.percent_label((F.col("o_orderkey") % 1000) / F.lit(10.0)).alias("percent"),
    )


@check("p9_truncate_text", "SELECT doc_id, md5(left(text, 500)) AS summary_md5, CAST(length(left(text, 500)) AS INTEGER) AS chars FROM documents")
def p9(spark, d):
    cut = table(spark, d, "documents").select("doc_id", text.truncate(F.col("text"), S.bio_chars).alias("s"))
    return cut.select("doc_id", F.md5("s").alias("summary_md5"), F.length("s").alias("chars"))


@check("e_a1_tag_structs", sql("SELECT _seq, unnest(tags) AS tag, '1999-06-17' AS valid_from, true AS still_valid FROM flat_artists", "flat_artists"))
def e_a1(spark, d):
    built = tags.tag_structs(tags.raw_tags(F.col("tags")), F.col("date"))
    return (
        shapes.raw_artist_info(spark, d)
        .select("_seq", F.explode(built).alias("t"))
        .select("_seq", "t.tag", "t.valid_from", F.col("t.valid_to").isNull().alias("still_valid"))
    )


@check("e_a2_one_or_many", "SELECT p_partkey AS _seq, CAST(CASE p_partkey % 4 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 0 END AS INTEGER) AS raw_tags FROM part")
def e_a2(spark, d):
    parsed = F.coalesce(F.size(tags.raw_tags(F.col("tags"))), F.lit(0))
    return shapes.raw_artist_info(spark, d).select("_seq", parsed.alias("raw_tags"))


_TAG_ROWS = """SELECT subgenre, name_key, tag, min((_seq, place)) AS first_at FROM
 (SELECT subgenre, name_key, _seq, unnest(tags) AS tag, generate_subscripts(tags, 1) AS place FROM flat_artists WHERE listeners >= 50000) GROUP BY 1, 2, 3"""
_BASE = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY subgenre, name_key ORDER BY listeners DESC, _seq) AS rn FROM flat_artists WHERE listeners >= 50000) WHERE rn = 1"""
_TAG_LISTS = "SELECT subgenre, name_key, string_agg(tag, '|' ORDER BY first_at) AS tags FROM tag_rows GROUP BY 1, 2"


@check("a9_dedupe_artists", sql("""
 SELECT b.subgenre, lastfm_name, listeners, play_count, source_tag, formed_year, coalesce(t.tags, '') AS tags FROM base b LEFT JOIN tag_lists t ON t.subgenre = b.subgenre AND t.name_key = b.name_key""",
 "flat_artists", base=_BASE, tag_rows=_TAG_ROWS, tag_lists=_TAG_LISTS))
def a9(spark, d):
    rows = cleaning.deduplicate_artists(cleaning.above_floor(flat(spark, d), S), ["_seq"])
    return rows.select("subgenre", "lastfm_name", "listeners", "play_count", "source_tag", "formed_year", joined_tags().alias("tags"))


@check("e_a3_merged_tag_arrays", sql("SELECT b.subgenre, b.name_key, coalesce(t.tags, '') AS tags FROM base b LEFT JOIN tag_lists t ON t.subgenre = b.subgenre AND t.name_key = b.name_key", "flat_artists", base=_BASE, tag_rows=_TAG_ROWS, tag_lists=_TAG_LISTS))
def e_a3(spark, d):
    merged = cleaning.deduplicate_artists(cleaning.above_floor(flat(spark, d), S), ["_seq"])
    return merged.select("subgenre", text.dedupe_key(F.col("lastfm_name")).alias("name_key"), joined_tags().alias("tags"))


@check("a10_distinct_by_key", """
 SELECT doc_id, string_agg(word || ':' || last_at, '|' ORDER BY first_at) AS kept FROM (
  SELECT doc_id, word, min(place) AS first_at, max(place) AS last_at FROM (
   SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM (SELECT doc_id, string_split(lower(source || ' ' || lang || ' ' || source), ' ') AS w FROM documents)) GROUP BY 1, 2) GROUP BY 1""")
def a10(spark, d):
    words = F.split(F.lower(F.concat_ws(" ", "source", "lang", "source")), " ")
    pairs = F.transform(words, lambda w, i: F.struct(w.alias("word"), (i + 1).alias("at")))
    kept = cleaning.distinct_last(pairs, "word")
    return table(spark, d, "documents").select(
        "doc_id", F.concat_ws("|", F.transform(kept, lambda x: F.concat(x["word"], F.lit(":"), x["at"].cast("string")))).alias("kept")
    )


@check("x7_dedupe_across_scenes", sql("""
 SELECT lastfm_name, subgenre, listeners FROM (SELECT *, row_number() OVER (PARTITION BY name_key ORDER BY listeners DESC, _seq) AS rn FROM flat_artists WHERE listeners >= 50000) WHERE rn = 1""", "flat_artists"))
def x7(spark, d):
    rows = cleaning.deduplicate_artists(cleaning.above_floor(flat(spark, d), S), ["_seq"], within=())
    return rows.select("lastfm_name", "subgenre", "listeners")


_LOOKUP = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY subgenre, lastfm_name ORDER BY _seq DESC) AS rn FROM raw_metadata) WHERE rn = 1"""
_MERGED = """SELECT b.subgenre, b.lastfm_name, b.listeners, l.mbid, l.mb_name, l.country, l.similarity_score AS mb_resolution_score,
  CAST(CASE WHEN l.lastfm_name IS NOT NULL THEN l.formed_year ELSE b.formed_year END AS DOUBLE) AS formed_year
  FROM base b LEFT JOIN lookup l ON l.subgenre = b.subgenre AND l.lastfm_name = b.lastfm_name AND l.resolution_status = 'auto_accepted'"""


@check("j1_merge_metadata", sql("SELECT * FROM merged", "flat_artists", "raw_metadata", base=_BASE, lookup=_LOOKUP, merged=_MERGED))
def j1(spark, d):
    built = build_artists(shapes.raw_artist_info(spark, d), shapes.raw_metadata(spark, d), ["_seq"], S)
    return built.select("subgenre", "lastfm_name", "listeners", "mbid", "mb_name", "country", "mb_resolution_score", "formed_year")


@check("a20_last_row_per_key", sql("SELECT subgenre, lastfm_name, mbid, resolution_status FROM lookup", "raw_metadata", lookup=_LOOKUP))
def a20(spark, d):
    lookup = merge.metadata_lookup(shapes.raw_metadata(spark, d), ["_seq"])
    return lookup.select("subgenre", "lastfm_name", "mbid", "resolution_status")


@check("q4_stage_counts", sql("""
 SELECT subgenre, count(*) AS read_rows, count(*) FILTER (listeners >= 50000) AS floor_rows,
  count(DISTINCT CASE WHEN listeners >= 50000 THEN name_key END) AS deduped_rows,
  (SELECT count(*) FROM merged m WHERE m.subgenre = f.subgenre AND m.mbid IS NOT NULL) AS merged_rows
 FROM flat_artists f GROUP BY 1""", "flat_artists", "raw_metadata", base=_BASE, lookup=_LOOKUP, merged=_MERGED))
def q4(spark, d):
    return quality.stage_counts(flat(spark, d), merge.metadata_lookup(shapes.raw_metadata(spark, d), ["_seq"]), ["_seq"], S).drop("date")


@check("e_a4_weekly_rows", sql("SELECT artist_name, week_start, subgenre, listeners FROM weekly", "weekly"))
def e_a4(spark, d):
    return weekly.flatten_weekly(shapes.raw_weekly(spark, d)).drop("date")


@check("f8_skip_incomplete", """
 SELECT count(*) AS snapshots, count(*) FILTER (event_id % 53 <> 0) AS with_week, count(*) FILTER (event_id % 53 <> 0 AND event_id % 43 <> 0) AS named,
  count(*) FILTER (event_id % 53 <> 0 AND event_id % 43 <> 0 AND event_id % 41 <> 0) AS complete FROM events""")
def f8(spark, d):
    raw = shapes.raw_weekly(spark, d)
    kept = weekly.flatten_weekly(raw).agg(F.count("*").alias("complete"))
    return raw.agg(
        F.count("*").alias("snapshots"),
        F.count("_week_start").alias("with_week"),
        F.count_if(F.col("_week_start").isNotNull() & F.col("topartists").contains('"artist ')).alias("named"),
    ).withColumn("complete", kept.scalar())


@check("e_a5_nested_defaults", """
 SELECT p_partkey AS _seq, CASE WHEN p_partkey % 2 = 0 THEN 'id-' || p_partkey ELSE '' END AS mbid, p_partkey % 11 = 3 AS no_listeners FROM part""")
def e_a5(spark, d):
    return shapes.raw_artist_info(spark, d).select(
        "_seq", F.coalesce("mbid", F.lit("")).alias("mbid"), F.col("stats.listeners").isNull().alias("no_listeners")
    )


@check("e_j1_json_round_trip", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, '{\"k\":' || CAST(json_extract(props, '$.k') AS BIGINT) || ',\"n\":\"ü\"}' AS encoded FROM events")
def e_j1(spark, d):
    parsed = table(spark, d, "events").select("event_id", F.from_json("props", "k BIGINT").alias("p"))
    return parsed.select(
        "event_id", F.col("p.k").alias("k"), F.to_json(F.struct(F.col("p.k").alias("k"), F.lit("ü").alias("n"))).alias("encoded")
    )


@check("e_dt1_life_span_year", sql("""
 SELECT pos, CASE WHEN TRY_CAST(left(life_span_begin, 4) AS INTEGER) BETWEEN 1960 AND 2025 AND length(life_span_begin) >= 4 THEN TRY_CAST(left(life_span_begin, 4) AS INTEGER) END AS formed_year FROM candidates""", "candidates"))
def e_dt1(spark, d):
    return shapes.candidates(spark, d).select(
        "pos", dates.life_span_year(F.col("life_span_begin"), S.first_year, S.last_structured_year).alias("formed_year")
    )


@check("f7_year_bounds", sql("""
 SELECT count(*) AS candidates, count(*) FILTER (length(life_span_begin) < 4) AS unreadable, count(*) FILTER (length(life_span_begin) >= 4 AND CAST(left(life_span_begin, 4) AS INTEGER) > 1997) AS late,
  count(*) FILTER (length(life_span_begin) >= 4 AND CAST(left(life_span_begin, 4) AS INTEGER) <= 1997) AS kept FROM candidates""", "candidates"))
def f7(spark, d):
    begin = F.col("life_span_begin")
    year = dates.life_span_year(begin, S.first_year, 1997)
    return shapes.candidates(spark, d).agg(
        F.count("*").alias("candidates"),
        F.count_if(F.length(begin) < 4).alias("unreadable"),
        F.count_if((F.length(begin) >= 4) & year.isNull()).alias("late"),
        F.count(year).alias("kept"),
    )


@check("e_dt2_release_year", sql("SELECT album_id, first_release_date, release_year FROM silver_albums", "silver_albums"))
def e_dt2(spark, d):
    return shapes.silver_albums(spark, d).select("album_id", "first_release_date", "release_year")


@check("e_dt4_week_periods", """
 SELECT n_name AS tag, CAST(p AS INTEGER) AS period, strftime(DATE '1999-06-17' - CAST(p * 7 AS INTEGER), '%Y-%m-%d') AS week_end,
  strftime(DATE '1999-06-17' - CAST(p * 7 + 7 AS INTEGER), '%Y-%m-%d') AS week_start FROM nation, range(52) r(p)""")
def e_dt4(spark, d):
    tagged = table(spark, d, "nation").select(F.col("n_name").alias("tag"))
    periods = dates.periods_back(tagged, F.lit(shapes.RUN_DATE), 52)
    return periods.select("tag", "period", F.col("_week_end").alias("week_end"), F.col("_week_start").alias("week_start"))


@check("e_dt5_run_date", "SELECT o_orderkey, '1999-06-17' AS date, true AS today_is_iso FROM orders")
def e_dt5(spark, d):
    today = dates.run_date_text()
    return table(spark, d, "orders").select(
        "o_orderkey", dates.run_date_text(shapes.RUN_DATE).alias("date"), today.rlike(r"^\d{4}-\d{2}-\d{2}$").alias("today_is_iso")
    )


@check("p5_cast_numeric", "SELECT p_partkey, CAST(p_size AS DOUBLE) AS size, CASE WHEN p_partkey % 3 = 0 THEN p_retailprice END AS price FROM part")
def p5(spark, d):
    mixed = table(spark, d, "part").selectExpr(
        "p_partkey", "cast(p_size as string) as size", "case p_partkey % 3 when 0 then cast(p_retailprice as string) when 1 then 'n/a' else '' end as price"
    )
    return numbers.cast_numeric(mixed, ["size", "price", "not_there"])


@check("p6_attach_context", "SELECT p_partkey AS _seq, p_brand AS source_tag, lower(p_type) AS subgenre, '1999-06-17' AS date FROM part")
def p6(spark, d):
    return flat(spark, d).select("_seq", "source_tag", "subgenre", "date")


@check("p10_rank_index", "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders")
def p10(spark, d):
    from bandstand.functions.ordering import with_row_number

    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return with_row_number(rows, [F.col("o_totalprice").desc(), F.col("o_orderkey")], "rank").drop("o_totalprice")


@check("f9_deny_list", """
 SELECT p_partkey, name FROM (SELECT p_partkey, CASE WHEN p_partkey % 10 = 0 THEN NULL WHEN p_partkey % 3 = 0 THEN upper(p_name) ELSE p_name END AS name FROM part)
 WHERE name IS NULL OR lower(name) NOT IN ('cold widget', 'small widget', 'red bolt')""")
def f9(spark, d):
    named = table(spark, d, "part").selectExpr(
        "p_partkey", "case when p_partkey % 10 = 0 then null when p_partkey % 3 = 0 then upper(p_name) else p_name end as name"
    )
    return merge.denied_out(named, "name", ("cold widget", "small widget", "red bolt"))


@check("f10_chart_ranges", sql("""
 SELECT artist_name, current_listeners, plays_per_listener FROM all_features WHERE formed_year IS NOT NULL AND current_listeners > 50000 AND plays_per_listener > 0 AND plays_per_listener < 12""", "all_features"))
def f10(spark, d):
    rows = shapes.features(spark, d, labelled_only=False).dropna(subset=["formed_year", "current_listeners", "plays_per_listener"])
    plays = F.col("plays_per_listener")
    return rows.where((F.col("current_listeners") > 50_000) & (plays > 0) & (plays < 12)).select(
        "artist_name", "current_listeners", "plays_per_listener"
    )


@check("f12_release_types", sql("SELECT album_type, count(*) AS albums FROM albums WHERE album_type IN ('Album', 'EP', 'Single') GROUP BY 1", "albums"))
def f12(spark, d):
    return shapes.albums(spark, d).where(F.col("album_type").isin("Album", "EP", "Single")).groupBy("album_type").agg(F.count("*").alias("albums"))


@check("f14_first_containing", "SELECT p_partkey, p_name FROM part ORDER BY (p_name LIKE '%widget%') DESC, p_partkey LIMIT 1")
def f14(spark, d):
    from bandstand.sources.bronze import first_containing

    return first_containing(table(spark, d, "part").select("p_partkey", "p_name"), "p_name", "widget", [F.col("p_partkey")])


@check("f15_tier_filter", sql("SELECT artist_name, current_listeners FROM all_features WHERE current_listeners < 1800000", "all_features"))
def f15(spark, d):
    rows = shapes.features(spark, d, labelled_only=False).select("artist_name", "current_listeners")
    return rows.where(F.col("current_listeners") < S.underground_listeners)


_FOCUS = ("Customer#000000007", "Customer#000000011", "Customer#000000100")


@check("f16_focus_list", sql(f"SELECT artist_name, musicbrainz_album_id FROM albums WHERE artist_name IN {_FOCUS}", "albums"))
def f16(spark, d):
    return merge.focus_only(shapes.albums(spark, d), "artist_name", _FOCUS).select("artist_name", "musicbrainz_album_id")


@check("e_m3_clip_and_fill", """
 SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 20.0 ELSE least(greatest(value - 50, 0.0), 200.0) END AS size,
  CASE WHEN event_id % 7 <> 0 THEN least(greatest(value - 50, 6.0), 28.0) END AS clipped FROM events""")
def e_m3(spark, d):
    v = F.when(F.col("event_id") % 7 != 0, F.col("value") - 50)
    return table(spark, d, "events").select(
        "event_id", numbers.clip_or(v, 0.0, 200.0, 20.0).alias("size"), numbers.clip(v, 6.0, 28.0).alias("clipped")
    )


@check("e_m4_log_bounds", "SELECT event_type, round(log10(max(value) * 1.5), 9) AS high FROM events GROUP BY 1")
def e_m4(spark, d):
    top = table(spark, d, "events").groupBy("event_type").agg(F.max("value").alias("m"))
    return top.select("event_type", F.round(numbers.log_bound(F.col("m"), 1.5), 9).alias("high"))


@check("e_m5_half_even", "SELECT o_orderkey, round_even(o_orderkey / 16.0, 3) AS rounded FROM orders")
def e_m5(spark, d):
    return table(spark, d, "orders").select("o_orderkey", numbers.round_even(F.col("o_orderkey") / F.lit(16.0), 3).alias("rounded"))


@check("w6_arg_max_feature", """
 SELECT vec_id, CAST(list_position(list_transform(embedding, lambda x: abs(x)), list_max(list_transform(embedding, lambda x: abs(x)))) AS INTEGER) AS top_factor FROM embeddings""")
def w6(spark, d):
    return table(spark, d, "embeddings").select("vec_id", arg_max_abs(F.col("embedding")).alias("top_factor"))


@check("u1_append_batches", """
 SELECT kind, count(*) AS records, CAST(sum(k) AS BIGINT) AS key_sum FROM (SELECT 'order' AS kind, o_orderkey AS k FROM orders
 UNION ALL SELECT 'event', event_id FROM events UNION ALL SELECT 'part', p_partkey FROM part) GROUP BY 1""")
def u1(spark, d):
    def batch(name, key, kind):
        return table(spark, d, name).select(F.lit(kind).alias("kind"), F.col(key).alias("k"))

    pages = batch("orders", "o_orderkey", "order").unionByName(batch("events", "event_id", "event")).unionByName(batch("part", "p_partkey", "part"))
    return pages.groupBy("kind").agg(F.count("*").alias("records"), F.sum("k").alias("key_sum"))


@check("u2_all_scenes_at_once", sql("""
 SELECT subgenre, count(*) AS artists, CAST(sum(listeners) AS BIGINT) AS listeners FROM base GROUP BY 1""", "flat_artists", base=_BASE))
def u2(spark, d):
    built = build_artists(shapes.raw_artist_info(spark, d), shapes.raw_metadata(spark, d), ["_seq"], S)
    return built.groupBy("subgenre").agg(F.count("*").alias("artists"), F.sum("listeners").alias("listeners"))


@check("x2_tag_diversity", sql("SELECT _seq, CAST(len(list_distinct(tags)) AS INTEGER) AS tag_diversity FROM flat_artists", "flat_artists"))
def x2(spark, d):
    return flat(spark, d).select("_seq", tags.tag_diversity(F.col("subgenre_tags")).alias("tag_diversity"))


@check("s8_known_scenes", f"""
 SELECT scene, count(*) AS orders FROM (SELECT ({list(SUBGENRES)})[1 + o_orderkey % {len(SUBGENRES)}] AS scene FROM orders) GROUP BY 1""")
def s8_scenes(spark, d):
    scenes = F.array(*[F.lit(s) for s in SUBGENRES])
    return table(spark, d, "orders").groupBy(scenes[(F.col("o_orderkey") % len(SUBGENRES)).cast("int")].alias("scene")).agg(
        F.count("*").alias("orders")
    )
