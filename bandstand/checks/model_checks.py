"""Feature preparation, splits, metrics, models and predictions."""

from __future__ import annotations

import hashlib

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from bandstand.checks import shapes
from bandstand.checks.registry import check
from bandstand.checks.shapes import CHECK_SETTINGS as S
from bandstand.checks.shapes import sql, table
from bandstand.functions import ordering
from bandstand.functions.ranking import top_factor
from bandstand.ml import boosting, explain, metrics, predict, prep, split
from bandstand.runtime import Scratch, path_exists, scratch_path, shared_dir
from bandstand.schemas import MODEL_COLUMNS
from bandstand.settings import NUMERIC_FEATURES
from bandstand.sources import marts

# The full setting, all rounds.
PARAMS = boosting.BoostParams()


def trained(spark, d) -> predict.TrainedRun:
    """The saved training run of the data folder: it is trained in full the first time that a session asks for it."""
    name = hashlib.sha256(f"{spark.sparkContext.applicationId}:{d}:{PARAMS}".encode()).hexdigest()[:16]
    path = f"{shared_dir(spark)}/trained-{name}"
    if not path_exists(spark, f"{path}/params/_SUCCESS"):
        predict.train_run(shapes.stored_features(spark, d), PARAMS, S).save(spark, path)
    return predict.TrainedRun.load(spark, path)


def scored(spark, d):
    """A bounded score with many ties beside a label, on every customer."""
    return table(spark, d, "customer").selectExpr(
        "c_custkey", "cast(c_custkey * 37 % 101 as double) / 100 as score",
        "case when (c_custkey * 37 % 101) + (c_custkey * 53 % 60) > 90 then 1 else 0 end as label",
    )


_SCORED = """SELECT c_custkey, CAST(c_custkey * 37 % 101 AS DOUBLE) / 100 AS score,
  CASE WHEN (c_custkey * 37 % 101) + (c_custkey * 53 % 60) > 90 THEN 1 ELSE 0 END AS label FROM customer"""

_MODEL_SQL = ", ".join(
    c if c in ("artist_name", "subgenre", "country") else f"CAST({c} AS DOUBLE) AS {c}" for c in MODEL_COLUMNS
)


@check("p4_model_columns", sql(f"SELECT {_MODEL_SQL} FROM features", "features"))
def p4(spark, d):
    return prep.load_model_columns(shapes.features(spark, d))


@check("a13_value_counts", sql("SELECT country, count(*) AS n FROM features WHERE country IS NOT NULL GROUP BY 1", "features"))
def a13(spark, d):
    return prep.value_counts(shapes.stored_features(spark, d), "country")


_TOP = "SELECT country FROM (SELECT country, count(*) AS n FROM features WHERE country IS NOT NULL GROUP BY 1 ORDER BY n DESC, country LIMIT 10)"


@check("m1_country_buckets", sql("SELECT country_bucketed, count(*) AS artists FROM (SELECT CASE WHEN country IN (SELECT country FROM top) THEN country ELSE 'Other' END AS country_bucketed FROM features) GROUP BY 1", "features", top=_TOP))
def m1(spark, d):
    rows = shapes.stored_features(spark, d)
    return prep.bucket_country(rows, prep.top_values(rows, "country", S.top_countries)).groupBy("country_bucketed").agg(F.count("*").alias("artists"))


_CODES = """SELECT artist_name, (dense_rank() OVER (ORDER BY subgenre)) - 1 AS code FROM features"""


@check("m2_label_codes", sql("SELECT subgenre AS label, CAST(dense_rank() OVER (ORDER BY subgenre) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT subgenre FROM features)", "features"))
def m2(spark, d):
    return prep.label_codes(shapes.stored_features(spark, d), "subgenre")


_MEDIANS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS n, median(CAST({c} AS DOUBLE)) AS median FROM features" for c in NUMERIC_FEATURES
)


@check("a14_exact_medians", sql(_MEDIANS, "features"))
def a14(spark, d):
    return ordering.exact_medians(shapes.stored_features(spark, d), list(NUMERIC_FEATURES))


@check("a14_medians_of_orders", """
 SELECT 'o_totalprice' AS feature, count(o_totalprice) AS n, median(o_totalprice) AS median FROM orders
 UNION ALL SELECT 'o_custkey', count(o_custkey), median(CAST(o_custkey AS DOUBLE)) FROM orders""")
def a14_orders(spark, d):
    return ordering.exact_medians(table(spark, d, "orders"), ["o_totalprice", "o_custkey"])


_IMPUTED = "SELECT artist_name, " + ", ".join(
    f"coalesce(CAST({c} AS DOUBLE), (SELECT median(CAST({c} AS DOUBLE)) FROM features)) AS {c}" for c in NUMERIC_FEATURES
) + " FROM features"


@check("m3_median_imputation", sql(_IMPUTED, "features"))
def m3(spark, d):
    rows = shapes.stored_features(spark, d)
    return prep.apply_features(rows, prep.fit_features(rows, S)).select("artist_name", *NUMERIC_FEATURES)


@check("q5_imputation_report", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, median(CAST({c} AS DOUBLE)) AS median, count(*) - count({c}) AS imputed FROM features" for c in NUMERIC_FEATURES), "features"))
def q5(spark, d):
    rows = shapes.stored_features(spark, d)
    return prep.imputation_report(rows, prep.fit_features(rows, S))


@check("p8_feature_matrix", sql(f"""
 SELECT artist_name, CAST(9 AS INTEGER) AS width, round(band_age_years + total_albums + studio_albums + avg_years_between_albums + years_since_last_release + plays_per_listener + mb_resolution_score, 6) AS numeric_sum,
  CAST((SELECT count(DISTINCT subgenre) FROM features f WHERE f.subgenre < g.subgenre) AS DOUBLE) AS subgenre_code
 FROM imputed JOIN features g USING (artist_name)""".replace("band_age_years +", "imputed.band_age_years +").replace(" total_albums", " imputed.total_albums").replace(" studio_albums", " imputed.studio_albums").replace(" avg_years", " imputed.avg_years").replace(" years_since", " imputed.years_since").replace(" plays_per", " imputed.plays_per").replace(" mb_res", " imputed.mb_res"),
 "features", imputed=_IMPUTED))
def p8(spark, d):
    rows = shapes.stored_features(spark, d)
    matrix = prep.to_matrix(prep.apply_features(rows, prep.fit_features(rows, S)))
    v = vector_to_array("features")
    numeric = F.aggregate(F.slice(v, 1, len(NUMERIC_FEATURES)), F.lit(0.0), lambda a, x: a + x)
    return matrix.select(
        "artist_name", F.size(v).alias("width"), F.round(numeric, 6).alias("numeric_sum"), v[len(NUMERIC_FEATURES)].alias("subgenre_code")
    )


_SPLIT = """SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5(key || ':42'), key) <= k AS is_test FROM rows JOIN (
  SELECT label AS l, n, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, label) <= wanted - sum(base) OVER () THEN 1 ELSE 0 END AS k FROM (
   SELECT label, n, wanted, (wanted * n) // total AS base, (wanted * n) % total AS rest FROM (
    SELECT label, n, CAST(sum(n) OVER () AS BIGINT) AS total, CAST(ceil(CAST(0.2 AS DOUBLE) * CAST(sum(n) OVER () AS BIGINT)) AS BIGINT) AS wanted FROM (SELECT label, count(*) AS n FROM rows GROUP BY 1)))) ON l = label"""


@check("m4_stratified_split", sql("SELECT artist_name, is_breakout, is_test FROM split", "features",
    rows="SELECT *, artist_name AS key, is_breakout AS label FROM features", split=_SPLIT))
def m4(spark, d):
    rows = shapes.stored_features(spark, d).select("artist_name", "is_breakout")
    return split.stratified_split(rows, "is_breakout", "artist_name", S)


@check("m4_split_of_labels", sql("SELECT doc_id, quality, is_test FROM split",
    rows="SELECT doc_id, quality, CAST(doc_id AS VARCHAR) AS key, quality AS label FROM labels", split=_SPLIT))
def m4_labels(spark, d):
    rows = table(spark, d, "labels").select("doc_id", "quality", F.col("doc_id").cast("string").alias("key"))
    return split.stratified_split(rows, "quality", "key", S).drop("key")


@check("a16_positive_rate", sql("SELECT is_test, count(*) AS n, avg(CAST(is_breakout AS DOUBLE)) AS positive_rate FROM split GROUP BY 1", "features",
    rows="SELECT *, artist_name AS key, is_breakout AS label FROM features", split=_SPLIT))
def a16(spark, d):
    rows = shapes.stored_features(spark, d).select("artist_name", "is_breakout")
    return split.split_rates(split.stratified_split(rows, "is_breakout", "artist_name", S), "is_breakout")


@check("m7_stratified_folds", """
 WITH rows AS (SELECT doc_id, quality, CAST(doc_id AS VARCHAR) AS key FROM labels),
 ranked AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY md5(key || ':fold-42'), key) AS rn, count(*) OVER (PARTITION BY quality) AS n FROM rows)
 SELECT doc_id, CAST((rn > n // 5)::INT + (rn > n * 2 // 5)::INT + (rn > n * 3 // 5)::INT + (rn > n * 4 // 5)::INT AS INTEGER) AS fold FROM ranked""")
def m7_folds(spark, d):
    rows = table(spark, d, "labels").select("doc_id", "quality", F.col("doc_id").cast("string").alias("key"))
    return split.stratified_folds(rows, "quality", "key", S.folds, f"fold-{S.seed}").select("doc_id", "fold")


@check("a15_class_ratio", sql("SELECT count(*) FILTER (is_breakout = 0) AS n_neg, count(*) FILTER (is_breakout = 1) AS n_pos, CAST(count(*) FILTER (is_breakout = 0) AS DOUBLE) / count(*) FILTER (is_breakout = 1) AS weight FROM features", "features"))
def a15(spark, d):
    return split.positive_weight(shapes.features(spark, d), "is_breakout")


@check("m5_row_weights", """
 SELECT doc_id, CASE WHEN quality = 1 THEN (SELECT CAST(count(*) FILTER (quality = 0) AS DOUBLE) / count(*) FILTER (quality = 1) FROM labels) ELSE 1.0 END AS weight FROM labels""")
def m5(spark, d):
    rows = table(spark, d, "labels")
    ratio = split.positive_weight(rows, "quality").select("weight").scalar()
    return rows.select("doc_id", F.when(F.col("quality") == 1, ratio).otherwise(F.lit(1.0)).alias("weight"))


_RANKING = """
 SELECT CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg,
  round(CAST(sum(neg * (2 * tp - pos)) AS DOUBLE) / (2.0 * sum(pos) * sum(neg)), 12) AS roc_auc, round(sum(pos * tp / CAST(tp + fp AS DOUBLE)) / sum(pos), 12) AS avg_precision FROM (
  SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp FROM (
   SELECT score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM scored GROUP BY 1))"""


def ranking(spark, d):
    return metrics.ranking_metrics(scored(spark, d), "label", "score").withColumns(
        {c: F.round(c, 12) for c in ("roc_auc", "avg_precision")}
    )


@check("m9_roc_auc", sql(f"SELECT n_pos, n_neg, roc_auc FROM ({_RANKING})", scored=_SCORED))
def m9(spark, d):
    return ranking(spark, d).drop("avg_precision")


@check("m10_average_precision", sql(f"SELECT n_pos, avg_precision FROM ({_RANKING})", scored=_SCORED))
def m10(spark, d):
    return ranking(spark, d).select("n_pos", "avg_precision")


@check("m11_brier", sql("SELECT round(avg(pow(score - label, 2)), 12) AS brier_score FROM scored", scored=_SCORED))
def m11(spark, d):
    return metrics.brier_score(scored(spark, d), "label", "score").select(F.round("brier_score", 12).alias("brier_score"))


_CONFUSION = "SELECT count(*) FILTER (label = 1 AND p = 1) AS tp, count(*) FILTER (label = 0 AND p = 1) AS fp, count(*) FILTER (label = 1 AND p = 0) AS fn, count(*) FILTER (label = 0 AND p = 0) AS tn FROM (SELECT label, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS p FROM scored)"
_LINES = """SELECT 'Underground' AS class, tn / CAST(tn + fn AS DOUBLE) AS precision, tn / CAST(tn + fp AS DOUBLE) AS recall, 2 * tn / CAST(2 * tn + fn + fp AS DOUBLE) AS f1, tn + fp AS support FROM cells
 UNION ALL SELECT 'Breakout', tp / CAST(tp + fp AS DOUBLE), tp / CAST(tp + fn AS DOUBLE), 2 * tp / CAST(2 * tp + fn + fp AS DOUBLE), tp + fn FROM cells"""


@check("m12_classification_report", sql("""
 SELECT class, round(precision, 12) AS precision, round(recall, 12) AS recall, round(f1, 12) AS f1, support FROM (SELECT * FROM lines
  UNION ALL SELECT 'accuracy', (tp + tn) / CAST(tp + tn + fp + fn AS DOUBLE), (tp + tn) / CAST(tp + tn + fp + fn AS DOUBLE), (tp + tn) / CAST(tp + tn + fp + fn AS DOUBLE), tp + tn + fp + fn FROM cells
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM lines
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM lines)""",
 scored=_SCORED, cells=_CONFUSION, lines=_LINES))
def m12(spark, d):
    predicted = boosting.with_prediction(scored(spark, d), "score")
    report = metrics.classification_report(predicted, "label", "predicted", {0: "Underground", 1: "Breakout"})
    return report.select("class", *[F.round(c, 12).alias(c) for c in ("precision", "recall", "f1")], "support")


@check("s15_run_metrics", sql(f"SELECT 'demo' AS run_name, '3' AS rounds, roc_auc, avg_precision FROM ({_RANKING})", scored=_SCORED))
def s15(spark, d):
    path = scratch_path(spark, "runs")
    log = marts.append_run_metrics(spark, path, "demo", {"rounds": 3}, ranking(spark, d))
    return log.select("run_name", F.col("params")["rounds"].alias("rounds"), "roc_auc", "avg_precision")


_ROWS = "SELECT *, artist_name AS key, is_breakout AS label FROM features"


def rebuilt_probability(df, model, name):
    """The model's probability once more, from its leaves as the attributions read them: the sigmoid of the margin."""
    explained = explain.attribute(df, model, prep.ALL_FEATURES, "_c")
    margin = F.aggregate("_c", F.col("base_value"), lambda a, x: a + x)
    return explained.withColumn(name, 1 / (1 + F.exp(-margin))).drop("_c", "base_value")


@check("m6_boosted_trees", sql("SELECT is_breakout, count(*) AS artists, count(*) AS agreeing FROM split WHERE is_test GROUP BY 1", "features", rows=_ROWS, split=_SPLIT))
def m6(spark, d):
    run = trained(spark, d)
    agrees = F.abs(F.col("raw_probability") - F.col("_again")) < 1e-6
    return rebuilt_probability(run.test, run.model, "_again").groupBy(F.col("is_breakout").cast("int").alias("is_breakout")).agg(
        F.count("*").alias("artists"), F.count_if(agrees).alias("agreeing")
    )


@check("m7_calibrated_probability", sql("SELECT artist_name, true AS agrees FROM split WHERE is_test", "features", rows=_ROWS, split=_SPLIT))
def m7(spark, d):
    run = trained(spark, d)
    rows, total = run.test, F.lit(0.0)
    for i, (model, slope, offset) in enumerate(zip(run.fitted.models, run.fitted.slopes, run.fitted.offsets)):
        rows = rebuilt_probability(rows, model, f"_again{i}")
        total = total + 1 / (1 + F.exp(-(slope * F.col(f"_again{i}") + offset)))
    mean = total / len(run.fitted.models)
    return rows.select("artist_name", (F.abs(F.col("breakout_probability") - mean) < 1e-6).alias("agrees"))


@check("m8_threshold", sql("SELECT is_breakout, count(*) AS artists, count(*) AS agreeing FROM split WHERE is_test GROUP BY 1", "features", rows=_ROWS, split=_SPLIT))
def m8(spark, d):
    agrees = (F.col("predicted") == 1) == (F.col("breakout_probability") >= 0.5)
    return trained(spark, d).test.groupBy(F.col("is_breakout").cast("int").alias("is_breakout")).agg(F.count("*").alias("artists"), F.count_if(agrees).alias("agreeing"))


@check("m11_model_metrics", "SELECT true AS roc_auc, true AS avg_precision, true AS brier_score, true AS brier_score_uncalibrated")
def m11_model(spark, d):
    """Each metric against a second formula: ranks read from the other end, squares multiplied out."""
    run = trained(spark, d)
    got = run.test_metrics.first()
    y = F.col(prep.TARGET)
    p, raw = F.col("breakout_probability"), F.col("raw_probability")
    turned = metrics.ranking_metrics(run.test.withColumn("_p", -p), prep.TARGET, "_p").first()["roc_auc"]
    ranked = metrics.score_counts(run.test, prep.TARGET, "breakout_probability")
    whole = ranked.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).first()
    upto = ordering.with_running_totals(ranked, [F.col("score")], {"p": F.col("pos"), "n": F.col("neg")})
    hits, misses = whole["p"] - F.col("p") + F.col("pos"), whole["n"] - F.col("n") + F.col("neg")
    precise = upto.agg(F.sum(F.col("pos") * hits / (hits + misses)) / F.sum("pos")).first()[0]
    brier = [run.test.agg(F.avg(x * x) - 2 * F.avg(x * y) + F.avg(y)).first()[0] for x in (p, raw)]
    again = {"roc_auc": 1 - turned, "avg_precision": precise, "brier_score": brier[0], "brier_score_uncalibrated": brier[1]}
    return spark.range(1).select(*[F.lit(abs(got[k] - v) < 1e-9).alias(k) for k, v in again.items()])


@check("m13_attributions_add_up", sql("SELECT count(*) AS artists, count(*) AS additive FROM split WHERE NOT is_test", "features",
    rows="SELECT *, artist_name AS key, is_breakout AS label FROM features", split=_SPLIT))
def m13(spark, d):
    run = trained(spark, d)
    explained = explain.attribute(boosting.with_margins(run.train, [run.model], "_margins"), run.model, prep.ALL_FEATURES)
    total = F.aggregate("contributions", F.col("base_value"), lambda a, x: a + x)
    margin = F.col("_margins")[0]
    return explained.agg(F.count("*").alias("artists"), F.count_if(F.abs(total - margin) < 1e-6).alias("additive"))


@check("a17_global_importance", " UNION ALL ".join(f"SELECT '{f}' AS feature, true AS agrees" for f in prep.ALL_FEATURES))
def a17(spark, d):
    """Importance of every feature against a second aggregation, column by column."""
    run = trained(spark, d)
    explained = Scratch(spark, "attributions").write(explain.attribute(run.train, run.model, prep.ALL_FEATURES).select("contributions"))
    again = explained.agg(*[F.avg(F.abs(F.col("contributions")[i])).alias(f) for i, f in enumerate(prep.ALL_FEATURES)])
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("again")) for f in prep.ALL_FEATURES])
    both = explain.global_importance(explained, prep.ALL_FEATURES).join(again.select(F.inline(pairs)), "feature")
    agrees = (F.abs(F.col("mean_abs_shap") - F.col("again")) < 1e-9) & (F.col("mean_abs_shap") >= 0)
    return both.select("feature", agrees.alias("agrees"))


@check("a17_mean_absolute", """
 SELECT at AS feature, round(avg(abs(v)), 9) AS mean_abs FROM (SELECT 'v' || generate_subscripts(embedding, 1) AS at, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings) GROUP BY 1""".replace(" at ", " place ").replace("AS at", "AS place").replace("SELECT at", "SELECT place"))
def a17_embeddings(spark, d):
    rows = table(spark, d, "embeddings").select(F.col("embedding").cast("array<double>").alias("contributions"))
    names = [f"v{i}" for i in range(1, 65)]
    out = explain.global_importance(rows, names)
    return out.select("feature", F.round("mean_abs_shap", 9).alias("mean_abs"))


@check("t3_importance_order", """
 SELECT feature, CAST(row_number() OVER (ORDER BY m DESC, feature) AS BIGINT) AS place FROM (SELECT event_type AS feature, avg(abs(value)) AS m FROM events GROUP BY 1)""")
def t3_importance(spark, d):
    means = table(spark, d, "events").groupBy(F.col("event_type").alias("feature")).agg(F.avg(F.abs("value")).alias("m"))
    return ordering.with_row_number(means, [F.col("m").desc(), F.col("feature")], "place").drop("m")


@check("m14_top_factor", """
 SELECT vec_id, 'f' || list_position(list_transform(embedding, lambda x: abs(x)), list_max(list_transform(embedding, lambda x: abs(x)))) AS factor FROM embeddings""")
def m14(spark, d):
    names = F.array(*[F.lit(f"f{i}") for i in range(1, 65)])
    return table(spark, d, "embeddings").select("vec_id", top_factor(F.col("embedding"), names).alias("factor"))


def predictions(spark, d):
    run = trained(spark, d)
    return predict.prediction_table(shapes.features(spark, d, labelled_only=False), run.spec, run.fitted, S)


@check("m15_predictions", sql("SELECT artist_name, true AS probability_fits, true AS factor_fits FROM all_features", "all_features"))
def m15(spark, d):
    """Every prediction: a probability in three places, and the factor whose share is largest in either direction."""
    run = trained(spark, d)
    rows = prep.load_model_columns(shapes.features(spark, d, labelled_only=False), labelled_only=False)
    prepared = prep.to_matrix(prep.apply_features(rows, run.spec))
    explained = explain.mean_attribution(predict.score(prepared, run.fitted), run.fitted.models, prep.ALL_FEATURES)
    explained = Scratch(spark, "attributions").write(explained.drop("features"))  # both sides of the join read it
    shares = F.map_from_arrays(F.array(*[F.lit(f) for f in prep.ALL_FEATURES]), "contributions")
    raw = explained.select("artist_name", F.col("breakout_probability").alias("_p"), shares.alias("_shares"))
    p, factor = F.col("breakout_probability"), F.element_at("_shares", F.col("top_breakout_factor"))
    largest = F.array_max(F.transform(F.map_values("_shares"), lambda x: F.abs(x)))
    joined = predict.assemble_predictions(explained, S).join(raw, "artist_name")
    return joined.select(
        "artist_name",
        (p.between(0, 1) & (F.abs(p - F.col("_p")) <= 0.0005 + 1e-12)).alias("probability_fits"),
        ((F.abs(factor) == largest) & (F.abs(F.col("top_factor_shap") - factor) <= 0.0005 + 1e-12)).alias("factor_fits"),
    )


@check("m15_prediction_rows", sql("""
 SELECT artist_name, subgenre, country, formed_year, current_listeners, total_albums,
  CASE WHEN current_listeners <= 0 THEN NULL WHEN current_listeners <= 1800000 THEN 'Underground' WHEN current_listeners <= 3000000 THEN 'Rising' ELSE 'Breakout' END AS current_tier FROM all_features""", "all_features"))
def m15_rows(spark, d):
    return predictions(spark, d).drop("breakout_probability", "top_breakout_factor", "top_factor_shap")


def stand_in_predictions(spark, d):
    """The prediction table with a computed score in place of the model's."""
    rows = shapes.features(spark, d, labelled_only=False)
    number = F.substring("artist_name", -9, 9)
    explained = rows.withColumns(
        {
            "subgenre_name": F.col("subgenre"),
            "total_albums_raw": F.col("total_albums"),
            "contributions": F.array(*[F.pmod(F.xxhash64(F.trim("artist_name")), F.lit(7 + i)).cast("double") for i in range(9)]),
            "breakout_probability": F.regexp_extract(F.trim("artist_name"), r"(\d+)$", 1).cast("bigint") * 37 % 101 / 100,
        }
    )
    return predict.assemble_predictions(explained, S)


_STAND_IN = """SELECT *, round_even(CAST(regexp_extract(trim(artist_name), '(\\d+)$', 1) AS BIGINT) * 37 % 101 / CAST(100 AS DOUBLE), 3) AS breakout_probability,
  CASE WHEN current_listeners <= 1800000 THEN 'Underground' WHEN current_listeners <= 3000000 THEN 'Rising' ELSE 'Breakout' END AS current_tier FROM all_features"""


@check("w7_underground_ranking", sql("""
 SELECT artist_name, breakout_probability, row_number() OVER (ORDER BY breakout_probability DESC, artist_name) AS rank FROM preds WHERE current_listeners < 1800000""", "all_features", preds=_STAND_IN))
def w7(spark, d):
    return predict.underground_ranking(stand_in_predictions(spark, d), S).select("artist_name", "breakout_probability", "rank")


@check("s12_prediction_csv", sql("SELECT artist_name, subgenre, country, current_listeners, breakout_probability, current_tier FROM preds", "all_features", preds=_STAND_IN))
def s12(spark, d):
    path = marts.export_csv(stand_in_predictions(spark, d), scratch_path(spark, "predictions"))
    rows = marts.read_csv(spark, path, "breakout_predictions")
    return rows.select("artist_name", "subgenre", "country", "current_listeners", "breakout_probability", "current_tier")


@check("t2_top_predictions", sql("""
 SELECT artist_name, breakout_probability FROM preds WHERE current_tier = 'Underground' ORDER BY breakout_probability DESC, artist_name LIMIT 20""", "all_features", preds=_STAND_IN))
def t2(spark, d):
    from bandstand.plans.charts import breakout_ranking

    return breakout_ranking(stand_in_predictions(spark, d)).select("artist_name", "breakout_probability")


@check("v4_breakout_ranking", sql("""
 SELECT artist_name, breakout_probability * 100 AS prob_pct, printf('%.1f%%', breakout_probability * 100) AS prob_text, '#888' AS color,
  artist_name || ' (' || upper(left(subgenre, 1)) || substr(subgenre, 2) || ')' AS label FROM preds WHERE current_tier = 'Underground' ORDER BY breakout_probability DESC, artist_name LIMIT 20""", "all_features", preds=_STAND_IN))
def v4(spark, d):
    from bandstand.plans.charts import breakout_ranking

    return breakout_ranking(stand_in_predictions(spark, d)).select("artist_name", "prob_pct", "prob_text", "color", "label")


@check("p12_percent_columns", sql("SELECT artist_name, breakout_probability * 100 AS prob_pct, printf('%.1f%%', breakout_probability * 100) AS prob_text FROM preds", "all_features", preds=_STAND_IN))
def p12(spark, d):
    from bandstand.functions.text import percent_label

    pct = F.col("breakout_probability") * 100
    return stand_in_predictions(spark, d).select("artist_name", pct.alias("prob_pct"), percent_label(pct).alias("prob_text"))


@check("x8_fit_on_train_only", sql("""
 SELECT artist_name, coalesce(CAST(mb_resolution_score AS DOUBLE), (SELECT median(CAST(mb_resolution_score AS DOUBLE)) FROM split WHERE NOT is_test)) AS mb_resolution_score,
  coalesce(CAST(band_age_years AS DOUBLE), (SELECT median(CAST(band_age_years AS DOUBLE)) FROM split WHERE NOT is_test)) AS band_age_years FROM split WHERE is_test""", "features",
    rows="SELECT *, artist_name AS key, is_breakout AS label FROM features", split=_SPLIT))
def x8(spark, d):
    rows = split.stratified_split(shapes.stored_features(spark, d), "is_breakout", "artist_name", S)
    path = scratch_path(spark, "spec")
    prep.fit_features(rows.where(~F.col("is_test")), S).save(spark, path)
    spec = prep.FeatureSpec.load(spark, path)
    return prep.apply_features(rows.where("is_test"), spec).select("artist_name", "mb_resolution_score", "band_age_years")
