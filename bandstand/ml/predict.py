"""Training run and ranked predictions."""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession, functions as F

from bandstand.functions.ordering import with_row_number
from bandstand.functions.ranking import arg_max_abs
from bandstand.functions.tiers import prediction_tier
from bandstand.ml import boosting, explain, metrics, prep, split, trees
from bandstand.runtime import Scratch
from bandstand.settings import DEFAULTS, Settings

KEY = "artist_name"


class TrainedRun:
    """Everything a training run produces; ``train`` stays lazy and reads the stored split, ``test`` is scored and stored once."""

    def __init__(self, spec, model, fitted, rows, params, test=None):
        self.spec, self.model, self.fitted, self.rows, self.params = spec, model, fitted, rows, params
        self.train = self._matrix(~F.col("is_test"))
        if test is None:
            scored = score(boosting.raw_probability(self._matrix(F.col("is_test")), model, "raw_probability"), fitted)
            test = Scratch(rows.sparkSession, "scored").write(scored)
        self.test = test

    def _matrix(self, part) -> DataFrame:
        return prep.to_matrix(prep.apply_features(self.rows.where(part), self.spec))

    @property
    def test_metrics(self) -> DataFrame:
        return evaluate(self.test)

    def record(self) -> DataFrame:
        """The run as one row: sizes of both parts, the features and the metrics."""
        sizes = self.rows.agg(F.count_if(~F.col("is_test")).alias("n_train"), F.count_if("is_test").alias("n_test")).first()
        named = {k: F.lit(v) for k, v in sizes.asDict().items()} | {"features": F.lit(",".join(prep.ALL_FEATURES))}
        return self.test_metrics.withColumns(named)

    def save(self, spark: SparkSession, path: str) -> None:
        """Models, preparation, parameters, the split and the scored test part; ``params`` is written last and marks a whole run."""
        self.rows.write.mode("overwrite").parquet(f"{path}/rows")
        self.test.write.mode("overwrite").parquet(f"{path}/test")
        self.model.save(spark, f"{path}/model")
        self.fitted.save(spark, f"{path}/folds")
        self.spec.save(spark, f"{path}/spec")
        spark.createDataFrame([(json.dumps(self.params),)], "params STRING").write.mode("overwrite").parquet(f"{path}/params")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "TrainedRun":
        params = json.loads(spark.read.parquet(f"{path}/params").first()["params"])
        model = trees.BoostedTrees.load(spark, f"{path}/model")
        fitted = boosting.Calibrated.load(spark, f"{path}/folds")
        rows, test = (spark.read.parquet(f"{path}/{x}") for x in ("rows", "test"))
        return TrainedRun(prep.FeatureSpec.load(spark, f"{path}/spec"), model, fitted, rows, params, test)


def train_run(features: DataFrame, params: boosting.BoostParams, s: Settings = DEFAULTS) -> TrainedRun:
    """Split, fit the preparation on the training part only, boost, calibrate and evaluate.

    The model columns and the split are written down once, so that the marts behind them do not run again.
    """
    scratch = Scratch(features.sparkSession, "training")
    columns = scratch.write(prep.load_model_columns(features))
    rows = scratch.write(split.stratified_split(columns, prep.TARGET, KEY, s))
    train_raw = rows.where(~F.col("is_test"))
    spec = prep.fit_features(train_raw, s)
    train = prep.to_matrix(prep.apply_features(train_raw, spec))
    model, fitted = boosting.fit_models(train, prep.TARGET, KEY, params, s)
    return TrainedRun(spec, model, fitted, rows, asdict(params))


def score(df: DataFrame, fitted: boosting.Calibrated) -> DataFrame:
    return boosting.with_prediction(
        boosting.calibrated_probability(df, fitted, "breakout_probability"), "breakout_probability"
    )


def evaluate(scored: DataFrame) -> DataFrame:
    """One row: ranking metrics and both Brier scores."""
    ranking = metrics.ranking_metrics(scored, prep.TARGET, "breakout_probability")
    brier = scored.agg(
        F.avg(F.pow(F.col("breakout_probability") - F.col(prep.TARGET), F.lit(2.0))).alias("brier_score"),
        F.avg(F.pow(F.col("raw_probability") - F.col(prep.TARGET), F.lit(2.0))).alias("brier_score_uncalibrated"),
    ).first()
    return ranking.select("roc_auc", "avg_precision", *[F.lit(v).alias(k) for k, v in brier.asDict().items()])


def prediction_table(features: DataFrame, spec: prep.FeatureSpec, fitted: boosting.Calibrated, s: Settings = DEFAULTS) -> DataFrame:
    """Score every artist: calibrated probability, strongest factor and tier."""
    prepared = prep.to_matrix(prep.apply_features(prep.load_model_columns(features, labelled_only=False), spec))
    explained = explain.mean_attribution(score(prepared, fitted), fitted.models, prep.ALL_FEATURES)
    return assemble_predictions(explained, s)


def assemble_predictions(explained: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    names = F.array(*[F.lit(f) for f in prep.ALL_FEATURES])
    top = arg_max_abs(F.col("contributions"))
    return explained.select(
        KEY,
        F.col("subgenre_name").alias("subgenre"),
        "country",
        F.col("formed_year").cast("int").alias("formed_year"),
        F.col("current_listeners").cast("bigint").alias("current_listeners"),
        F.col("total_albums_raw").cast("bigint").alias("total_albums"),
        F.bround("breakout_probability", 3).alias("breakout_probability"),
        F.element_at(names, top).alias("top_breakout_factor"),
        F.bround(F.element_at("contributions", top), 3).alias("top_factor_shap"),
        prediction_tier(F.col("current_listeners"), s).alias("current_tier"),
    )


def underground_ranking(predictions: DataFrame, s: Settings = DEFAULTS) -> DataFrame:
    """Underground artists with their 1-based rank by probability, ties by name."""
    below = predictions.where(F.col("current_listeners") < s.underground_listeners)
    return with_row_number(below, [F.col("breakout_probability").desc(), F.col(KEY)], "rank")
