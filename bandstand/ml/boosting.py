"""Weighted boosted trees and Platt calibration over stratified folds."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bandstand.ml.split import positive_weight, stratified_folds
from bandstand.ml.trees import BoostedTrees, BoostParams, fit_together, with_margins
from bandstand.settings import DEFAULTS, Settings


@dataclass(frozen=True)
class Calibrated:
    """Fold models with the sigmoid ``1 / (1 + exp(-(slope * p + offset)))`` of each."""

    models: list[BoostedTrees]
    slopes: list[float]
    offsets: list[float]

    def save(self, spark: SparkSession, path: str) -> None:
        for i, model in enumerate(self.models):
            model.save(spark, f"{path}/fold={i}")
        rows = [(i, a, b) for i, (a, b) in enumerate(zip(self.slopes, self.offsets))]
        spark.createDataFrame(rows, "fold INT, slope DOUBLE, offset DOUBLE").write.mode("overwrite").parquet(
            f"{path}/sigmoids"
        )

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Calibrated":
        rows = sorted(spark.read.parquet(f"{path}/sigmoids").collect())  # one row per fold
        models = [BoostedTrees.load(spark, f"{path}/fold={r['fold']}") for r in rows]
        return Calibrated(models, [r["slope"] for r in rows], [r["offset"] for r in rows])


def fit_boosted(train: DataFrame, label: str, params: BoostParams = BoostParams(), key: str | None = None) -> BoostedTrees:
    """Fit on ``features`` and ``label``; positives weigh n_neg / n_pos."""
    return fit_together(train, label, [None], params, key)[0]


def raw_probability(df: DataFrame, model: BoostedTrees, name: str) -> DataFrame:
    return with_margins(df, [model], "_margins").withColumn(name, _sigmoid(F.col("_margins")[0])).drop("_margins")


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def fit_sigmoid(scored: DataFrame, label: str, score: str) -> tuple[float, float]:
    """Platt's sigmoid with smoothed targets: each row enters as a weighted positive and negative."""
    n = positive_weight(scored, label).first()
    high, low = (n["n_pos"] + 1.0) / (n["n_pos"] + 2.0), 1.0 / (n["n_neg"] + 2.0)
    target = F.when(F.col(label) == 1, high).otherwise(low)
    sides = F.array(
        F.struct(F.lit(1.0).alias("_y"), target.alias("_w")),
        F.struct(F.lit(0.0).alias("_y"), (1 - target).alias("_w")),
    )
    rows = scored.select(array_to_vector(F.array(score)).alias("_x"), F.inline(sides))
    fit = LogisticRegression(featuresCol="_x", labelCol="_y", weightCol="_w", standardization=False).fit(rows)
    return float(fit.coefficients[0]), float(fit.intercept)


def fit_models(
    train: DataFrame, label: str, key: str, params: BoostParams = BoostParams(), s: Settings = DEFAULTS
) -> tuple[BoostedTrees, Calibrated]:
    """The model of all rows and the calibrated models of the folds, grown in the same jobs.

    Per fold: boost on the other folds, fit the sigmoid on the probabilities of the fold itself.
    """
    rows = stratified_folds(train, label, key, s.folds, f"fold-{s.seed}").cache()
    whole, *models = fit_together(rows, label, [None, *range(s.folds)], params, key)
    own = _sigmoid(F.element_at("_margins", F.col("fold").cast("int") + 1))
    held_out = with_margins(rows, models, "_margins").select("fold", label, own.alias("_p")).cache()
    fits = side_by_side(
        train.sparkSession, [lambda i=i: fit_sigmoid(held_out.where(F.col("fold") == i), label, "_p") for i in range(s.folds)]
    )
    held_out.unpersist()
    rows.unpersist()
    slopes, offsets = (list(x) for x in zip(*fits))
    return whole, Calibrated(models, slopes, offsets)


def side_by_side(spark: SparkSession, tasks: list) -> list:
    """Run independent driver functions in threads, so that Spark works on their jobs at the same time."""
    with ThreadPoolExecutor(len(tasks)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(t)) for t in tasks]]


def calibrated_probability(df: DataFrame, fitted: Calibrated, name: str) -> DataFrame:
    """Mean of the folds' calibrated probabilities; the rows pass all models at once."""
    parts = [
        _sigmoid(F.lit(a) * _sigmoid(F.col("_margins")[i]) + F.lit(b))
        for i, (a, b) in enumerate(zip(fitted.slopes, fitted.offsets))
    ]
    mean = sum(parts[1:], parts[0]) / len(parts)
    return with_margins(df, fitted.models, "_margins").withColumn(name, mean).drop("_margins")


def with_prediction(df: DataFrame, score: str, threshold: float = 0.5) -> DataFrame:
    return df.withColumn("predicted", F.when(F.col(score) >= threshold, 1).otherwise(0))
