"""Feature preparation: country bucketing, label codes, median imputation; fitted once, applied anywhere."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession, functions as F

from bandstand.functions.numbers import cast_numeric
from bandstand.functions.ordering import exact_medians, with_row_number
from bandstand.schemas import MODEL_COLUMNS
from bandstand.settings import CATEGORICAL_FEATURES, DEFAULTS, NUMERIC_FEATURES, Settings

ALL_FEATURES = [*NUMERIC_FEATURES, *CATEGORICAL_FEATURES]
TARGET = "is_breakout"
OTHER = "Other"
UNKNOWN = "unknown"


def load_model_columns(features: DataFrame, labelled_only: bool = True) -> DataFrame:
    """The 13 columns the model reads; numeric text becomes numbers, bad text null."""
    numeric = [c for c in MODEL_COLUMNS if c not in ("artist_name", "subgenre", "country")]
    df = cast_numeric(features.select(*MODEL_COLUMNS), numeric)
    return df.where(F.col(TARGET).isNotNull()) if labelled_only else df


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """The n commonest values, ties by name."""
    return value_counts(df, column).orderBy(F.col("n").desc(), column).limit(n)


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """Codes 0.. by sorted label: ``label, code``."""
    labels = df.select(F.col(column).alias("label")).distinct()
    return with_row_number(labels, [F.col("label")], "place").select("label", (F.col("place") - 1).cast("int").alias("code"))


@dataclass(frozen=True)
class FeatureSpec:
    """What was fitted: ten countries, the codes of their buckets and of the scenes, seven medians."""

    top_countries: list[str]
    country_codes: dict[str, int]
    subgenre_codes: dict[str, int]
    medians: dict[str, float]

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(json.dumps(asdict(self)),)], "spec STRING").coalesce(1).write.mode("overwrite").text(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "FeatureSpec":
        return FeatureSpec(**json.loads(spark.read.text(path).first()["value"]))


def bucket_country(df: DataFrame, top: DataFrame) -> DataFrame:
    """Keep the top countries, everything else and null become ``Other``.

    ``top`` has at most ``top_countries`` rows by construction, so it is broadcast.
    """
    kept = top.select(F.col("country").alias("_top"))
    return (
        df.join(F.broadcast(kept), F.col("country") == F.col("_top"), "left")
        .withColumn("country_bucketed", F.coalesce("_top", F.lit(OTHER)))
        .drop("_top")
    )


def fit_features(train: DataFrame, s: Settings = DEFAULTS) -> FeatureSpec:
    """Fit on the given rows (the training part), which should be a stored table: they are read three times.

    Only the vocabularies and medians reach the driver.
    """
    top = top_values(train, "country", s.top_countries)
    countries = [r["country"] for r in top.collect()]
    labels = sorted({*countries, OTHER})
    scenes = label_codes(train.select(F.coalesce("subgenre", F.lit(UNKNOWN)).alias("subgenre")), "subgenre")
    medians = {r["feature"]: r["median"] for r in exact_medians(train, list(NUMERIC_FEATURES)).collect()}
    return FeatureSpec(
        top_countries=countries,
        country_codes={c: i for i, c in enumerate(labels)},
        subgenre_codes={r["label"]: r["code"] for r in scenes.collect()},
        medians=medians,
    )


def _code(column, codes: dict[str, int]):
    """Code of a label; labels the fit has not seen share one code after the last."""
    if not codes:
        return F.lit(0)
    table = F.create_map(*[F.lit(x) for kv in codes.items() for x in kv])
    return F.coalesce(F.try_element_at(table, column), F.lit(len(codes)))


def apply_features(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Coded and imputed columns beside the raw ones (``subgenre`` stays readable as ``subgenre_name``).

    A column without any median (all null in the fit) is filled with 0.
    """
    bucket = F.when(F.col("country").isin(spec.top_countries), F.col("country")).otherwise(OTHER)
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(spec.medians.get(c, 0.0))) for c in NUMERIC_FEATURES}
    return df.withColumns(
        {
            "subgenre_name": F.col("subgenre"),
            "country_bucketed": F.coalesce(bucket, F.lit(OTHER)),
            **{f"{c}_raw": F.col(c) for c in NUMERIC_FEATURES},
        }
    ).withColumns(
        {
            **filled,
            "country_encoded": _code(F.col("country_bucketed"), spec.country_codes),
            "subgenre": _code(F.coalesce("subgenre_name", F.lit(UNKNOWN)), spec.subgenre_codes),
        }
    )


def to_matrix(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=ALL_FEATURES, outputCol="features").transform(df)


def imputation_report(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Per feature: the median used and how many rows get it."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in NUMERIC_FEATURES])
    rows = [
        F.struct(F.lit(c).alias("feature"), F.lit(spec.medians.get(c)).cast("double").alias("median"), F.col(c).alias("imputed"))
        for c in NUMERIC_FEATURES
    ]
    return counts.select(F.inline(F.array(*rows)))
