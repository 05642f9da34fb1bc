"""Exact stratified splits and folds by hash order, without sorting the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from bandstand.functions.ordering import cuts_ahead, hash_cuts
from bandstand.runtime import cut_lineage
from bandstand.settings import DEFAULTS, Settings


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n"))


def holdout_sizes(df: DataFrame, label: str, share: float) -> DataFrame:
    """Test rows per class: ceil(share * n) in all, by largest remainder (one row per class)."""
    counts = class_counts(df, label)
    everything = W.partitionBy()
    total = F.sum("n").over(everything)
    wanted = F.ceil(F.lit(share) * total)
    exact = counts.withColumn("_q", wanted * F.col("n")).withColumn("_total", total).withColumn("_wanted", wanted)
    floor = exact.withColumn("k", F.expr("_q div _total")).withColumn("_rest", F.expr("_q % _total"))
    order = W.orderBy(F.col("_rest").desc(), label)
    missing = F.col("_wanted") - F.sum("k").over(everything)
    return floor.withColumn("k", F.col("k") + F.when(F.row_number().over(order) <= missing, 1).otherwise(0)).select(
        label, "n", "k"
    )


def stratified_split(df: DataFrame, label: str, key: str, s: Settings = DEFAULTS) -> DataFrame:
    """Add ``is_test``: per class, the rows with the smallest hashes of ``key`` and the seed.

    Only labels and keys are written down to find the cuts; the table itself is then filtered by a row
    per class, without a shuffle.
    """
    keys = cut_lineage(df.select(label, key))
    sizes = holdout_sizes(keys, label, s.test_share).select(label, F.lit(1).alias("cut"), "k").where(F.col("k") > 0)
    cuts = cut_lineage(hash_cuts(keys, label, key, s.seed, sizes))
    marked = cuts_ahead(df, label, key, s.seed, cuts, "_ahead")
    return marked.withColumn("is_test", F.col("_ahead") > 0).drop("_ahead")


def stratified_folds(df: DataFrame, label: str, key: str, folds: int, seed: int | str) -> DataFrame:
    """Add ``fold`` 0..folds-1: each class is cut into equal runs of its hash order."""
    keys = cut_lineage(df.select(label, key))
    inner = F.explode(F.sequence(F.lit(1), F.lit(folds - 1))).alias("cut")
    ranks = class_counts(keys, label).select(label, "n", inner).select(
        label, "cut", F.expr(f"(n * cut) div {folds}").alias("k")
    )
    cuts = cut_lineage(hash_cuts(keys, label, key, seed, ranks.where(F.col("k") > 0)))
    marked = cuts_ahead(df, label, key, seed, cuts, "_ahead")
    return marked.withColumn("fold", folds - 1 - F.col("_ahead")).drop("_ahead")


def positive_weight(df: DataFrame, label: str) -> DataFrame:
    """Class counts and their ratio: the weight of a positive row."""
    y = F.col(label)
    return df.agg(F.count_if(y == 0).alias("n_neg"), F.count_if(y == 1).alias("n_pos")).withColumn(
        "weight", F.when(F.col("n_pos") > 0, F.col("n_neg") / F.col("n_pos"))
    )


def row_weight(label: Column, weight: float) -> Column:
    return F.when(label == 1, F.lit(weight)).otherwise(F.lit(1.0))


def split_rates(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy("is_test").agg(F.count("*").alias("n"), F.avg(F.col(label).cast("double")).alias("positive_rate"))
