"""Exact ranking, calibration and classification metrics as DataFrames.

Ranking metrics count rows per distinct score first; the running totals are taken over the distinct
scores by partitions, so no metric needs a single-task sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from bandstand.functions.ordering import with_running_totals


def score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    y = F.col(label)
    return df.groupBy(F.col(score).alias("score")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")
    )


def ranking_metrics(df: DataFrame, label: str, score: str) -> DataFrame:
    """ROC-AUC (ties share their mean rank) and average precision (step sum), in one ordered pass."""
    counts = score_counts(df, label, score)
    seen = with_running_totals(
        counts, [F.col("score").desc()], {"tp": F.col("pos"), "fp": F.col("neg")}
    )
    terms = seen.agg(
        F.sum("pos").alias("n_pos"),
        F.sum("neg").alias("n_neg"),
        # Pairs with the positive above the negative, counted twice so that ties stay whole numbers.
        F.sum(F.col("neg").cast("decimal(38,0)") * (2 * F.col("tp") - F.col("pos"))).alias("_pairs2"),
        F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))).alias("_prec"),
    )
    pairs = F.col("n_pos").cast("double") * F.col("n_neg")
    return terms.select(
        "n_pos",
        "n_neg",
        F.when(pairs > 0, F.col("_pairs2").cast("double") / (2 * pairs)).alias("roc_auc"),
        F.when(F.col("n_pos") > 0, F.col("_prec") / F.col("n_pos")).alias("avg_precision"),
    )


def brier_score(df: DataFrame, label: str, score: str, name: str = "brier_score") -> DataFrame:
    return df.agg(F.avg(F.pow(F.col(score) - F.col(label), F.lit(2.0))).alias(name))


def classification_report(df: DataFrame, label: str, predicted: str, names: dict[int, str]) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, macro and weighted averages.

    One pass gives the four confusion counts; a ratio without a base is 0.
    """
    y, p = F.col(label), F.col(predicted)
    cells = df.agg(
        *[F.count_if((y == a) & (p == b)).alias(f"c{a}{b}") for a in (0, 1) for b in (0, 1)]
    )

    def ratio(top, base):
        return F.when(base > 0, top / F.nullif(base, F.lit(0))).otherwise(F.lit(0.0))

    lines = []
    for c in (0, 1):
        hit = F.col(f"c{c}{c}")
        predicted_c, support = F.col(f"c0{c}") + F.col(f"c1{c}"), F.col(f"c{c}0") + F.col(f"c{c}1")
        lines.append(
            F.struct(
                F.lit(names[c]).alias("class"),
                ratio(hit, predicted_c).alias("precision"),
                ratio(hit, support).alias("recall"),
                ratio(2 * hit, predicted_c + support).alias("f1"),
                support.alias("support"),
            )
        )
    wide = cells.select("*", F.array(*lines).alias("per_class"))
    total = F.col("c00") + F.col("c01") + F.col("c10") + F.col("c11")
    accuracy = ratio(F.col("c00") + F.col("c11"), total)

    def mean(field, weighted):
        a, b = F.col("per_class")[0], F.col("per_class")[1]
        if weighted:
            return ratio(a[field] * a["support"] + b[field] * b["support"], total)
        return (a[field] + b[field]) / 2

    def line(name, p_, r_, f_):
        return F.struct(
            F.lit(name).alias("class"), p_.alias("precision"), r_.alias("recall"), f_.alias("f1"), total.alias("support")
        )

    extra = F.array(
        line("accuracy", accuracy, accuracy, accuracy),
        *[
            line(f"{n} avg", *[mean(f, n == "weighted") for f in ("precision", "recall", "f1")])
            for n in ("macro", "weighted")
        ],
    )
    return wide.select(F.inline(F.concat("per_class", extra)))
