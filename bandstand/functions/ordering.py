"""Whole-table order statistics that never put the table into one task.

Ranks and running totals: a window without ``partitionBy`` sends every row to a single task. Here the rows
are range-sorted into many partitions, that order is written down once (a reliable checkpoint, so it
cannot change under a retry), and each partition gets an offset from the totals of the partitions before
it. The only thing that is ever gathered is one row per partition.

Percentiles and medians take single ranks out of such running totals over the different values. Exact hash
splits count hash prefixes and look at single rows in the one bucket that holds the rank.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from bandstand.runtime import cut_lineage

_IN_PARTITION = (1 << 33) - 1
HASH_PREFIX = 4  # hex digits: 65,536 hash buckets


def _sorted(df: DataFrame, order: list[Column]) -> DataFrame:
    fixed = cut_lineage(df.orderBy(*order))
    return fixed.withColumns(
        {
            "_part": F.spark_partition_id(),
            "_pos": F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION)),
        }
    )


def _before(parts: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Totals of all earlier partitions; one row per partition, so one task and a broadcast are safe."""
    totals = parts.groupBy("_part").agg(*[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()])
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    return totals.select(
        "_part", *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_b_{n}") for n in sums]
    )


def with_row_number(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """1-based position in the whole-table order."""
    rows = _sorted(df, order)
    before = _before(rows, {"n": F.lit(1)})
    return (
        rows.join(F.broadcast(before), "_part")
        .withColumn(name, F.col("_b_n") + F.col("_pos") + 1)
        .drop("_part", "_pos", "_b_n")
    )


def with_running_totals(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """Inclusive running totals over the whole-table order, one column per entry of ``sums``."""
    rows = _sorted(df, order).withColumns({f"_v_{n}": c for n, c in sums.items()})
    before = _before(rows, {n: F.col(f"_v_{n}") for n in sums})
    upto = W.partitionBy("_part").orderBy("_pos").rowsBetween(W.unboundedPreceding, 0)
    local = rows.withColumns({f"_l_{n}": F.sum(f"_v_{n}").over(upto) for n in sums})
    return (
        local.join(F.broadcast(before), "_part")
        .withColumns({n: F.col(f"_b_{n}") + F.col(f"_l_{n}") for n in sums})
        .drop("_part", "_pos", *[f"_{k}_{n}" for k in "vlb" for n in sums])
    )


def _at_ranks(rows: DataFrame, group: str, ranks: dict[str, str]) -> DataFrame:
    """Per group, its size ``n`` and the values at the given ranks (SQL expressions of ``n``).

    ``rows`` has ``group`` and ``value``. Equal values are counted first, so a frequent one is one row; the
    different values are then range-sorted over many partitions with running totals, whatever their range,
    and each rank lies in exactly one of them.
    """
    counts = rows.groupBy(group, "value").agg(F.count("*").alias("_c"))
    seen = with_running_totals(counts, [F.col(group), F.col("value")], {"upto": F.col("_c")})
    whole = seen.groupBy(F.col(group).alias("_group")).agg(F.sum("_c").alias("n"), F.min(F.col("upto") - F.col("_c")).alias("_start"))
    wanted = F.array(*[F.struct(F.lit(name).alias("_name"), F.expr(rank).alias("_rank")) for name, rank in ranks.items()])
    upto = F.col("upto") - F.col("_start")
    hit = (
        seen.join(whole, F.col(group).eqNullSafe(F.col("_group")))
        .select(group, "n", "value", upto.alias("_upto"), "_c", F.inline(wanted))
        .where((F.col("_rank") <= F.col("_upto")) & (F.col("_rank") > F.col("_upto") - F.col("_c")))
    )
    return hit.groupBy(group, "n").agg(*[F.min(F.when(F.col("_name") == name, F.col("value"))).alias(name) for name in ranks])


def exact_percentiles(df: DataFrame, group: str, column: str, shares: dict[str, float]) -> DataFrame:
    """Discrete percentiles per group, exact at any size: ``group`` and one column per entry of ``shares``.

    ``group`` should be a partition column: it has no more values than the table has folders.
    """
    ranks = {}
    for name, share in shares.items():
        part = Fraction(str(share))  # whole-number arithmetic: ceil(share * n)
        ranks[name] = f"greatest(1, (n * {part.numerator} + {part.denominator - 1}) div {part.denominator})"
    rows = df.where(F.col(column).isNotNull()).select(group, F.col(column).alias("value"))
    return _at_ranks(rows, group, ranks).drop("n")


def exact_medians(df: DataFrame, cols: list[str]) -> DataFrame:
    """Interpolated median of each column: ``feature, n, median``. A column without values has no row."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols])
    rows = df.select(F.inline(pairs)).where(F.col("value").isNotNull() & ~F.isnan("value"))
    middle = _at_ranks(rows, "feature", {"_low": "(n + 1) div 2", "_high": "n div 2 + 1"})
    return middle.select("feature", "n", ((F.col("_low") + F.col("_high")) / 2).alias("median"))


def hash_of(key: Column, seed: int | str) -> Column:
    return F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))


def hash_cuts(df: DataFrame, stratum: str, key: str, seed: int | str, wanted: DataFrame) -> DataFrame:
    """For each ``(stratum, cut, k)`` of ``wanted``: the k-th smallest ``(hash, key)`` of the stratum.

    Hash prefixes are counted first; only the rows of the one bucket that holds the k-th hash are
    ordered, about a 65,536th of a stratum. ``wanted`` has a row per class and cut, so it is broadcast.
    """
    rows = df.select(stratum, key, hash_of(F.col(key), seed).alias("_h")).withColumn(
        "_bucket", F.substring("_h", 1, HASH_PREFIX)
    )
    counts = rows.groupBy(stratum, "_bucket").agg(F.count("*").alias("_n"))
    upto = W.partitionBy(stratum).orderBy("_bucket").rowsBetween(W.unboundedPreceding, 0)
    edges = counts.withColumn("_upto", F.sum("_n").over(upto))
    place = (
        edges.join(F.broadcast(wanted), stratum)
        .where((F.col("k") > F.col("_upto") - F.col("_n")) & (F.col("k") <= F.col("_upto")))
        .select(stratum, "cut", "_bucket", (F.col("k") - (F.col("_upto") - F.col("_n"))).alias("_left"))
    )
    in_bucket = W.partitionBy(stratum, "cut").orderBy("_h", key)
    return (
        rows.join(F.broadcast(place), [stratum, "_bucket"])
        .withColumn("_rn", F.row_number().over(in_bucket))
        .where(F.col("_rn") == F.col("_left"))
        .select(stratum, "cut", F.col("_h").alias("cut_hash"), F.col(key).alias("cut_key"))
    )


def cuts_ahead(df: DataFrame, stratum: str, key: str, seed: int | str, cuts: DataFrame, name: str) -> DataFrame:
    """``name`` = how many cuts of its stratum the row does not lie behind (a row on a cut is not behind it)."""
    per_stratum = cuts.groupBy(stratum).agg(
        F.collect_list(F.struct(F.col("cut_hash").alias("h"), F.col("cut_key").alias("k"))).alias("_cuts")
    )
    here = F.struct(hash_of(F.col(key), seed).alias("h"), F.col(key).alias("k"))
    ahead = F.when(F.col("_cuts").isNull(), 0).otherwise(F.size(F.filter("_cuts", lambda c: c >= here)))
    return df.join(F.broadcast(per_stratum), stratum, "left").withColumn(name, ahead).drop("_cuts")
