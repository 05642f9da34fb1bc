import hashlib
import random
import statistics

from pyspark.sql import functions as F

from bandstand.functions import ordering
from bandstand.ml import split
from bandstand.settings import Settings


def test_row_numbers_and_totals_over_many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        n = 5_000
        values = [(i, random.Random(i).randrange(20)) for i in range(n)]  # few distinct values: many ties
        df = spark.createDataFrame(values, "id INT, v INT").repartition(7)
        got = ordering.with_row_number(df, [F.col("v").desc(), F.col("id")], "rank").collect()
        expected = {i: place for place, (i, _) in enumerate(sorted(values, key=lambda t: (-t[1], t[0])), 1)}
        assert {r["id"]: r["rank"] for r in got} == expected
        totals = ordering.with_running_totals(df, [F.col("v"), F.col("id")], {"upto": F.col("v"), "n": F.lit(1)}).collect()
        running, seen = {}, 0
        for i, v in sorted(values, key=lambda t: (t[1], t[0])):
            seen += v
            running[i] = seen
        assert {r["id"]: r["upto"] for r in totals} == running
        assert max(r["n"] for r in totals) == n
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_medians_are_exact_and_interpolated(spark):
    rng = random.Random(7)
    data = [(rng.choice([None, rng.randrange(50)]), float(rng.randrange(1000)) / 10, None) for _ in range(999)]
    df = spark.createDataFrame(data, "a INT, b DOUBLE, c DOUBLE")
    got = {r["feature"]: (r["n"], r["median"]) for r in ordering.exact_medians(df, ["a", "b", "c"]).collect()}
    a, b = [x[0] for x in data if x[0] is not None], [x[1] for x in data]
    assert got == {"a": (len(a), statistics.median(a)), "b": (len(b), statistics.median(b))}
    even = spark.createDataFrame([(1.0,), (2.0,), (10.0,), (20.0,)], "a DOUBLE")
    assert ordering.exact_medians(even, ["a"]).first()["median"] == 6.0


def digest(key, seed):
    return hashlib.md5(f"{key}:{seed}".encode()).hexdigest()


def test_split_is_exact_per_label(spark):
    rows = [(f"k{i}", int(i % 7 == 0)) for i in range(1_003)]
    df = spark.createDataFrame(rows, "key STRING, y INT")
    got = {r["key"]: r["is_test"] for r in split.stratified_split(df, "y", "key", Settings()).collect()}
    assert len(got) == len(rows)
    sizes = {y: sum(got[k] for k, label in rows if label == y) for y in (0, 1)}
    # ceil(0.2 * 1003) = 201; 144 of 1003 are positive: 28.86 and 172.14 before rounding.
    assert sizes == {0: 172, 1: 29}
    for y, k in sizes.items():
        keys = sorted((digest(key, 42), key) for key, label in rows if label == y)
        assert {key for _, key in keys[:k]} == {key for key, label in rows if label == y and got[key]}


def test_split_of_tiny_classes(spark):
    df = spark.createDataFrame([("a", 1), ("b", 0), ("c", 0), ("d", 0)], "key STRING, y INT")
    got = split.stratified_split(df, "y", "key", Settings()).collect()
    assert sum(r["is_test"] for r in got) == 1 and not any(r["is_test"] for r in got if r["y"] == 1)


def test_folds_partition_each_class_evenly(spark):
    rows = [(f"k{i}", int(i < 23)) for i in range(203)]
    df = spark.createDataFrame(rows, "key STRING, y INT")
    got = split.stratified_folds(df, "y", "key", 5, "s").groupBy("y", "fold").count().collect()
    counts = {(r["y"], r["fold"]): r["count"] for r in got}
    assert {f for _, f in counts} == set(range(5))
    for y, total in ((1, 23), (0, 180)):
        parts = [counts[(y, f)] for f in range(5)]
        assert sum(parts) == total and max(parts) - min(parts) <= 1
    small = split.stratified_folds(df.where("key in ('k0', 'k1', 'k50')"), "y", "key", 5, "s").collect()
    assert len(small) == 3 and all(0 <= r["fold"] < 5 for r in small)


def test_percentiles_are_exact_per_group(spark):
    rng = random.Random(5)
    data = [(f"g{rng.randrange(4)}", int(rng.lognormvariate(10, 3)) - 50) for _ in range(4_000)] + [("one", 7), ("none", None)]
    data += [("hot", 1_000_000)] * 3_000
    df = spark.createDataFrame(data, "g STRING, v BIGINT")
    shares = {"low": 0.1, "half": 0.5, "high": 0.9, "top": 1.0}
    got = {r["g"]: [r[n] for n in shares] for r in ordering.exact_percentiles(df, "g", "v", shares).collect()}
    groups = {}
    for g, v in data:
        if v is not None:
            groups.setdefault(g, []).append(v)
    for g, values in groups.items():
        values.sort()
        n = len(values)
        ranks = [max(1, -(-n * tenth // 10)) for tenth in (1, 5, 9, 10)]
        assert got[g] == [values[k - 1] for k in ranks]
    assert "none" not in got


def test_percentiles_of_narrow_ranges(spark):
    """Values close to each other, and large ones, are as good as any."""
    for low, step in ((0.0, 1e-10), (1.9e9, 1.0)):
        rows = spark.range(20_001).selectExpr("cast(id % 2 as string) AS g", f"{low} + id * {step} AS v")
        got = {r["g"]: r["mid"] for r in ordering.exact_percentiles(rows, "g", "v", {"mid": 0.5}).collect()}
        assert got == {"0": low + 10_000 * step, "1": low + 9_999 * step}
