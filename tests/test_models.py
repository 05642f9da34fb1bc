import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from bandstand.checks import model_checks
from bandstand.functions.ranking import arg_max_abs
from bandstand.ml import boosting, explain, metrics, predict, prep
from bandstand.settings import NUMERIC_FEATURES, Settings


def labelled(spark, n=400, ties=True):
    rng = random.Random(3)
    rows = []
    for i in range(n):
        y = int(rng.random() < 0.2)
        s = min(0.99, max(0.0, rng.gauss(0.6 if y else 0.35, 0.2)))
        rows.append((i, y, round(s, 1) if ties else s))
    return rows, spark.createDataFrame(rows, "i INT, y INT, s DOUBLE")


def auc(rows):
    pos, neg = [s for _, y, s in rows if y], [s for _, y, s in rows if not y]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


def average_precision(rows):
    total = sum(y for _, y, _ in rows)
    out, last = 0.0, 0.0
    for t in sorted({s for *_, s in rows}, reverse=True):
        tp = sum(y for _, y, s in rows if s >= t)
        n = sum(1 for *_, s in rows if s >= t)
        out += (tp / total - last) * tp / n
        last = tp / total
    return out


@pytest.mark.parametrize("ties", [True, False])
def test_ranking_metrics(spark, ties):
    rows, df = labelled(spark, ties=ties)
    got = metrics.ranking_metrics(df, "y", "s").first()
    assert got["roc_auc"] == pytest.approx(auc(rows)) and got["avg_precision"] == pytest.approx(average_precision(rows))
    same = metrics.ranking_metrics(df.withColumn("s", F.exp(F.col("s") * 3) - 9), "y", "s").first()
    assert same["roc_auc"] == got["roc_auc"]  # unchanged by a monotone transform


def test_metrics_of_one_class(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.7)], "y INT, s DOUBLE")
    got = metrics.ranking_metrics(df, "y", "s").first()
    assert got["roc_auc"] is None and got["avg_precision"] == 1.0
    report = metrics.classification_report(boosting.with_prediction(df, "s"), "y", "predicted", {0: "no", 1: "yes"})
    lines = {r["class"]: tuple(r)[1:] for r in report.collect()}
    assert lines["no"] == (0.0, 0.0, 0.0, 0)
    assert lines["yes"] == (1.0, 0.5, pytest.approx(2 / 3), 2)
    assert lines["accuracy"][0] == 0.5 and lines["weighted avg"][1] == 0.5


def test_brier(spark):
    df = spark.createDataFrame([(1, 0.8), (0, 0.4)], "y INT, s DOUBLE")
    assert metrics.brier_score(df, "y", "s").first()[0] == pytest.approx((0.04 + 0.16) / 2)


def mart_rows(spark, n=300):
    rng = random.Random(11)
    rows = []
    for i in range(n):
        country = None if i % 13 == 0 else f"C{min(i % 14, 11):02d}"
        y = int(rng.random() < 0.25)
        rows.append(
            (
                f"band {i}", f"scene {i % 3}" if i % 17 else None, country, 1990, rng.choice([None, rng.randrange(60)]),
                rng.randrange(9), rng.randrange(5), rng.choice([None, rng.random()]), rng.randrange(20),
                rng.gauss(30 + 20 * y, 6), None, 1000 * (i + 1), y,
            )
        )
    types = dict(zip(("artist_name", "subgenre", "country"), ("STRING",) * 3))
    from bandstand.schemas import MODEL_COLUMNS

    ddl = ", ".join(f"{c} {types.get(c, 'DOUBLE')}" for c in MODEL_COLUMNS)
    return spark.createDataFrame([(*r[:3], *[None if v is None else float(v) for v in r[3:]]) for r in rows], ddl)


def test_features_are_fitted_once_and_reused(spark):
    df = mart_rows(spark)
    spec = prep.fit_features(df)
    assert len(spec.top_countries) == 10 and "Other" in spec.country_codes
    assert list(spec.country_codes.values()) == list(range(11))
    assert "mb_resolution_score" not in spec.medians  # all null
    unseen = df.limit(1).withColumns({"subgenre": F.lit("new scene"), "country": F.lit("Atlantis")})
    row = prep.apply_features(unseen, spec).first()
    assert row["subgenre"] == len(spec.subgenre_codes) and row["country_bucketed"] == "Other"
    assert row["mb_resolution_score"] == 0.0
    prepared = prep.apply_features(df, spec)
    assert prepared.where(" or ".join(f"{c} is null" for c in prep.ALL_FEATURES)).count() == 0


@pytest.fixture(scope="module")
def run(spark):
    return predict.train_run(mart_rows(spark), boosting.BoostParams(rounds=4), Settings())


def test_calibrated_run(spark, run, tmp_path):
    test = run.test.collect()
    assert len(test) == 60 and all(0 < r["breakout_probability"] < 1 for r in test)
    got = run.test_metrics.first()
    assert got["roc_auc"] > 0.8 and 0 <= got["brier_score"] <= 0.25
    run.fitted.save(spark, str(tmp_path / "model"))
    loaded = boosting.Calibrated.load(spark, str(tmp_path / "model"))
    again = {r["artist_name"]: r["p"] for r in boosting.calibrated_probability(run.test.drop("predicted"), loaded, "p").collect()}
    assert all(again[r["artist_name"]] == pytest.approx(r["breakout_probability"]) for r in test)


def test_saved_run_is_the_run(spark, run, tmp_path):
    run.save(spark, str(tmp_path / "run"))
    again = predict.TrainedRun.load(spark, str(tmp_path / "run"))
    assert again.params == run.params and again.spec == run.spec
    one, two = run.record().first(), again.record().first()
    assert one == two and (one["n_train"], one["n_test"]) == (run.train.count(), 60) and "country_encoded" in one["features"]


def test_attributions_add_up_to_the_margin(spark, run):
    explained = explain.attribute(boosting.with_margins(run.train, [run.model], "m"), run.model, prep.ALL_FEATURES)
    total = F.aggregate("contributions", F.col("base_value"), lambda a, x: a + x)
    worst = explained.agg(F.max(F.abs(total - F.col("m")[0]))).first()[0]
    assert worst < 1e-6


def expected_margin(nodes, x, known):
    """Path-dependent expectation of one tree when only ``known`` features are given."""

    def walk(at):
        left, right, feature, threshold, value, count = nodes[at]
        if left < 0:
            return value
        if feature in known:
            return walk(left if x[feature] <= threshold else right)
        return (nodes[left][5] * walk(left) + nodes[right][5] * walk(right)) / count

    return walk(0)


def test_attributions_equal_the_shapley_definition(spark, run):
    model, nodes = run.model, {}
    for t in range(len(model.feature)):
        for n in range(model.feature.shape[1]):
            f = model.feature[t, n]
            children = (2 * n + 1, 2 * n + 2) if f >= 0 else (-1, -1)
            nodes.setdefault(t, {})[n] = (*children, f, model.threshold[t, n], model.value[t, n], model.cover[t, n])
    rows = explain.attribute(run.train.orderBy("artist_name").limit(3), run.model, prep.ALL_FEATURES).collect()
    m = len(prep.ALL_FEATURES)
    for r in rows:
        x = [float(r[f]) for f in prep.ALL_FEATURES]
        worth = {
            known: sum(expected_margin(nodes[t], x, known) for t in nodes)
            for size in range(m + 1)
            for known in itertools.combinations(range(m), size)
        }
        for j in range(m):
            phi = sum(
                math.factorial(len(k)) * math.factorial(m - len(k) - 1) / math.factorial(m)
                * (worth[tuple(sorted((*k, j)))] - worth[k])
                for k in worth if j not in k
            )
            assert r["contributions"][j] == pytest.approx(phi, abs=1e-9)


def test_platt_sigmoid_is_the_weighted_fit(spark):
    rows, df = labelled(spark, ties=False)
    slope, offset = boosting.fit_sigmoid(df, "y", "s")
    n_pos = sum(y for _, y, _ in rows)
    high, low = (n_pos + 1) / (n_pos + 2), 1 / (len(rows) - n_pos + 2)
    s = np.array([r[2] for r in rows])
    t = np.array([high if r[1] else low for r in rows])
    p = 1 / (1 + np.exp(-(slope * s + offset)))
    # At the optimum the gradient of the cross entropy vanishes.
    assert abs(np.mean(p - t)) < 1e-5 and abs(np.mean((p - t) * s)) < 1e-5


def test_prediction_table(spark, run):
    table = predict.prediction_table(mart_rows(spark), run.spec, run.fitted).collect()
    assert len(table) == 300
    assert {r["top_breakout_factor"] for r in table} <= set(prep.ALL_FEATURES)
    ranked = predict.underground_ranking(predict.prediction_table(mart_rows(spark), run.spec, run.fitted)).orderBy("rank").collect()
    assert [r["rank"] for r in ranked] == list(range(1, len(ranked) + 1))
    probabilities = [r["breakout_probability"] for r in ranked]
    assert probabilities == sorted(probabilities, reverse=True)


def test_first_of_equal_factors_wins(spark):
    df = spark.createDataFrame([([1.0, -3.0, 3.0],)], "v ARRAY<DOUBLE>")
    assert df.select(arg_max_abs(F.col("v"))).first()[0] == 2


def test_feature_order_is_fixed():
    assert prep.ALL_FEATURES == [*NUMERIC_FEATURES, "subgenre", "country_encoded"]


def test_registered_queries_train_all_rounds():
    assert model_checks.PARAMS == boosting.BoostParams() and model_checks.PARAMS.rounds == 300


def test_feature_matrix_query_reads_the_matrix(spark, monkeypatch):
    df = mart_rows(spark, 40)
    monkeypatch.setattr(model_checks.shapes, "stored_features", lambda spark, d: df)
    got = {r["artist_name"]: r for r in model_checks.p8(spark, "").collect()}
    for r in prep.apply_features(df, prep.fit_features(df, model_checks.S)).collect():
        numeric = sum(float(r[c]) for c in NUMERIC_FEATURES)
        assert got[r["artist_name"]]["numeric_sum"] == pytest.approx(numeric, abs=1e-5)
        assert (got[r["artist_name"]]["width"], got[r["artist_name"]]["subgenre_code"]) == (9, float(r["subgenre"]))


def plain_margins(model, x):
    out = []
    for row in x:
        total = 0.0
        for t in range(len(model.feature)):
            at = 0
            while model.feature[t, at] >= 0:
                at = 2 * at + 1 + int(row[model.feature[t, at]] > model.threshold[t, at])
            total += model.value[t, at]
        out.append(total)
    return out


def test_margins_and_attributions_of_early_leaves(spark):
    nan = float("nan")
    grid = lambda rows, kind=float: np.array(rows, dtype=kind)
    model = boosting.BoostedTrees(
        grid([[0, -1, 1, -1, -1, -1, -1], [-1] * 7, [1, 0, 0, -1, -1, -1, -1]], int),
        grid([[0.5, nan, 2.0, nan, nan, nan, nan], [nan] * 7, [1.0, 0.2, 0.7, nan, nan, nan, nan]]),
        grid([[0, 1.5, 0, 9, 9, -2, 4], [0.25, 7, 7, 7, 7, 7, 7], [0, 0, 0, 1, 2, 3, 5]]),
        grid([[10, 4, 6, 0, 0, 3, 3], [10, 0, 0, 0, 0, 0, 0], [10, 5, 5, 2, 3, 1, 4]]),
    )
    x = [[a, b] for a in (0.0, 0.5, 0.6, 1.0) for b in (0.0, 1.0, 2.0, 3.0)]
    want = plain_margins(model, x)
    assert model.margins(np.array(x)) == pytest.approx(want)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(x)], "i INT, a DOUBLE, b DOUBLE")
    got = explain.mean_attribution(df, [model, model], ["a", "b"]).orderBy("i").collect()
    assert [sum(r["contributions"]) + r["base_value"] for r in got] == pytest.approx(want)


def test_all_cores_take_part_and_tasks_are_bounded():
    from bandstand.ml import trees

    assert [trees.tasks_for(n, 12) for n in (1, 5_000, 45_000, 450_000, 2_700_000, 60_000_000)] == [1, 1, 9, 12, 12, 240]


def test_a_loaded_run_reads_its_scores(spark, run, tmp_path):
    run.save(spark, str(tmp_path / "run"))
    again = predict.TrainedRun.load(spark, str(tmp_path / "run"))
    plan = again.test._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and again.test.columns == run.test.columns


def test_a_level_sums_the_rows_of_lighter_children_only_and_loses_nothing(monkeypatch):
    """The other children have what is left of their parents, to the last bit, and barred features are not summed."""
    from bandstand.ml import trees

    rng = np.random.default_rng(3)
    n, width, models = 4000, 3, 2
    run = trees._Run(trees.BoostParams(depth=3, bins=16), [np.arange(15.0)] * width, np.array([-1, 0]), np.array([2.0, 3.0]), trees._unit(n, np.array([2.0, 3.0])))
    bins, positive = rng.integers(0, 16, (width, n)).astype(np.uint8), rng.integers(0, 2, n).astype(np.uint8)
    block = trees._Block(bins, positive, rng.integers(0, 2, n), rng.integers(0, 2**62, n), rng.normal(size=(models, n)))
    block = trees._next_round(run, None, 0, block)
    barred = np.array([[False, False, True], [True, False, False]])
    grown, above, read = trees._Round.start(run), None, []
    real = np.bincount
    monkeypatch.setattr(np, "bincount", lambda x, *a: read.append(len(x)) or real(x, *a))
    for level in range(3):
        lighter = trees._lighter(grown, level)
        read.clear()
        own = next(trees._sum_level(run, grown, level, lighter, barred, [block]))
        touched = sum(read)
        above = own if above is None else trees._with_rest(own, above, grown, level, lighter)
        every = np.ones_like(lighter)
        read.clear()
        assert (above == next(trees._sum_level(run, grown, level, every, barred, [block]))).all()
        assert touched <= sum(read) * (0.6 if level else 1)
        assert not above[:, barred.nonzero()[0], :, barred.nonzero()[1]].any()
        assert trees._split_level(grown, above * run.unit, barred, level, 0.1)
