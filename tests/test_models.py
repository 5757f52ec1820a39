from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandkit.operators import evaluate, folds, forecast, linear, trees
from demandkit.operators.series import Series

FEATURES = ["year", "a", "b"]
DAY0 = dt.date(2014, 1, 1)


def make_rows(n=120, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        year, a, b = 2014.0 + (i > 60), rng.gauss(0, 3), rng.random() * 100
        rows.append((rng.choice(["s", "t"]), DAY0 + dt.timedelta(days=i), year, a, b, 5 * a - b / 7 + year - 2000 + rng.gauss(0, 1)))
    return rows


@pytest.fixture(scope="module")
def rows():
    return make_rows()


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, ds date, year double, a double, b double, y double")


def closed_form(x, y, alpha, standardise):
    x, y = np.asarray(x, float), np.asarray(y, float)
    center = x.mean(axis=0)
    scale = x.std(axis=0) if standardise else np.ones(x.shape[1])
    scale = np.where(scale > 0, scale, 1)
    z = (x - center) / scale
    w = np.linalg.pinv(z.T @ z + alpha * np.eye(z.shape[1])) @ z.T @ (y - y.mean()) / scale
    return w, y.mean() - w @ center


@pytest.mark.parametrize("alpha,standardise", [(0.0, False), (1.0, False), (3.0, True)])
def test_ridge_closed_form_per_group(frame, rows, alpha, standardise):
    got = {r["k"]: r for r in linear.fit_linear(frame, FEATURES, "y", ["k"], alpha, standardise).collect()}
    for k in ["s", "t"]:
        mine = [r for r in rows if r[0] == k]
        w, b = closed_form([r[2:5] for r in mine], [r[5] for r in mine], alpha, standardise)
        assert np.allclose(got[k]["coef"], w, rtol=1e-7) and got[k]["intercept"] == pytest.approx(b, rel=1e-7)


def test_collinear_and_constant_features(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, 1.0, 3.0 * i + 1) for i in range(10)], "a double, b double, c double, y double")
    model = linear.fit_linear(df, ["a", "b", "c"], "y").first()
    assert np.allclose(model["coef"], [0.6, 1.2, 0.0]) and model["intercept"] == pytest.approx(1.0)


def test_cross_validation_equals_refits(frame, rows):
    got = linear.cross_validate_linear(frame, FEATURES, "y", "ds", alphas=(0.0, 10.0), standardise=True)
    got = {(r["alpha"], r["fold"]): r["rmse"] for r in got.collect()}
    x, y = np.array([r[2:5] for r in rows]), np.array([r[5] for r in rows])
    size = len(rows) // 6
    for fold in range(1, 6):
        start = len(rows) - (6 - fold) * size
        for alpha in (0.0, 10.0):
            w, b = closed_form(x[:start], y[:start], alpha, True)
            error = y[start:start + size] - x[start:start + size] @ w - b
            assert got[(alpha, fold)] == pytest.approx(np.sqrt(np.mean(error**2)), rel=1e-6)


def test_series_that_starts_late_keeps_its_folds(spark):
    """Rows of a fold that nothing came before are counted, without an error."""
    rng = random.Random(5)
    rows = [("a", DAY0 + dt.timedelta(days=i), rng.random(), rng.random()) for i in range(60)]
    rows += [("b", DAY0 + dt.timedelta(days=i), rng.random(), rng.random()) for i in range(31, 60)]
    rows += [(None, DAY0 + dt.timedelta(days=i), rng.random(), rng.random()) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, ds date, x double, y double")
    folds_of_all = linear.cross_validate_linear(df, ["x"], "y", "ds", by=["k"], alphas=(0.0, 1.0))
    got = {(r["k"], r["alpha"], r["fold"]): (r["n"], r["rmse"]) for r in folds_of_all.collect()}
    for alpha in (0.0, 1.0):
        assert [f for k, a, f in sorted(got, key=str) if (k, a) == ("b", alpha)] == [3, 4, 5]
        assert got["b", alpha, 3][0] == 9 and got["b", alpha, 3][1] is None
        assert all(got[k, alpha, f][1] > 0 for k in ("a", None) for f in range(1, 6)) and got["b", alpha, 4][1] > 0
    summary = {(r["k"], r["alpha"]): r for r in evaluate.fold_summary(folds_of_all, ["k", "alpha"]).collect()}
    assert (summary["b", 1.0]["n_folds"], summary["b", 1.0]["n_untrained"]) == (2, 1)
    judged = [got["b", 1.0, f] for f in (4, 5)]
    pooled = np.sqrt(sum(n * r * r for n, r in judged) / sum(n for n, _ in judged))
    assert summary["b", 1.0]["pooled_rmse"] == pytest.approx(pooled)


def test_frozen_lags_look_back_as_far_as_asked(spark):
    history = spark.createDataFrame([("s", DAY0 + dt.timedelta(days=i), float(i)) for i in range(40)], "k string, ds date, y double")
    future = spark.createDataFrame([("s", DAY0 + dt.timedelta(days=40))], "k string, ds date")
    made = forecast.frozen_lags(history, future, Series(("k",)), "y", ["lag_14", "rolling_mean_28"]).first()
    assert (made["lag_14"], made["rolling_mean_28"]) == (26.0, 25.5)


def test_out_of_fold_agrees_with_summed_errors(frame):
    oof = linear.out_of_fold_linear(frame, FEATURES, "y", "ds", alpha=2.0)
    scored = {r["fold"]: r["rmse"] for r in evaluate.rmse(oof, "y", "prediction", ["fold"]).collect()}
    summed = {r["fold"]: r["rmse"] for r in linear.cross_validate_linear(frame, FEATURES, "y", "ds", alphas=(2.0,)).collect()}
    assert scored == pytest.approx(summed)


@pytest.mark.parametrize("seed", [1, 2000])
def test_wide_sums_equal_plain_ones(spark, monkeypatch, seed):
    """One vector of products per row, added up without Python workers, with null keys."""
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, 2, None]), rng.random(), rng.random(), rng.random()) for _ in range(200)]
    df = spark.createDataFrame(rows, "k string, block int, a double, b double, y double").repartition(5)
    for by in [[], ["k"], ["k", "block"]]:
        plain = linear.cross_sums(df, ["a", "b"], "y", by, origin={"a": 0.5})
        monkeypatch.setattr(linear, "WIDE", 0)
        wide = linear.cross_sums(df, ["a", "b"], "y", by, origin={"a": 0.5})
        monkeypatch.setattr(linear, "WIDE", 12)
        assert wide.columns == plain.columns
        assert "Python" not in wide._jdf.queryExecution().toString() and "InPandas" not in wide._jdf.queryExecution().toString()
        shown = lambda frame: sorted(
            [str(v) if not isinstance(v, float) else round(v, 9) for v in r] for r in frame.collect()
        )
        assert shown(wide) == shown(plain)


def test_feature_sets_share_one_pass(frame):
    sets = {"two": ["b", "year"], "all": FEATURES}
    got = {r["model"]: r for r in evaluate.compare_feature_sets(frame, sets, "y", "ds", alpha=1.0).collect()}
    for name, features in sets.items():
        alone = linear.cross_validate_linear(frame, features, "y", "ds", alphas=(1.0,))
        assert got[name]["mean_rmse"] == pytest.approx(evaluate.fold_summary(alone).first()["mean_rmse"])
    assert got["two"]["improvement"] == 0.0 and got["all"]["improvement"] > 0


def test_trees_in_the_jvm_equal_mllib(spark, frame):
    for fit in [
        lambda: trees.fit_forest(frame, FEATURES, "y", numTrees=4, maxDepth=4),
        lambda: trees.fit_boosted(frame, FEATURES, "y", maxIter=5, maxDepth=3),
    ]:
        model = fit()
        scored = trees.score_trees(frame, model, FEATURES)
        ensemble = trees.trees_frame(spark, model)
        walked = scored.withColumn("trees", ensemble.scalar()).withColumn(
            "walked", trees.trees_value(F.col("trees"), linear_features(), 5)
        )
        worst = walked.agg(F.max(F.abs(F.col("walked") - F.col("prediction")))).first()[0]
        assert worst < 1e-9
        table = trees.importance_table(spark, model, FEATURES).collect()
        assert sum(r["gain"] for r in table) == pytest.approx(1.0)
        assert sum(r["splits"] for r in table) == pytest.approx(1.0)


def linear_features():
    return F.array(*[F.col(c) for c in FEATURES])


def test_boosting_stops_early(frame):
    train, test = frame.filter("ds < '2014-03-15'"), frame.filter("ds >= '2014-03-15'")
    stopped = trees.fit_boosted(train, ["a"], "y", validation=test, maxIter=30, validationTol=0.05)
    assert stopped.getNumTrees < 30


def loop_forecast(buffer, futures, features, predict, low=None, high=None):
    out, buffer = [], list(buffer)
    for row in futures:
        mean = lambda v: sum(v) / len(v) if v else 0.0
        made = {
            **row,
            "lag_1": buffer[-1] if buffer else 0.0,
            "lag_5": buffer[-5] if len(buffer) >= 5 else mean(buffer),
            "rolling_mean_5": mean(buffer[-5:]),
            "rolling_std_5": float(np.std(buffer[-5:], ddof=1)) if len(buffer) > 1 else 0.0,
            "lag_diff": buffer[-1] - buffer[-2] if len(buffer) > 1 else 0.0,
        }
        value = predict([made[f] for f in features])
        value = max(value, low) if low is not None else value
        value = min(value, high) if high is not None else value
        out.append(value)
        buffer.append(value)
    return out


@pytest.mark.parametrize("low,high", [(None, None), (0.0, None), (2.0, 4.0)])
def test_recursive_forecast_equals_a_loop(spark, low, high):
    features = ["dow", "lag_1", "lag_5", "rolling_mean_5", "rolling_std_5", "lag_diff"]
    weights = [0.1, 0.7, -0.2, 0.3, 0.25, -0.4]
    rng = random.Random(5)
    history, future, expected = [], [], {}
    for key, n in [("long", 25), ("short", 3), ("one", 1), ("empty", 0)]:
        ys = [rng.uniform(0, 6) for _ in range(n)]
        history += [(key, DAY0 + dt.timedelta(days=i), y) for i, y in enumerate(ys)]
        rows = [{"dow": float((n + j) % 7)} for j in range(15)]
        future += [(key, DAY0 + dt.timedelta(days=n + j), r["dow"]) for j, r in enumerate(rows)]
        predict = lambda xs: 0.3 + sum(w * x for w, x in zip(weights, xs))
        expected[key] = loop_forecast(ys[-10:], rows, features, predict, low, high)
    got = forecast.recursive_forecast(
        spark.createDataFrame(history, "k string, ds date, y double"),
        spark.createDataFrame(future, "k string, ds date, dow double"),
        Series(("k",)), "y", features,
        lambda xs: F.lit(0.3) + sum((F.lit(w) * x for w, x in zip(weights, xs)), F.lit(0.0)),
        low=low, high=high,
    )
    found = {}
    for r in got.orderBy("k", "ds").collect():
        found.setdefault(r["k"], []).append(r["prediction"])
    for key in expected:
        assert np.allclose(found[key], expected[key])


def test_training_and_walking_define_features_alike(spark):
    ys = [float((i * 5) % 13) for i in range(30)]
    df = spark.createDataFrame([("s", DAY0 + dt.timedelta(days=i), y) for i, y in enumerate(ys)], "k string, ds date, y double")
    from demandkit.operators.series import add_series_features

    names = ["lag_1", "lag_5", "rolling_mean_10", "rolling_std_5", "lag_diff"]
    trained = add_series_features(df, Series(("k",)), "y", names).orderBy(F.col("ds").desc()).first()
    buffer = F.array(*[F.lit(y) for y in ys[:-1][-10:]])
    walked = spark.range(1).select(*[forecast.buffer_feature(n, buffer).alias(n) for n in names]).first()
    assert [trained[n] for n in names] == pytest.approx([walked[n] for n in names])


def test_search_and_candidates(spark, frame):
    space = {"n": ("int", 1, 3), "f": ("float", 0.0, 1.0), "l": ("log", 1e-3, 1e3), "c": ("choice", ["x"])}
    first, again = evaluate.random_candidates(space, 5, 1), evaluate.random_candidates(space, 5, 1)
    assert first == again and all(1 <= c["n"] <= 3 and 1e-3 <= c["l"] <= 1e3 for c in first)

    def make_fit(params):
        def fit(train, validation):
            model = linear.fit_linear(train, FEATURES, "y", alpha=params["alpha"])
            return lambda rows: linear.score(rows, model, FEATURES)

        return fit

    candidates = [{"alpha": 1e6}, {"alpha": 0.1}]
    found = evaluate.search(spark, frame, make_fit, candidates, "y", "ds", n_splits=2)
    assert evaluate.best_params(found, candidates) == {"alpha": 0.1}
    got = found.collect()
    assert got[0]["trial"] == 1 and got[0]["mean_rmse"] < got[1]["mean_rmse"]


def test_fold_trains_precede_validation(frame):
    for _, train, validation in folds.folds_of(folds.time_folds(frame, "ds", 3), 3):
        assert train.agg(F.max("ds")).first()[0] < validation.agg(F.min("ds")).first()[0]
