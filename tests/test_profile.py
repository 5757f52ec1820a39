from __future__ import annotations

import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from demandkit.operators import choose, groups, impute, joins, profile, quantiles, reshape
from demandkit.operators.quantiles import exact_quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]


@pytest.mark.parametrize("seed,limit,ranked", [(1, 1 << 20, 1 << 20), (2, -1, 1 << 20), (3, 1 << 20, 3), (4, -1, 3)])
def test_quantiles_match_numpy(spark, monkeypatch, seed, limit, ranked):
    """With targets that are broadcast or too many for it, with buckets ranked at once or cut into cells."""
    monkeypatch.setattr(quantiles, "BROADCAST_ROWS", limit)
    monkeypatch.setattr(quantiles, "RANKED_ROWS", ranked)
    rng = random.Random(seed)
    rows = [
        (rng.choice(["a", "b", None]), rng.choice([rng.gauss(0, 1e3), rng.gauss(0, 1e-3), 0.0, 7.0]))
        for _ in range(400)
    ]
    df = spark.createDataFrame(rows, "k string, x double")
    for method in ["linear", "nearest"]:
        got = {r["k"]: r["q"] for r in exact_quantiles(df, ["x"], PROBS, ["k"], method).collect()}
        for k in ["a", "b", None]:
            mine = np.sort([x for g, x in rows if g == k])
            if method == "linear":
                expected = np.quantile(mine, PROBS)
            else:
                expected = [mine[math.floor(p * (len(mine) - 1) + 0.5)] for p in PROBS]
            assert np.allclose(got[k], expected, rtol=1e-12, atol=1e-15)
    whole = exact_quantiles(df, ["x"], PROBS).first()
    assert whole["n"] == 400
    assert np.allclose(whole["q"], np.quantile([x for _, x in rows], PROBS))


def test_quantiles_of_a_narrow_band_rank_few_rows(spark, monkeypatch):
    """A day of epoch seconds: one value bucket holds them all until it is cut."""
    monkeypatch.setattr(quantiles, "RANKED_ROWS", 500)
    handed = []
    ranked = quantiles._ranked_slice
    monkeypatch.setattr(quantiles, "_ranked_slice", lambda rows, part, *a: handed.append((rows, part)) or ranked(rows, part, *a))
    df = spark.range(60_000).select((F.lit(1.7e9) + F.pmod(F.xxhash64("id"), F.lit(86_400))).alias("x"))
    got = exact_quantiles(df, ["x"], [0.25, 0.5]).first()["q"]
    assert got == np.quantile([r["x"] for r in df.collect()], [0.25, 0.5]).tolist()
    rows, part = handed[-1]  # the distinct values that are ranked at the end
    assert rows.groupBy(*part).count().agg(F.max("count")).first()[0] <= 500


def test_small_shares_of_a_hash_sample(spark):
    keys = spark.range(400_000).select((F.pmod(F.xxhash64("id"), F.lit(1 << 40))).alias("k"))
    share = keys.where(profile.hash_percent(F.col("k")) < 0.01).count()
    assert 15 <= share <= 75
    assert keys.where(profile.hash_percent(F.col("k")) < 0.001).count() <= 15


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=32), min_size=1, max_size=30))
def test_median_property(spark, numbers):
    df = spark.createDataFrame([(float(x),) for x in numbers], "x double")
    got = exact_quantiles(df, ["x"], [0.5]).first()["q"][0]
    assert got == pytest.approx(float(np.median(np.array(numbers, dtype=float))), rel=1e-9)


def test_quantiles_skip_null_and_nan(spark):
    df = spark.createDataFrame([(1.0, 1), (None, 1), (math.nan, 1), (3.0, 1), (None, 2)], "x double, k int")
    rows = exact_quantiles(df, ["x"], [0.5], ["k"]).collect()
    assert [(r["k"], r["n"], r["q"]) for r in rows] == [(1, 2, [2.0])]


def test_summary_and_nulls(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (2, None, None), (3, 5.0, "b")], "i int, x double, s string")
    got = {r["column"]: r for r in profile.summary(df).collect()}
    assert (got["x"]["count"], got["x"]["null_count"], got["x"]["mean"]) == (2, 1, 3.0)
    assert (got["x"]["q25"], got["x"]["q50"], got["x"]["q75"]) == (1.0, 5.0, 5.0)
    assert (got["i"]["q50"], got["i"]["std"]) == (2.0, 1.0)
    sketched = {r["column"]: r for r in profile.summary(df, approx=True).collect()}
    assert sketched["i"]["q50"] == 2.0
    nulls = {r["column"]: r["null_count"] for r in profile.null_profile(df, only_nulls=True).collect()}
    assert nulls == {"x": 1, "s": 1}
    assert profile.total_nulls(df).first()["nulls"] == 2
    with pytest.raises(ValueError, match="nulls left"):
        profile.require_no_nulls(df)


def test_group_stats_single_row_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 4.0), ("b", 2.0), (None, 9.0)], "k string, y double")
    for discrete in [True, False]:
        got = {r["k"]: r for r in groups.group_stats(df, ["k"], "y", discrete).collect()}
        assert got["a"]["median"] == 2.5 and got["b"]["std"] is None and got[None]["max"] == 9.0


def test_survival_rates(spark):
    rows = [
        (1, 0, 3, "male", 22.0, 7.25), (2, 1, 1, "female", 38.0, 71.28), (3, 1, 3, "female", None, 7.92),
        (4, 1, 1, "female", 35.0, 53.1), (5, 0, 3, "male", None, 8.05), (6, 0, 3, "male", 54.0, 0.0),
    ]
    df = spark.createDataFrame(
        rows, "PassengerId int, Survived int, Pclass int, Sex string, Age double, Fare double"
    )
    hit = F.col("Survived") == 1
    assert groups.rate_by(df, hit).first()["rate"] == 50.0
    assert {r["Sex"]: r["rate"] for r in groups.rate_by(df, hit, ["Sex"]).collect()} == {"male": 0.0, "female": 100.0}
    counts = {(r[0], r[1]): r[2] for r in groups.two_way_counts(df, "Pclass", "Survived").collect()}
    assert counts == {(3, 0): 3, (1, 1): 2, (3, 1): 1}
    ages = profile.histogram(df, "Age", 5, ["Survived"]).collect()
    assert sum(r["n"] for r in ages) == 4 and {r["bin_end"] - r["bin_start"] for r in ages} == {10.0}
    assert profile.scatter(df, "Age", "Fare", positive="Fare").count() == 3


def test_histogram_of_constant_and_steps(spark):
    constant = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert [tuple(r) for r in profile.histogram(constant, "x").collect()] == [(5.0, 6.0, 2)]
    limits = [(0.0, 10.0, 10, 1.0), (0.0, 11.0, 10, 2.0), (0.0, 0.3, 10, 0.05), (29.0, 171.0, 30, 5.0)]
    for low, high, bins, step in limits:
        got = constant.select(profile.round_step(F.lit(low), F.lit(high), bins)).first()[0]
        assert got == pytest.approx(step)


def test_box_stats_and_outliers(spark):
    rows = [("a", float(x)) for x in [1, 2, 3, 4, 5, 6, 7, 8, 100]] + [("b", 1.0)]
    df = spark.createDataFrame(rows, "k string, y double")
    for discrete in [True, False]:
        got = {r["k"]: r for r in profile.box_stats(df, ["k"], "y", discrete).collect()}
        assert (got["a"]["q1"], got["a"]["median"], got["a"]["q3"]) == (3.0, 5.0, 7.0)
        assert (got["a"]["low_whisker"], got["a"]["high_whisker"], got["a"]["n_outliers"]) == (1.0, 8.0, 1)
        assert got["b"]["n_outliers"] == 0
    assert [r["y"] for r in profile.box_outliers(df, ["k"], "y").collect()] == [100.0]


def test_correlation_null_policies(spark):
    rows = [(1.0, 2.0, None), (2.0, 4.0, 1.0), (3.0, None, 0.0), (4.0, 9.0, 5.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    pairwise = {(r["a"], r["b"]): r["r"] for r in profile.correlations(df, ["a", "b"]).collect()}
    assert pairwise[("a", "b")] == pytest.approx(np.corrcoef([1, 2, 4], [2, 4, 9])[0, 1])
    complete = {(r["a"], r["b"]): r["r"] for r in profile.correlations(df, ["a", "b", "c"], "complete").collect()}
    assert complete[("a", "b")] == pytest.approx(1.0)
    imputed = {(r["a"], r["b"]): r["r"] for r in profile.correlations(df, ["a", "b"], "impute").collect()}
    assert imputed[("a", "b")] == pytest.approx(np.corrcoef([1, 2, 3, 4], [2, 4, 4, 9])[0, 1])


def test_impute_fit_never_sees_test_rows(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 10.0)], "k string, x double")
    test = spark.createDataFrame([("a", None), ("b", None), ("a", 99.0)], "k string, x double")
    stats = impute.fit_impute(train, {"x": "median"})
    assert [r["x"] for r in impute.apply_impute(test, stats).collect()] == [3.0, 3.0, 99.0]
    grouped = impute.fit_impute(train, {"x": "median"}, ["k"])
    got = impute.apply_impute(test, grouped, ["k"], "_filled").collect()
    assert {(r["k"], r["x_filled"]) for r in got} == {("a", 2.0), ("b", 10.0), ("a", 99.0)}
    mixed = impute.fit_impute(train, {"x": "mean", "k": "none"})
    assert mixed.first().asDict() == {"x": pytest.approx(14 / 3), "k": "none"}


def test_lookup_join_shuffled_equals_broadcast(spark):
    rows = [(i, None if i % 10 == 0 else "hot" if i % 3 else "cold") for i in range(300)]
    df = spark.createDataFrame(rows, "i int, k string")
    dim = spark.createDataFrame([("hot", 1), ("cold", 2), (None, 3)], "k string, v int")
    plain = joins.lookup_join(df, dim, ["k"], bounded=True)
    shuffled = joins.lookup_join(df, dim.hint("merge"), ["k"])
    assert sorted(map(str, plain.collect())) == sorted(map(str, shuffled.collect()))
    assert shuffled.filter("k IS NULL AND v = 3").count() == 30
    for how in ("full", "right", "cross"):
        with pytest.raises(ValueError):
            joins.lookup_join(df, dim, ["k"], how)


def test_choose_ties(spark):
    df = spark.createDataFrame([("m1", 0, 2.0), ("m2", 1, 1.0), ("m3", 2, 1.0)], "model string, listed int, rmse double")
    assert choose.best_row(df, "rmse", "listed").first()["model"] == "m2"
    assert [r["model"] for r in choose.top_k(df, "rmse", 2, ["model"]).collect()] == ["m1", "m2"]
    ordered = choose.order_by_list(df, "model", ["m3", "m1"])
    assert [r["model"] for r in ordered.collect()] == ["m3", "m1", "m2"]


def test_reshape(spark):
    train = spark.createDataFrame([("a", 1, 5.0)], "k string, snow int, y double")
    test = spark.createDataFrame([("b", 1)], "k string, rain int")
    left, right = reshape.align_columns(train, test, target="y")
    assert left.columns == ["k", "snow", "y", "rain"] and right.columns == ["k", "snow", "rain"]
    assert right.first().asDict() == {"k": "b", "snow": 0, "rain": 1}
    assert reshape.learn_categories(train, "k", 10) == ["a"]
    with pytest.raises(ValueError):
        reshape.learn_categories(train.unionByName(train.withColumn("k", F.lit("z"))), "k", 1)
    flat = spark.createDataFrame([(1.0, 3.0), (3.0, 3.0)], "a double, b double")
    scaled = reshape.apply_scaler(flat, reshape.fit_scaler(flat, ["a", "b"]), ["a", "b"])
    assert [tuple(r) for r in scaled.collect()] == [(-1.0, 0.0), (1.0, 0.0)]
    rows = reshape.rows_frame(spark, {"m": {"rmse": 1.5}}, "model", "model string, rmse double")
    assert rows.first().asDict() == {"model": "m", "rmse": 1.5}


def test_expected_and_missing_keys(spark, monkeypatch):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "k string, v int")
    expected = spark.createDataFrame([("a",), ("a",), ("z",)], "k string")
    assert sorted(r["v"] for r in joins.with_expected(df, expected, ["k"]).collect()) == [1, 2]
    semi = joins.lookup_join(df, expected.distinct(), ["k"], "left_semi")
    assert sorted(r["v"] for r in semi.collect()) == [1, 2]
    assert [r["k"] for r in joins.missing_keys(expected, df, ["k"]).collect()] == ["z"]


def test_holidays(spark):
    from demandkit.operators.calendar import with_holidays

    df = spark.createDataFrame([("2013-12-31",), ("2014-01-01",), (None,)], "d string")
    calendar = spark.createDataFrame([("2014-01-01",), ("2014-01-01",), (None,)], "ds string")
    got = with_holidays(df.withColumn("ds", F.col("d").cast("date")), "ds", calendar).collect()
    assert [(r["d"], r["is_holiday"], r["is_next_holiday"]) for r in got] == [
        ("2013-12-31", 0, 1), ("2014-01-01", 1, 0), (None, 0, 0),
    ]
