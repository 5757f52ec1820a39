from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from demandkit.operators import folds, series
from demandkit.operators.series import Series

DAY0 = dt.date(2013, 11, 18)


def daily_rows(n, key="s"):
    return [(key, DAY0 + dt.timedelta(days=i), float((i * 7) % 11)) for i in range(n)]


def test_features_are_leak_free(spark):
    df = spark.createDataFrame(daily_rows(4), "k string, ds date, y double")
    names = ["lag_1", "rolling_mean_5", "rolling_std_5", "lag_diff"]
    got = series.add_series_features(df, Series(("k",)), "y", names).orderBy("ds").collect()
    assert [r["lag_1"] for r in got] == [None, 0.0, 7.0, 3.0]
    assert [r["rolling_mean_5"] for r in got] == [None, 0.0, 3.5, pytest.approx(10 / 3)]
    assert [r["rolling_std_5"] for r in got][:3] == [None, None, pytest.approx(24.5**0.5)]
    assert [r["lag_diff"] for r in got] == [None, None, 7.0, -4.0]


def test_unknown_feature_and_missing_key(spark):
    df = spark.createDataFrame(daily_rows(2), "k string, ds date, y double")
    with pytest.raises(ValueError):
        series.add_series_features(df, Series(("k",)), "y", ["mean_5"])
    with pytest.raises(ValueError):
        Series(())


@pytest.mark.parametrize("stretch", [4, 7, 1000])
def test_stretched_windows_equal_plain_ones(spark, stretch):
    rng = random.Random(stretch)
    start = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(300):
        key = "hot" if rng.random() < 0.8 else rng.choice(["a", None])
        moment = start + dt.timedelta(seconds=rng.choice([0, 1, 2, 90000, 90001, rng.randrange(10**6)]))
        rows.append((i, key, None if i % 50 == 0 else moment, rng.random()))
    df = spark.createDataFrame(rows, "i int, k string, t timestamp, v double")
    makers = {"lag": series.lag("v", 3), "mean": series.trailing_mean("v", 3), "diff": series.difference("v")}
    long = Series(("k",), "t", daily=False, ties=("i",))
    split = series.with_trailing(df, long, makers, 3, stretch_rows=stretch)
    w = long.window()
    plain = df.withColumns({n: make(w) for n, make in makers.items()})
    assert sorted(map(tuple, split.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    placed = series.with_position(df, long).withColumn("same", F.row_number().over(w))
    assert placed.filter("position <> same").count() == 0 and placed.count() == 300


def test_tail_buffer_and_fill(spark):
    df = spark.createDataFrame(daily_rows(12) + daily_rows(2, "short"), "k string, ds date, y double")
    got = {r["k"]: r["buffer"] for r in series.tail_buffer(df, Series(("k",)), "y", 10).collect()}
    assert got["s"] == [r[2] for r in daily_rows(12)[-10:]] and got["short"] == [0.0, 7.0]
    lagged = series.add_series_features(df, Series(("k",)), "y", ["lag_7"])
    filled = series.fill_with_series_mean(lagged, df, Series(("k",)), "y", ["lag_7"])
    assert {r["lag_7"] for r in filled.filter("k = 'short'").collect()} == {3.5}


def test_time_folds_of_207_days(spark):
    df = spark.createDataFrame(daily_rows(207), "k string, ds date, y double")
    got = folds.fold_bounds(df, "ds").orderBy("fold").collect()
    assert [(r["n_train"], r["n_train"] + r["n_test"]) for r in got] == [
        (37, 71), (71, 105), (105, 139), (139, 173), (173, 207),
    ]
    assert all(r["train_end"] < r["test_start"] for r in got)
    by_series = folds.series_folds(df, Series(("k",))).groupBy("block").count().collect()
    assert {r["block"]: r["count"] for r in by_series} == {0: 37, 1: 34, 2: 34, 3: 34, 4: 34, 5: 34}


def test_folds_reject_timestamps_and_short_series(spark):
    df = spark.createDataFrame(daily_rows(3), "k string, ds date, y double")
    with pytest.raises(TypeError):
        folds.time_folds(df.withColumn("ds", F.col("ds").cast("timestamp")), "ds")
    with pytest.raises(Exception, match="fewer dates than folds"):
        folds.time_folds(df, "ds").collect()


def test_holdout_is_repeatable(spark):
    ids = spark.range(5000)
    flagged = ids.select("id", folds.holdout_flag(F.col("id")).alias("out"))
    again = ids.repartition(7).select("id", folds.holdout_flag(F.col("id")).alias("out"))
    assert flagged.exceptAll(again).count() == 0
    assert 0.17 < flagged.agg(F.avg("out")).first()[0] < 0.23


def test_rows_of_one_instant_are_spread(spark, monkeypatch):
    """A key with all rows, all at one time: its rows lie in many ranges, none much larger than a fair share."""
    n = 20_000
    rows = spark.range(n).select(F.lit("k").alias("k"), F.lit("2024-01-01").cast("timestamp").alias("ts"), (F.col("id") * 7919 % n).alias("tie"))
    kept = []
    inner = series.checkpointed
    monkeypatch.setattr(series, "checkpointed", lambda df: kept.append(inner(df)) or kept[-1])
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = series.with_position(rows, series.Series(("k",), "ts", daily=False, ties=("tie",)))
        assert [(r.tie, r.position) for r in placed.orderBy("tie").collect()] == [(i, i + 1) for i in range(n)]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    shares = [r["count"] for r in kept[0].groupBy(F.shiftright("_at", 33).alias("part")).count().collect()]
    assert len(shares) >= 6 and max(shares) < 0.3 * n
