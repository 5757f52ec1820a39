"""Known results on the lunch-sales files, where a folder with them is named.

``DEMANDKIT_GOLDEN`` names a folder with ``train.csv``, ``test.csv``, ``submission.csv`` (the
ridge forecast to reproduce) and ``features.csv`` (derived training columns). No data is kept
in this repository, so the tests are skipped without it.
"""

from __future__ import annotations

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from demandkit.functions.dates import parse_date
from demandkit.operators import evaluate, groups, linear, profile
from demandkit.operators.series import Series
from demandkit.plans import presets
from demandkit.sources import sinks, tables

FOLDER = os.environ.get("DEMANDKIT_GOLDEN")
pytestmark = pytest.mark.skipif(not FOLDER, reason="DEMANDKIT_GOLDEN is not set")

ATTRIBUTES = (
    "week string, soldout int, name string, kcal double, remarks string, event string, "
    "payday double, weather string, precipitation string, temperature double"
)
SHOP = Series(("shop",))


def read(spark, name, schema):
    df = tables.read_table(spark, str(Path(FOLDER) / name), StructType.fromDDL(schema))
    return df.withColumns({"ds": parse_date(F.col("datetime")), "shop": F.lit("one")})


@pytest.fixture(scope="module")
def train(spark):
    return read(spark, "train.csv", f"datetime string, y int, {ATTRIBUTES}")


@pytest.fixture(scope="module")
def test(spark):
    return read(spark, "test.csv", f"datetime string, {ATTRIBUTES}")


def test_shape_and_statistics(train, test):
    assert (train.count(), test.count()) == (207, 40)
    stats = profile.target_stats(train, "y").first()
    assert (stats["min"], stats["max"], stats["median"]) == (29, 171, 78)
    assert stats["mean"] == pytest.approx(86.6232, abs=1e-4)
    assert stats["std"] == pytest.approx(32.8824, abs=1e-4)
    nulls = {r["column"]: r["null_count"] for r in profile.null_profile(train).collect()}
    assert (nulls["kcal"], nulls["remarks"], nulls["event"], nulls["payday"]) == (41, 186, 193, 197)
    by_week = {r["week"]: r["mean"] for r in groups.group_stats(train, ["week"], "y").collect()}
    expected = {"月": 94.0513, "火": 86.7805, "水": 86.4884, "木": 79.1628, "金": 87.3659}
    assert by_week == pytest.approx(expected, abs=1e-4)
    remarks = {r["present"]: r["mean"] for r in groups.presence_comparison(train, "remarks", "y").collect()}
    assert remarks == pytest.approx({1: 90.6, 0: 86.2}, abs=0.05)
    event = {r["present"]: r["mean"] for r in groups.presence_comparison(train, "event", "y").collect()}
    assert event == pytest.approx({1: 80.8, 0: 87.0}, abs=0.05)


def test_fitted_medians(train):
    stats = presets.fit_preset(train, "codes_9").first()
    assert (stats["kcal"], stats["temperature"]) == (408.5, 19.8)


def test_derived_columns(spark, train):
    wanted = read(
        spark, "features.csv",
        f"datetime string, y int, {ATTRIBUTES}, is_otanoshimi int, is_curry int, is_donburi int, "
        "precipitation_num double, month int, kcal_filled double, week_enc int, weather_enc int",
    )
    made = presets.build_features(train, "codes_9", presets.fit_preset(train, "codes_9"), SHOP)
    columns = presets.PRESETS["codes_9"]
    assert made.select("ds", *columns).exceptAll(wanted.select("ds", *columns)).count() == 0
    assert wanted.count() == made.count()


def test_ridge_submission(spark, train, test, tmp_path):
    stats = presets.fit_preset(train, "compact_5")
    rows = presets.build_features(train, "compact_5", stats, SHOP)
    future = presets.build_features(test, "compact_5", stats, SHOP, target=None)
    features = presets.PRESETS["compact_5"]
    model = linear.fit_linear(rows, features, "y", alpha=1.0)
    scored = linear.score(future, model, features)
    sinks.write_submission(scored, str(tmp_path / "out"), "ds", "prediction", single_file=True)
    written = next((tmp_path / "out").glob("part-*.csv")).read_text().split()
    assert written == (Path(FOLDER) / "submission.csv").read_text().split()


def test_fold_errors(train):
    rows = presets.build_features(train, "compact_5", presets.fit_preset(train, "compact_5"), SHOP)
    folds = linear.cross_validate_linear(rows, presets.PRESETS["compact_5"], "y", "ds", alphas=(1.0,))
    got = [r["rmse"] for r in folds.orderBy("fold").collect()]
    assert got == pytest.approx([19.0455, 34.9325, 22.1356, 16.0382, 29.0247], abs=1e-4)
    assert evaluate.fold_summary(folds).first()["mean_rmse"] == pytest.approx(24.2353, abs=1e-4)


@pytest.mark.parametrize("preset", list(presets.PRESETS))
def test_presets_have_no_nulls_but_series_gaps(spark, train, test, preset):
    stats = presets.fit_preset(train, preset)
    calendar = spark.createDataFrame([("2014-01-01",)], "ds string")
    made = presets.build_features(train, preset, stats, SHOP, calendar=calendar)
    plain = [f for f in presets.PRESETS[preset] if presets.parse_feature(f) is None]
    assert profile.total_nulls(made, plain).first()["nulls"] == 0
    future = presets.build_features(test, preset, stats, SHOP, target=None, calendar=calendar)
    assert future.columns == [c for c in made.columns if c != "y"]
