"""Codes and ridge effects of many categories against one-hot columns."""

from __future__ import annotations

import random

import numpy as np
import pytest

from demandkit.operators import categories


def test_ridge_equals_dense_one_hot(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice("abcdefg"), rnd.random(), rnd.gauss(0, 1)) for _ in range(300)]
    rows = [(c, x, z, 2 * x - z + "abcdefg".index(c) + rnd.random()) for c, x, z in rows]
    alpha = 2.5
    made = categories.fit_category_ridge(
        spark.createDataFrame([*rows, (None, 1.0, 1.0, 99.0), ("a", None, 1.0, 99.0)], "c string, x double, z double, y double"), ["x", "z"], "y", "c", alpha
    )
    dense = np.array([[1.0, x, z, *[float(c == k) for k in "abcdefg"]] for c, x, z, _ in rows])
    penalty = np.diag([0.0] + [alpha] * 9)
    want = np.linalg.solve(dense.T @ dense + penalty, dense.T @ np.array([r[3] for r in rows]))
    effects = {r["c"]: r["effect"] for r in made.effects.collect()}
    assert np.allclose([made.intercept, *made.coef, *[effects[k] for k in "abcdefg"]], want)
    scored = made.score(spark.createDataFrame([("a", 1.0, 2.0), ("new", 1.0, 2.0)], "c string, x double, z double"), ["x", "z"], "c")
    assert np.allclose(sorted(r.prediction for r in scored.collect()), sorted([want[0] + want[1] + 2 * want[2] + want[3], want[0] + want[1] + 2 * want[2]]))


def test_ten_thousand_categories(spark):
    rows = spark.createDataFrame([(f"c{i % 10_000:05d}", float(i % 7), float(i % 10_000)) for i in range(30_000)], "c string, x double, y double")
    codes = categories.learn_codes(rows, "c")
    coded = categories.encode(rows, "c", codes)
    assert coded.columns == ["c", "x", "y", "code"]
    assert codes.count() == 10_000 and coded.where("code <> cast(substr(c, 2) as int)").count() == 0
    made = categories.fit_category_ridge(rows, ["x"], "y", "c", 1.0)
    assert made.effects.count() == 10_000 and abs(made.effects.agg({"effect": "sum"}).first()[0]) < 1e-3 * 10_000 * 5000


def test_odd_tables(spark):
    empty = spark.createDataFrame([], "c string, x double, y double")
    assert categories.learn_codes(empty, "c").count() == 0
    with pytest.raises(ValueError, match="no rows"):
        categories.fit_category_ridge(empty, ["x"], "y", "c")
    with pytest.raises(ValueError, match="penalty"):
        categories.fit_category_ridge(empty, ["x"], "y", "c", 0.0)
    some = spark.createDataFrame([(None, 1.0, 1.0), ("b", 1.0, 1.0), ("a", 1.0, 1.0), ("b", 1.0, 1.0)], "c string, x double, y double")
    got = categories.encode(some, "c", categories.learn_codes(some, "c")).collect()
    assert sorted((str(r["c"]), r["code"]) for r in got if r["code"] is not None) == [("a", 0), ("b", 1), ("b", 1)] and len(got) == 4
