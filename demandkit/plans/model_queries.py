"""Queries over linear and tree models, their evaluation, and forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandkit.operators import evaluate, folds, forecast, linear, trees
from demandkit.operators.choose import best_row
from demandkit.operators.profile import target_range
from demandkit.functions.dates import weekday_flag
from demandkit.plans import presets
from demandkit.plans.catalogue import day_text, query, rounded
from demandkit.plans.derived import (
    BLOCKS_SQL,
    CUT,
    DEMAND,
    DEMAND_SQL,
    MODEL_SQL,
    SHOP,
    calendar,
    demand,
    model_rows,
    sales,
    tree_rows,
)
from demandkit.session import checkpointed

_TWO = ["lag_1", "rolling_mean_5"]

# Sums and the closed form of a two-feature ridge fit, from a relation "rows" with group "g".
_TWO_FEATURE_SQL = """sums AS (
  SELECT g, alpha, count(*) AS n, avg(y) AS my, avg(lag_1) AS m1, avg(rolling_mean_5) AS m2,
         var_pop(lag_1) * count(*) AS s11, var_pop(rolling_mean_5) * count(*) AS s22,
         covar_pop(lag_1, rolling_mean_5) * count(*) AS s12, covar_pop(lag_1, y) * count(*) AS s1y,
         covar_pop(rolling_mean_5, y) * count(*) AS s2y
  FROM rows GROUP BY g, alpha),
slopes AS (
  SELECT *, ((s22 + alpha) * s1y - s12 * s2y) / ((s11 + alpha) * (s22 + alpha) - s12 * s12) AS w1,
         ((s11 + alpha) * s2y - s12 * s1y) / ((s11 + alpha) * (s22 + alpha) - s12 * s12) AS w2
  FROM sums),
models AS (SELECT *, my - w1 * m1 - w2 * m2 AS b FROM slopes)"""


def _coefficients(models, by):
    return models.select(
        *by,
        rounded("intercept", "intercept"),
        rounded(F.col("coef")[0], "w1"),
        rounded(F.col("coef")[1], "w2"),
    )


@query(
    "m3_least_squares",
    f"""
    WITH {MODEL_SQL}, rows AS (SELECT series AS g, 0 AS alpha, * FROM clean), {_TWO_FEATURE_SQL}
    SELECT g AS series, round(b, 6) AS intercept, round(w1, 6) AS w1, round(w2, 6) AS w2 FROM models
    """,
)
def m3(spark, sf):
    return _coefficients(linear.fit_linear(model_rows(spark, sf), _TWO, "y", ["series"]), ["series"])


@query(
    "m4_ridge",
    f"""
    WITH {MODEL_SQL}, rows AS (SELECT series AS g, 50 AS alpha, * FROM clean), {_TWO_FEATURE_SQL}
    SELECT g AS series, round(b, 6) AS intercept, round(w1, 6) AS w1, round(w2, 6) AS w2 FROM models
    """,
)
def m4(spark, sf):
    models = linear.fit_linear(model_rows(spark, sf), _TWO, "y", ["series"], alpha=50.0)
    return _coefficients(models, ["series"])


@query(
    "m4_ridge_standardised",
    f"""
    WITH {MODEL_SQL}, z AS (
      SELECT stddev_pop(lag_1) AS d1, stddev_pop(rolling_mean_5) AS d2 FROM clean),
    rows AS (SELECT 1 AS g, 100 AS alpha, y, lag_1 / d1 AS lag_1, rolling_mean_5 / d2 AS rolling_mean_5, d1, d2
             FROM clean, z), {_TWO_FEATURE_SQL}
    SELECT round(b, 6) AS intercept, round(w1 / d1, 6) AS w1, round(w2 / d2, 6) AS w2 FROM models, z
    """,
)
def m4_standardised(spark, sf):
    models = linear.fit_linear(model_rows(spark, sf), _TWO, "y", alpha=100.0, standardise=True)
    return _coefficients(models, [])


@query(
    "m5_cross_sums",
    f"""
    WITH {MODEL_SQL}, {BLOCKS_SQL}
    SELECT series, fold, count(*) AS n, CAST(sum(y) AS DOUBLE) AS sy, CAST(sum(y * y) AS DOUBLE) AS syy,
           CAST(sum(lag_1) AS DOUBLE) AS sx, CAST(sum(lag_1 * y) AS DOUBLE) AS sxy,
           CAST(sum(lag_1 * lag_1) AS DOUBLE) AS sxx
    FROM (SELECT series, CAST(fold AS INTEGER) AS fold, y, lag_1 FROM training) t GROUP BY 1, 2
    """,
)
def m5(spark, sf):
    """One pass over the rows gives the sums of every expanding training set."""
    blocks = folds.time_folds(model_rows(spark, sf), "ds")
    sums = linear.cross_sums(blocks, ["lag_1"], "y", ["series", "block"], origin={})
    train = linear.expanding_sums(sums, ["lag_1"], 5, ["series"])
    return train.select(
        "series", "fold", F.col("n").cast("bigint").alias("n"), "sy", "syy",
        F.col("sx_0").alias("sx"), F.col("sxy_0").alias("sxy"), F.col("sxx_0_0").alias("sxx"),
    )


@query(
    "m6_score_per_series",
    f"""
    WITH {MODEL_SQL}, rows AS (SELECT series AS g, 0 AS alpha, * FROM clean), {_TWO_FEATURE_SQL}
    SELECT series, strftime(ds, '%Y-%m-%d') AS ds, round(b + w1 * lag_1 + w2 * rolling_mean_5, 6) AS prediction
    FROM clean JOIN models ON g = series
    """,
)
def m6(spark, sf):
    rows = model_rows(spark, sf)
    models = linear.fit_linear(rows, _TWO, "y", ["series"])
    scored = linear.score(rows, models, _TWO, ["series"])
    return scored.select("series", day_text(), rounded("prediction", "prediction"))


_CV_SQL = f"""{MODEL_SQL}, {BLOCKS_SQL}, alphas AS (SELECT unnest([{{alphas}}]) AS alpha),
rows AS (SELECT fold AS g, alpha, y, lag_1, rolling_mean_5 FROM training, alphas), {_TWO_FEATURE_SQL},
oof AS (
  SELECT p.series, p.ds, p.y, CAST(p.block AS INTEGER) AS fold, m.alpha,
         b + w1 * lag_1 + w2 * rolling_mean_5 AS prediction
  FROM placed p JOIN models m ON m.g = p.block),
scores AS (
  SELECT alpha, fold, count(*) AS n, sqrt(avg(power(y - prediction, 2))) AS rmse FROM oof GROUP BY 1, 2)"""


@query(
    "m10_cross_validation",
    f"WITH {_CV_SQL.format(alphas='0')} SELECT fold, n, round(rmse, 6) AS rmse FROM scores",
)
def m10(spark, sf):
    made = linear.cross_validate_linear(model_rows(spark, sf), _TWO, "y", "ds")
    return made.select("fold", "n", rounded("rmse", "rmse"))


@query(
    "m10_cross_validation_per_series",
    f"""
    WITH {MODEL_SQL}, {BLOCKS_SQL},
    rows AS (SELECT (series, fold) AS g, 0 AS alpha, y, lag_1, rolling_mean_5 FROM training), {_TWO_FEATURE_SQL}
    SELECT p.series, CAST(p.block AS INTEGER) AS fold, count(*) AS n,
           round(sqrt(avg(power(y - (b + w1 * lag_1 + w2 * rolling_mean_5), 2))), 6) AS rmse
    FROM placed p JOIN models m ON m.g = (p.series, p.block) GROUP BY 1, 2
    """,
)
def m10_series(spark, sf):
    made = linear.cross_validate_linear(model_rows(spark, sf), _TWO, "y", "ds", by=["series"])
    return made.select("series", "fold", "n", rounded("rmse", "rmse"))


@query(
    "m11_out_of_fold",
    f"""
    WITH {_CV_SQL.format(alphas='10')}
    SELECT series, strftime(ds, '%Y-%m-%d') AS ds, fold, round(prediction, 6) AS prediction FROM oof
    """,
)
def m11(spark, sf):
    made = linear.out_of_fold_linear(model_rows(spark, sf), _TWO, "y", "ds", alpha=10.0)
    return made.select("series", day_text(), "fold", rounded("prediction", "prediction"))


def _compared(rows):
    """Trailing mean, least squares and ridge under the same folds."""
    blocks = folds.time_folds(rows, "ds").filter("block > 0").withColumnRenamed("block", "fold")
    naive = evaluate.fold_summary(evaluate.rmse(blocks, "y", "rolling_mean_5", ["fold"]))
    fitted = evaluate.fold_summary(
        linear.cross_validate_linear(rows, _TWO, "y", "ds", alphas=(0.0, 1000.0)), ["alpha"]
    )
    plain = F.col("alpha") == 0
    results = fitted.select(
        F.when(plain, "least squares").otherwise("ridge").alias("model"),
        F.when(plain, 1).otherwise(2).alias("listed"),
        "mean_rmse",
        "std_rmse",
    ).unionByName(
        naive.select(F.lit("trailing mean").alias("model"), F.lit(0).alias("listed"), "mean_rmse", "std_rmse")
    )
    return evaluate.compare_models(checkpointed(results), "trailing mean")


_COMPARE_SQL = f"""{_CV_SQL.format(alphas='0, 1000')},
all_scores AS (
  SELECT CASE WHEN alpha = 0 THEN 'least squares' ELSE 'ridge' END AS model,
         CASE WHEN alpha = 0 THEN 1 ELSE 2 END AS listed, rmse FROM scores
  UNION ALL
  SELECT 'trailing mean', 0, sqrt(avg(power(y - rolling_mean_5, 2))) FROM placed WHERE block > 0 GROUP BY block),
compared AS (
  SELECT model, listed, avg(rmse) AS mean_rmse, stddev_pop(rmse) AS std_rmse FROM all_scores GROUP BY 1, 2)"""


@query(
    "m12_model_comparison",
    f"""
    WITH {_COMPARE_SQL}
    SELECT model, listed, round(mean_rmse, 6) AS mean_rmse, round(std_rmse, 6) AS std_rmse,
           round(100 * (base - mean_rmse) / base, 6) AS improvement
    FROM compared, (SELECT mean_rmse AS base FROM compared WHERE listed = 0) b
    """,
)
def m12(spark, sf):
    made = _compared(model_rows(spark, sf))
    return made.select(
        "model", "listed", *[rounded(c, c) for c in ["mean_rmse", "std_rmse", "improvement"]]
    )


@query(
    "m12_best_model",
    f"""
    WITH {_COMPARE_SQL}
    SELECT model, round(mean_rmse, 6) AS mean_rmse FROM compared ORDER BY mean_rmse, listed LIMIT 1
    """,
)
def m12_best(spark, sf):
    best = best_row(_compared(model_rows(spark, sf)), "mean_rmse", "listed")
    return best.select("model", rounded("mean_rmse", "mean_rmse"))


@query(
    "m13_feature_sets",
    f"""
    WITH {MODEL_SQL}, {BLOCKS_SQL},
    one AS (SELECT fold, regr_slope(y, lag_1) AS w, regr_intercept(y, lag_1) AS b FROM training GROUP BY 1),
    one_scores AS (SELECT sqrt(avg(power(y - b - w * lag_1, 2))) AS rmse
                   FROM placed p JOIN one ON one.fold = p.block GROUP BY p.block),
    rows AS (SELECT fold AS g, 0 AS alpha, y, lag_1, rolling_mean_5 FROM training), {_TWO_FEATURE_SQL},
    two_scores AS (SELECT sqrt(avg(power(y - (b + w1 * lag_1 + w2 * rolling_mean_5), 2))) AS rmse
                   FROM placed p JOIN models m ON m.g = p.block GROUP BY p.block),
    both_sets AS (SELECT 'one' AS model, 0 AS listed, avg(rmse) AS r, stddev_pop(rmse) AS s FROM one_scores
             UNION ALL SELECT 'two', 1, avg(rmse), stddev_pop(rmse) FROM two_scores)
    SELECT model, listed, round(r, 6) AS mean_rmse, round(s, 6) AS std_rmse,
           round(100 * (base - r) / base, 6) AS improvement
    FROM both_sets, (SELECT r AS base FROM both_sets WHERE listed = 0) b
    """,
)
def m13(spark, sf):
    sets = {"one": ["lag_1"], "two": _TWO}
    made = evaluate.compare_feature_sets(model_rows(spark, sf), sets, "y", "ds")
    return made.select(
        "model", "listed", *[rounded(c, c) for c in ["mean_rmse", "std_rmse", "improvement"]]
    )


@query("m13_preset_comparison")
def m13_presets(spark, sf):
    """Four features against twenty-five, standardised ridge on the same folds."""
    rows = sales(spark, sf)
    train, _ = _cut(rows)
    built = presets.build_features(rows, "full_25", presets.fit_preset(train, "full_25"), SHOP)
    both = built.withColumn("is_friday", weekday_flag(F.col("ds")))
    sets = {name: presets.PRESETS[name] for name in ["core_4", "full_25"]}
    made = evaluate.compare_feature_sets(both, sets, "y", "ds", alpha=1.0, standardise=True)
    return made.select("model", "listed", "mean_rmse", "std_rmse", "pooled_rmse", "improvement")


@query("m13_published_sets")
def m13_published(spark, sf):
    """Four features, eleven with holidays, thirteen with lags, and the published four, on the same folds."""
    rows, days = sales(spark, sf), calendar(spark, sf)
    train, _ = _cut(rows)
    names = ["core_4", "holiday_11", "lagged_13", "published_4"]
    keys = ["shop", "ds"]
    built = presets.build_features(rows, "lagged_13", presets.fit_preset(train, "lagged_13"), SHOP, calendar=days)
    # the same name may mean another thing in another set: bad weather by rain, or by its label
    other = presets.build_features(rows, "published_4", presets.fit_preset(train, "published_4"), SHOP, target=None)
    both = built.join(other.select(*keys, *[F.col(c).alias(f"{c}_4") for c in ("is_otanoshimi", "is_bad_weather")]), keys)
    sets = {name: list(presets.PRESETS[name]) for name in names}
    sets["published_4"] = ["month", "temperature", "is_otanoshimi_4", "is_bad_weather_4"]
    made = evaluate.compare_feature_sets(both, sets, "y", "ds", alpha=1.0, standardise=True)
    return made.select("model", "listed", "mean_rmse", "std_rmse", "pooled_rmse", "improvement")


@query(
    "m14_ridge_path",
    f"""
    WITH {_CV_SQL.format(alphas='0, 1, 10, 100, 1000, 10000')}
    SELECT CAST(alpha AS DOUBLE) AS alpha, round(avg(rmse), 6) AS mean_rmse, round(stddev_pop(rmse), 6) AS std_rmse
    FROM scores GROUP BY 1
    """,
)
def m14(spark, sf):
    made = evaluate.ridge_path(
        model_rows(spark, sf), _TWO, "y", "ds", [0.0, 1.0, 10.0, 100.0, 1000.0, 10000.0]
    )
    return made.select("alpha", *[rounded(c, c) for c in ["mean_rmse", "std_rmse"]])


@query(
    "m15_coefficient_importance",
    f"""
    WITH {MODEL_SQL}, rows AS (SELECT series AS g, 0 AS alpha, * FROM clean), {_TWO_FEATURE_SQL}
    SELECT g AS series, 'lag_1' AS feature, round(abs(w1 * sqrt(s11 / n)), 6) AS importance FROM models
    UNION ALL SELECT g, 'rolling_mean_5', round(abs(w2 * sqrt(s22 / n)), 6) FROM models
    """,
)
def m15_linear(spark, sf):
    models = linear.fit_linear(model_rows(spark, sf), _TWO, "y", ["series"])
    made = linear.coefficient_importance(models, _TWO, ["series"])
    return made.withColumn("importance", F.round("importance", 6))


def _cut(rows):
    cut = F.lit(CUT).cast("date")
    return rows.filter(F.col("ds") < cut), rows.filter(F.col("ds") >= cut)


@query(
    "m16_refit_and_score_future",
    f"""
    WITH {MODEL_SQL}, rows AS (SELECT 1 AS g, 1 AS alpha, * FROM clean WHERE ds < DATE '{CUT}'), {_TWO_FEATURE_SQL}
    SELECT series, strftime(ds, '%Y-%m-%d') AS ds,
           round(greatest(b + w1 * lag_1 + w2 * rolling_mean_5, 0), 6) AS prediction
    FROM clean, models WHERE ds >= DATE '{CUT}'
    """,
)
def m16(spark, sf):
    train, future = _cut(model_rows(spark, sf))
    scored = linear.score(future, linear.fit_linear(train, _TWO, "y", alpha=1.0), _TWO)
    bounded = F.greatest(F.col("prediction"), F.lit(0.0))
    return scored.select("series", day_text(), rounded(bounded, "prediction"))


_TAILS_SQL = f"""hist AS (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY ds DESC) AS rn FROM demand WHERE ds < DATE '{CUT}'),
fut AS (SELECT series, ds, isodow(ds) - 1 AS dow, row_number() OVER (PARTITION BY series ORDER BY ds) AS step
        FROM demand WHERE ds >= DATE '{CUT}'),
last_ten AS (SELECT series, CAST(list(y ORDER BY ds) AS DOUBLE[]) AS buf FROM hist WHERE rn <= 10 GROUP BY 1),
tails AS (SELECT f.series, coalesce(buf, CAST([] AS DOUBLE[])) AS buf
          FROM (SELECT DISTINCT series FROM fut) f LEFT JOIN last_ten l ON l.series = f.series)"""


@query(
    "m17_frozen_lags",
    f"""
    WITH {DEMAND_SQL}, {_TAILS_SQL},
    frozen AS (
      SELECT series, max(y) FILTER (rn = 1) AS lag_1, avg(y) FILTER (rn <= 5) AS m5,
             CASE WHEN max(rn) >= 14 THEN max(y) FILTER (rn = 14) ELSE avg(y) FILTER (rn <= 28) END AS lag_14,
             avg(y) FILTER (rn <= 28) AS m28
      FROM hist GROUP BY 1)
    SELECT series, strftime(ds, '%Y-%m-%d') AS ds, CAST(lag_1 AS DOUBLE) AS lag_1, round(m5, 6) AS rolling_mean_5,
           CAST(lag_14 AS DOUBLE) AS lag_14, round(m28, 6) AS rolling_mean_28
    FROM fut JOIN frozen USING (series)
    """,
)
def m17(spark, sf):
    history, future = _cut(demand(spark, sf))
    names = [*_TWO, "lag_14", "rolling_mean_28"]
    made = forecast.frozen_lags(history, future.drop("y"), DEMAND, "y", names)
    means = [rounded(c, c) for c in ("rolling_mean_5", "rolling_mean_28")]
    return made.select("series", day_text(), "lag_1", "lag_14", *means)


# the walk: buf holds the newest ten values, newest last
def _walk_sql(value: str, extra: str = "", models: str = "") -> str:
    return f"""{_TAILS_SQL}{extra},
walk AS (
  SELECT series, CAST(0 AS BIGINT) AS step, CAST(NULL AS DATE) AS ds, buf, CAST(NULL AS DOUBLE) AS p FROM tails
  UNION ALL
  SELECT series, step, ds, list_concat(buf, [p])[-10:], p FROM (
    SELECT w.series, f.step, f.ds, w.buf, CAST({value} AS DOUBLE) AS p
    FROM walk w JOIN fut f ON f.series = w.series AND f.step = w.step + 1 {models}) s)
SELECT series, strftime(ds, '%Y-%m-%d') AS ds, round(p, 6) AS prediction FROM walk WHERE step > 0"""


_LAG_VALUE = "CASE WHEN len(w.buf) >= {k} THEN w.buf[-{k}] ELSE coalesce(list_avg(w.buf), 0) END"
_RICH = ["dayofweek", "lag_1", "lag_5", "rolling_mean_5", "rolling_std_5", "lag_diff"]
_RICH_WEIGHTS = [0.05, 0.3, 0.1, 0.4, 0.2, 0.05]
_RICH_SQL = (
    "0.2 + 0.05 * f.dow + 0.3 * " + _LAG_VALUE.format(k=1) + " + 0.1 * (" + _LAG_VALUE.format(k=5)
    + ") + 0.4 * coalesce(list_avg(w.buf[-5:]), 0)"
    + " + 0.2 * CASE WHEN len(w.buf) > 1 THEN list_aggregate(w.buf[-5:], 'stddev_samp') ELSE 0 END"
    + " + 0.05 * CASE WHEN len(w.buf) > 1 THEN w.buf[-1] - w.buf[-2] ELSE 0 END"
)


def _rich_value(xs):
    value = F.lit(0.2)
    for weight, x in zip(_RICH_WEIGHTS, xs):
        value = value + F.lit(weight) * x
    return value


def _future_calendar(rows):
    return rows.drop("y").withColumn("dayofweek", F.weekday("ds"))


@query(
    "m18_recursive_forecast",
    f"WITH RECURSIVE {DEMAND_SQL}, {_walk_sql(_RICH_SQL)}",
)
def m18(spark, sf):
    """All series features at once, with stated weights."""
    history, future = _cut(demand(spark, sf))
    made = forecast.recursive_forecast(
        history, _future_calendar(future), DEMAND, "y", _RICH, _rich_value
    )
    return made.select("series", day_text(), rounded("prediction", "prediction"))


@query(
    "m18_recursive_forecast_fitted",
    f"""
    WITH RECURSIVE {MODEL_SQL}, rows AS (SELECT series AS g, 1 AS alpha, * FROM clean WHERE ds < DATE '{CUT}'),
    {_TWO_FEATURE_SQL}, {_walk_sql(
        "m.b + m.w1 * w.buf[-1] + m.w2 * list_avg(w.buf[-5:])", models="JOIN models m ON m.g = w.series")}
    """,
)
def m18_fitted(spark, sf):
    """One ridge model per series, each walking its own future."""
    history, future = _cut(demand(spark, sf))
    train, _ = _cut(model_rows(spark, sf))
    models = linear.fit_linear(train, _TWO, "y", ["series"], alpha=1.0).select("series", "intercept", "coef")
    made = forecast.recursive_forecast(
        history, future.drop("y"), DEMAND, "y", _TWO,
        lambda xs: linear.linear_value(F.col("intercept"), F.col("coef"), xs), models,
    )
    return made.select("series", day_text(), rounded("prediction", "prediction"))


@query(
    "m19_forecast_clipped_to_range",
    f"""
    WITH RECURSIVE {DEMAND_SQL}, {_walk_sql(
        f"least(greatest(3.0 * w.buf[-1] - list_avg(w.buf[-5:]) - 0.5, r.low), r.high)",
        extra=f''', limits AS (SELECT series, min(y) AS low, max(y) AS high FROM demand
                               WHERE ds < DATE '{CUT}' GROUP BY 1)''',
        models="JOIN limits r ON r.series = w.series")}
    """,
)
def m19(spark, sf):
    """Bounds of the training range act inside the walk: they change the later lags."""
    history, future = _cut(demand(spark, sf))
    limits = history.groupBy("series").agg(
        F.min("y").cast("double").alias("low"), F.max("y").cast("double").alias("high")
    )
    made = forecast.recursive_forecast(
        history, future.drop("y"), DEMAND, "y", _TWO,
        lambda xs: F.lit(3.0) * xs[0] - xs[1] - 0.5, limits, F.col("low"), F.col("high"),
    )
    return made.select("series", day_text(), rounded("prediction", "prediction"))


@query(
    "m19_forecast_clipped_at_zero",
    f"""
    WITH RECURSIVE {DEMAND_SQL}, {_walk_sql(
        "greatest(1.5 * w.buf[-1] - 0.8 * list_avg(w.buf[-5:]) - 0.5, 0)")}
    """,
)
def m19_zero(spark, sf):
    history, future = _cut(demand(spark, sf))
    made = forecast.recursive_forecast(
        history, future.drop("y"), DEMAND, "y", _TWO,
        lambda xs: F.lit(1.5) * xs[0] - F.lit(0.8) * xs[1] - 0.5, low=0.0,
    )
    return made.select("series", day_text(), rounded("prediction", "prediction"))


_START = "1995-01-02"


@query(
    "m20_short_buffer_forecast",
    f"WITH RECURSIVE {DEMAND_SQL}, {_walk_sql(_RICH_SQL).replace(CUT, _START)}",
)
def m20(spark, sf):
    """A day of history at most: lags fall back to the buffer mean, or 0 where it is empty."""
    start = F.lit(_START).cast("date")
    rows = demand(spark, sf)
    history, future = rows.filter(F.col("ds") < start), rows.filter(F.col("ds") >= start)
    made = forecast.recursive_forecast(
        history, _future_calendar(future), DEMAND, "y", _RICH, _rich_value
    )
    return made.select("series", day_text(), rounded("prediction", "prediction"))


@query(
    "m21_worst_errors",
    f"""
    WITH {_CV_SQL.format(alphas='0')}
    SELECT series, strftime(ds, '%Y-%m-%d') AS ds, round(abs(y - prediction), 6) AS abs_error
    FROM oof ORDER BY abs(y - prediction) DESC, series, ds LIMIT 5
    """,
)
def m21(spark, sf):
    scored = linear.out_of_fold_linear(model_rows(spark, sf), _TWO, "y", "ds")
    worst = evaluate.worst_errors(scored, "y", "prediction", 5, ["series", "ds"])
    return worst.select("series", day_text(), rounded("abs_error", "abs_error"))


# tree models: results depend on the algorithm's own choices, so there is no SQL twin

_TREE = ["dayofweek", "month", "lag_1", "lag_5", "rolling_mean_5"]
_SMALL_FOREST = {"numTrees": 10, "maxDepth": 4, "minInstancesPerNode": 5}
_SMALL_BOOST = {"maxIter": 10, "maxDepth": 3, "stepSize": 0.1}


@query("m7_random_forest")
def m7(spark, sf):
    train, test = _cut(tree_rows(spark, sf))
    model = trees.fit_forest(train, _TREE, "y", **_SMALL_FOREST)
    return trees.score_trees(test, model, _TREE).select("series", day_text(), "y", "prediction")


@query("m8_boosted_trees")
def m8(spark, sf):
    train, test = _cut(tree_rows(spark, sf))
    model = trees.fit_boosted(train, _TREE, "y", subsamplingRate=0.8, **_SMALL_BOOST)
    return trees.score_trees(test, model, _TREE).select("series", day_text(), "y", "prediction")


# A tree with one split, over all rows and features, has a closed form: of all cuts between
# neighbouring values the one that leaves the smallest squared error, with the mean on either side.
_STUMP = ["dayofweek", "month", "lag_1", "lag_5"]
_STUMP_ROWS_SQL = f"""{DEMAND_SQL},
feat AS (SELECT series, ds, CAST(y AS DOUBLE) AS y, isodow(ds) - 1 AS dayofweek, month(ds) AS month,
                lag(y, 1) OVER w AS lag_1, lag(y, 5) OVER w AS lag_5
         FROM demand WINDOW w AS (PARTITION BY series ORDER BY ds)),
clean AS (SELECT * FROM feat WHERE lag_5 IS NOT NULL)"""


def _stump_sql(rows: str, by: str) -> str:
    """The best cut for each ``by`` of the training rows."""
    long = " UNION ALL ".join(
        f"SELECT {by}, {i} AS feature, CAST({name} AS DOUBLE) AS x, y FROM {rows}" for i, name in enumerate(_STUMP)
    )
    return f"""long AS ({long}),
cells AS (SELECT {by}, feature, x, count(*) AS n, sum(y) AS s FROM long GROUP BY ALL),
cuts AS (SELECT {by}, feature, (x + lead(x) OVER w) / 2 AS threshold, sum(n) OVER w AS nl, sum(s) OVER w AS sl,
                sum(n) OVER (PARTITION BY {by}, feature) AS n, sum(s) OVER (PARTITION BY {by}, feature) AS s
         FROM cells WINDOW w AS (PARTITION BY {by}, feature ORDER BY x)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY
             round(sl * sl / nl + (s - sl) * (s - sl) / (n - nl), 6) DESC, feature, threshold) AS place
           FROM cuts WHERE threshold IS NOT NULL),
best AS (SELECT {by}, feature, threshold, sl / nl AS low, (s - sl) / (n - nl) AS high FROM ranked WHERE place = 1)"""


_ONE_STUMP_SQL = f"""WITH {_STUMP_ROWS_SQL},
train AS (SELECT 1 AS g, * FROM clean WHERE ds < DATE '{CUT}'), {_stump_sql("train", "g")}
SELECT feature, threshold, round(low, 6) AS low, round(high, 6) AS high FROM best"""
_WHOLE = {"featureSubsetStrategy": "all", "subsamplingRate": 1.0, "maxDepth": 1, "maxBins": 1024}


def _stump_rows(spark, model):
    ((_, ((feature, threshold, left, right, _), *rest)),) = trees.tree_nodes(model)
    values = [n[4] for n in rest]
    return spark.createDataFrame(
        [(feature, threshold, round(values[left - 1], 6), round(values[right - 1], 6))],
        "feature int, threshold double, low double, high double",
    )


@query("m7_forest_of_one_split", _ONE_STUMP_SQL)
def m7_stump(spark, sf):
    train, _ = _cut(tree_rows(spark, sf))
    return _stump_rows(spark, trees.fit_forest(train, _STUMP, "y", numTrees=1, bootstrap=False, **_WHOLE))


@query("m8_one_round_of_one_split", _ONE_STUMP_SQL)
def m8_stump(spark, sf):
    train, _ = _cut(tree_rows(spark, sf))
    return _stump_rows(spark, trees.fit_boosted(train, _STUMP, "y", maxIter=1, **_WHOLE))


@query(
    "m10_cross_validation_one_split",
    f"""
    WITH {_STUMP_ROWS_SQL}, {BLOCKS_SQL}, {_stump_sql("training", "fold")}
    SELECT CAST(fold AS INTEGER) AS fold, count(*) AS n, round(sqrt(avg(power(y - CASE WHEN
             CASE feature WHEN 0 THEN dayofweek WHEN 1 THEN month WHEN 2 THEN lag_1 ELSE lag_5 END <= threshold
             THEN low ELSE high END, 2))), 6) AS rmse
    FROM placed JOIN best ON best.fold = placed.block GROUP BY 1
    """,
)
def m10_stump(spark, sf):
    def fit(train, validation):
        model = trees.fit_forest(train, _STUMP, "y", numTrees=1, bootstrap=False, **_WHOLE)
        return lambda rows: trees.score_trees(rows, model, _STUMP)

    scores = evaluate.cross_validate(tree_rows(spark, sf), fit, "y", "ds")
    return scores.select("fold", "n", rounded("rmse", "rmse"))


@query("m9_stopping_by_tolerance")
def m9(spark, sf):
    """Rows before the cut train, rows after it decide when boosting stops."""
    train, test = _cut(tree_rows(spark, sf))
    model = trees.fit_boosted(
        train, _TREE, "y", validation=test, validationTol=0.01, maxIter=20, maxDepth=3
    )
    scored = trees.score_trees(test, model, _TREE)
    return scored.agg(
        F.lit(model.getNumTrees).alias("trees"), evaluate.rmse_of(F.col("y"), F.col("prediction")).alias("rmse")
    )


def _forest(params):
    def fit(train, validation):
        model = trees.fit_forest(train, _TREE, "y", **params)
        return lambda rows: trees.score_trees(rows, model, _TREE)

    return fit


@query("m10_stopping_by_tolerance_in_folds")
def m10_early_stopping(spark, sf):
    """Boosting that stops in every fold by the rows of that fold: rounds and error per fold."""

    def fit(train, validation):
        model = trees.fit_boosted(train, _TREE, "y", validation=validation, validationTol=0.01, maxIter=12, maxDepth=2)
        return lambda rows: trees.score_trees(rows, model, _TREE).withColumn("rounds", F.lit(model.getNumTrees))

    scored = evaluate.out_of_fold(tree_rows(spark, sf), fit, "ds", n_splits=3)
    return scored.groupBy("fold", "rounds").agg(
        F.count(F.lit(1)).alias("n"), evaluate.rmse_of(F.col("y"), F.col("prediction")).alias("rmse")
    )


@query("m10_cross_validation_forest")
def m10_forest(spark, sf):
    rows = tree_rows(spark, sf)
    scores = evaluate.cross_validate(rows, _forest(_SMALL_FOREST), "y", "ds", n_splits=3)
    return scores.select("fold", "n", "rmse")


@query("m14_forest_search")
def m14_forest(spark, sf):
    """Seeded random candidates, each judged on expanding folds."""
    space = {"numTrees": ("int", 3, 6), "maxDepth": ("int", 2, 4), "minInstancesPerNode": ("int", 1, 10)}
    candidates = evaluate.random_candidates(space, 2)
    return evaluate.search(
        spark, tree_rows(spark, sf), _forest, candidates, "y", "ds", n_splits=2
    )


@query("m15_tree_importance")
def m15_trees(spark, sf):
    model = trees.fit_boosted(tree_rows(spark, sf), _TREE, "y", **_SMALL_BOOST)
    return trees.importance_table(spark, model, _TREE)


def _forecast_by_trees(spark, sf, history, future, model, depth):
    """The walk with an ensemble, scored inside the JVM, bounded to the training range."""
    future = _future_calendar(future).withColumn("month", F.month("ds"))
    ensemble = trees.trees_frame(spark, model)
    limits = target_range(history, "y").select(
        F.col("low").cast("double").alias("low"), F.col("high").cast("double").alias("high")
    )
    made = forecast.recursive_forecast(
        history, future, DEMAND, "y", _TREE,
        lambda xs: trees.trees_value(F.col("trees"), F.array(*xs), depth),
        ensemble.select("trees", limits.select(F.struct("low", "high")).scalar().alias("bounds")),
        F.col("bounds.low"), F.col("bounds.high"),
    )
    return made.select("series", day_text(), "prediction")


@query("m18_recursive_forecast_trees")
def m18_trees(spark, sf):
    train, _ = _cut(tree_rows(spark, sf))
    history, future = _cut(demand(spark, sf))
    model = trees.fit_boosted(train, _TREE, "y", **_SMALL_BOOST)
    return _forecast_by_trees(spark, sf, history, future, model, _SMALL_BOOST["maxDepth"])


@query("m14_search_then_forecast")
def m14_then_forecast(spark, sf):
    """Search on the rows before the cut, refit with the best parameters, forecast what follows."""
    train, _ = _cut(tree_rows(spark, sf))
    history, future = _cut(demand(spark, sf))
    candidates = [{"numTrees": 3, "maxDepth": d} for d in (2, 3)]
    found = evaluate.search(spark, train, _forest, candidates, "y", "ds", n_splits=2)
    best = evaluate.best_params(found, candidates)
    return _forecast_by_trees(spark, sf, history, future, trees.fit_forest(train, _TREE, "y", **best), best["maxDepth"])
