"""Queries over series windows, time folds and feature presets."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandkit.operators import evaluate, folds, series
from demandkit.operators.forecast import buffer_feature
from demandkit.plans import presets
from demandkit.plans.catalogue import day_text, query, rounded, table
from demandkit.plans.derived import (
    BLOCKS_SQL,
    CALENDAR_SQL,
    CUT,
    DEMAND,
    DEMAND_SQL,
    MODEL_SQL,
    SALES_SQL,
    SHOP,
    calendar,
    demand,
    model_rows,
    sales,
)

_W = "OVER (PARTITION BY series ORDER BY ds)"
_KEY = "SELECT series, strftime(ds, '%Y-%m-%d') AS ds"


def _trailing(n: int) -> str:
    return f"OVER (PARTITION BY series ORDER BY ds ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"


@query(
    "w1_lags",
    f"""WITH {DEMAND_SQL} {_KEY}, lag(y, 1) {_W} AS lag_1, lag(y, 5) {_W} AS lag_5, lag(y, 7) {_W} AS lag_7
    FROM demand""",
)
def w1(spark, sf):
    names = ["lag_1", "lag_5", "lag_7"]
    return series.add_series_features(demand(spark, sf), DEMAND, "y", names).select(
        "series", day_text(), *names
    )


@query(
    "w2_lag_with_series_mean",
    f"""
    WITH {DEMAND_SQL}, m AS (SELECT series, avg(y) AS m FROM demand WHERE ds < DATE '{CUT}' GROUP BY 1)
    SELECT d.series, strftime(ds, '%Y-%m-%d') AS ds, round(coalesce(lag_1, m), 6) AS lag_1,
           round(coalesce(lag_7, m), 6) AS lag_7
    FROM (SELECT *, lag(y, 1) {_W} AS lag_1, lag(y, 7) {_W} AS lag_7 FROM demand) d JOIN m USING (series)
    """,
)
def w2(spark, sf):
    rows, names = demand(spark, sf), ["lag_1", "lag_7"]
    train = rows.filter(F.col("ds") < F.lit(CUT).cast("date"))
    lagged = series.add_series_features(rows, DEMAND, "y", names)
    filled = series.fill_with_series_mean(lagged, train, DEMAND, "y", names)
    return filled.select("series", day_text(), *[rounded(c, c) for c in names])


@query(
    "w3_trailing_means",
    f"""WITH {DEMAND_SQL} {_KEY}, round(avg(y) {_trailing(5)}, 6) AS rolling_mean_5,
    round(avg(y) {_trailing(10)}, 6) AS rolling_mean_10 FROM demand""",
)
def w3(spark, sf):
    names = ["rolling_mean_5", "rolling_mean_10"]
    made = series.add_series_features(demand(spark, sf), DEMAND, "y", names)
    return made.select("series", day_text(), *[rounded(c, c) for c in names])


@query(
    "w4_full_window_mean",
    f"""WITH {DEMAND_SQL} {_KEY},
    round(CASE WHEN count(y) {_trailing(5)} >= 5 THEN avg(y) {_trailing(5)} END, 6) AS mean_5 FROM demand""",
)
def w4(spark, sf):
    made = series.with_trailing(
        demand(spark, sf), DEMAND, {"mean_5": series.trailing_mean("y", 5, full_window=True)}, 5
    )
    return made.select("series", day_text(), rounded("mean_5", "mean_5"))


@query(
    "w5_trailing_std",
    f"WITH {DEMAND_SQL} {_KEY}, round(stddev_samp(y) {_trailing(5)}, 6) AS rolling_std_5 FROM demand",
)
def w5(spark, sf):
    made = series.add_series_features(demand(spark, sf), DEMAND, "y", ["rolling_std_5"])
    return made.select("series", day_text(), rounded("rolling_std_5", "rolling_std_5"))


@query(
    "w6_differences",
    f"""WITH {DEMAND_SQL} {_KEY}, y - lag(y, 1) {_W} AS diff, lag(y, 1) {_W} - lag(y, 2) {_W} AS lag_diff
    FROM demand""",
)
def w6(spark, sf):
    made = series.with_trailing(
        demand(spark, sf),
        DEMAND,
        {"diff": series.difference("y"), "lag_diff": series.lagged_difference("y")},
        2,
    )
    return made.select("series", day_text(), "diff", "lag_diff")


@query(
    "w7_tail_buffers",
    f"""
    WITH {DEMAND_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY ds DESC) AS rn FROM demand)
    SELECT series, string_agg(CAST(y AS VARCHAR), ',' ORDER BY ds) AS buffer,
           CAST(max(y) FILTER (rn = 1) AS DOUBLE) AS last_value, round(avg(y) FILTER (rn <= 5), 6) AS tail_mean
    FROM r WHERE rn <= 10 GROUP BY 1
    """,
)
def w7(spark, sf):


    tails = series.tail_buffer(demand(spark, sf), DEMAND, "y", 10)
    whole = F.transform("buffer", lambda v: v.cast("long").cast("string"))
    return tails.select(
        "series",
        F.array_join(whole, ",").alias("buffer"),
        buffer_feature("lag_1", F.col("buffer")).alias("last_value"),
        rounded(buffer_feature("rolling_mean_5", F.col("buffer")), "tail_mean"),
    )


@query(
    "w8_positions",
    f"""
    WITH {DEMAND_SQL}, d AS (SELECT ds, row_number() OVER (ORDER BY ds) AS place FROM (SELECT DISTINCT ds FROM demand))
    SELECT series, strftime(ds, '%Y-%m-%d') AS ds, row_number() {_W} AS position, place
    FROM demand JOIN d USING (ds)
    """,
)
def w8(spark, sf):
    placed = series.with_position(demand(spark, sf), DEMAND)
    return series.with_date_position(placed, "ds", "place").select(
        "series", day_text(), "position", "place"
    )


@query(
    "w8_positions_of_one_instant",
    """
    SELECT l_returnflag, l_orderkey, l_linenumber,
           row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber) AS position
    FROM lineitem
    """,
)
def w8_instant(spark, sf):
    """All rows of a key at one time: the ties alone order and spread them."""
    rows = table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", F.lit("1995-01-01").cast("timestamp").alias("ts"))
    lines = series.Series(("l_returnflag",), "ts", daily=False, ties=("l_orderkey", "l_linenumber"))
    return series.with_position(rows, lines).drop("ts")


_EVENT_SERIES = series.Series(("event_type",), "ts", daily=False, ties=("event_id",))


@query(
    "w1_lags_of_raw_events",
    """
    SELECT event_id, row_number() OVER w AS position, lag(value, 1) OVER w AS lag_1, lag(value, 5) OVER w AS lag_5,
           round(avg(value) OVER (PARTITION BY event_type ORDER BY ts, event_id
                                  ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), 6) AS rolling_mean_5
    FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)
    """,
)
def w1_raw(spark, sf):
    """Long series of raw rows: numbered and windowed in stretches, never in one task."""
    rows = table(spark, sf, "events").select("event_id", "event_type", "ts", "value")
    names = ["lag_1", "lag_5", "rolling_mean_5"]
    numbered = series.with_position(rows, _EVENT_SERIES)
    made = series.add_series_features(numbered, _EVENT_SERIES, "value", names, "position")
    return made.select(
        "event_id", "position", "lag_1", "lag_5", rounded("rolling_mean_5", "rolling_mean_5")
    )


# folds


@query(
    "m1_time_folds",
    f"""
    WITH {MODEL_SQL}, {BLOCKS_SQL}
    SELECT series, strftime(ds, '%Y-%m-%d') AS ds, block FROM placed
    """,
)
def m1(spark, sf):
    return folds.time_folds(model_rows(spark, sf), "ds").select("series", day_text(), "block")


@query(
    "m1_fold_bounds",
    f"""
    WITH {MODEL_SQL}, {BLOCKS_SQL}
    SELECT CAST(fold AS INTEGER) AS fold, count(*) FILTER (block < fold) AS n_train,
           count(*) FILTER (block = fold) AS n_test,
           strftime(max(ds) FILTER (block < fold), '%Y-%m-%d') AS train_end,
           strftime(min(ds) FILTER (block = fold), '%Y-%m-%d') AS test_start,
           strftime(max(ds) FILTER (block = fold), '%Y-%m-%d') AS test_end
    FROM folds, placed GROUP BY 1
    """,
)
def m1_bounds(spark, sf):
    made = folds.fold_bounds(model_rows(spark, sf), "ds")
    return made.select("fold", "n_train", "n_test", *[day_text(c) for c in ["train_end", "test_start", "test_end"]])


@query(
    "m1_series_folds",
    f"""
    WITH {DEMAND_SQL}, p AS (
      SELECT *, row_number() {_W} - 1 AS pos, count(*) OVER (PARTITION BY series) AS n FROM demand)
    SELECT series, strftime(ds, '%Y-%m-%d') AS ds,
           CASE WHEN pos < n - 5 * (n // 6) THEN 0
                ELSE CAST((pos - (n - 5 * (n // 6))) // (n // 6) AS INTEGER) + 1 END AS block
    FROM p
    """,
)
def m1_series(spark, sf):
    return folds.series_folds(demand(spark, sf), DEMAND).select("series", day_text(), "block")


@query(
    "m2_random_holdout",
    """
    SELECT o_orderkey, CASE WHEN CAST('0x' || substr(md5('42:' || CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT)
                                  * (100.0 / 4294967296) < 20 THEN 1 ELSE 0 END AS held_out
    FROM orders
    """,
)
def m2(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", folds.holdout_flag(F.col("o_orderkey")).alias("held_out")
    )


@query(
    "a21_fold_errors",
    f"""
    WITH {MODEL_SQL}, {BLOCKS_SQL},
    f AS (SELECT block AS fold, count(*) AS n, sqrt(avg(power(y - rolling_mean_5, 2))) AS rmse
          FROM placed WHERE block > 0 GROUP BY 1)
    SELECT 'fold ' || fold AS part, n, round(rmse, 6) AS rmse FROM f
    UNION ALL SELECT 'mean', count(*), round(avg(rmse), 6) FROM f
    UNION ALL SELECT 'std', count(*), round(stddev_pop(rmse), 6) FROM f
    UNION ALL SELECT 'pooled', count(*), round(sqrt(sum(n * rmse * rmse) / sum(n)), 6) FROM f
    """,
)
def a21(spark, sf):
    """Errors of the trailing mean used as a forecast, per fold and over folds."""
    blocks = folds.time_folds(model_rows(spark, sf), "ds").filter("block > 0")
    per_fold = evaluate.rmse(
        blocks.withColumnRenamed("block", "fold"), "y", "rolling_mean_5", ["fold"]
    )
    summary = evaluate.fold_summary(per_fold)
    rows = [
        F.struct(F.lit(name).alias("part"), F.col("n_folds").alias("n"), F.col(c).alias("rmse"))
        for name, c in [("mean", "mean_rmse"), ("std", "std_rmse"), ("pooled", "pooled_rmse")]
    ]
    folded = per_fold.select(F.concat(F.lit("fold "), F.col("fold").cast("string")).alias("part"), "n", "rmse")
    made = folded.unionByName(summary.select(F.inline(F.array(*rows))))
    return made.select("part", "n", rounded("rmse", "rmse"))


# feature presets



def _has(column: str, *words: str) -> str:
    test = " OR ".join(f"contains({column}, '{w}')" for w in words)
    return f"CASE WHEN {test} THEN 1 ELSE 0 END"




def _mean_before(n: int, aggregate: str = "avg") -> str:
    frame = f"PARTITION BY shop ORDER BY ds ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING"
    return f"round({aggregate}(y) OVER ({frame}), 6)"


_WEEK_CODE = """CASE week WHEN '月' THEN 0 WHEN '火' THEN 1 WHEN '水' THEN 2 WHEN '木' THEN 3
    WHEN '金' THEN 4 WHEN '土' THEN 5 ELSE 6 END"""
_WEATHER_CODE = """CASE weather WHEN '快晴' THEN 0 WHEN '晴れ' THEN 1 WHEN '薄曇' THEN 2
    WHEN '雨' THEN 4 WHEN '雪' THEN 5 WHEN '雷電' THEN 6 ELSE 3 END"""
_SQL_FEATURES = {
    "year": "CAST(year(ds) AS INTEGER)",
    "month": "CAST(month(ds) AS INTEGER)",
    "day": "CAST(day(ds) AS INTEGER)",
    "dayofweek": "CAST(isodow(ds) - 1 AS INTEGER)",
    "weekday": "CAST(isodow(ds) AS INTEGER)",
    "weekofyear": "CAST(week(ds) AS INTEGER)",
    "temperature": "coalesce(temperature, med_t)",
    "temp_filled": "coalesce(temperature, med_t)",
    "kcal": "coalesce(kcal, med_k)",
    "kcal_filled": "coalesce(kcal, med_k)",
    "precipitation_num": "coalesce(TRY_CAST(nullif(precipitation, '--') AS DOUBLE), 0)",
    "precipitation": "coalesce(TRY_CAST(nullif(precipitation, '--') AS DOUBLE), 0)",
    "is_friday": "CASE WHEN isodow(ds) = 5 THEN 1 ELSE 0 END",
    "month_end": "CASE WHEN day(ds) > 20 THEN 1 ELSE 0 END",
    "is_beginning_of_month": "CASE WHEN day(ds) <= 10 THEN 1 ELSE 0 END",
    "is_middle_of_month": "CASE WHEN day(ds) BETWEEN 11 AND 20 THEN 1 ELSE 0 END",
    "is_end_of_month": "CASE WHEN day(ds) > 20 THEN 1 ELSE 0 END",
    "is_summer": "CASE WHEN month(ds) IN (7, 8) THEN 1 ELSE 0 END",
    "is_winter": "CASE WHEN month(ds) IN (12, 1, 2) THEN 1 ELSE 0 END",
    "month_sin": "round(sin(2 * pi() * month(ds) / 12), 6) + 0",
    "month_cos": "round(cos(2 * pi() * month(ds) / 12), 6) + 0",
    "is_bad_weather": "CASE WHEN weather IN ('雨', '雪', '雷電') THEN 1 ELSE 0 END",
    "is_rainy": "CASE WHEN weather IN ('雨', '雪', '雷電') THEN 1 ELSE 0 END",
    "is_bad_weather_cold": """CASE WHEN weather IN ('雨', '雪', '雷電') AND coalesce(temperature, med_t) < 15
        THEN 1 ELSE 0 END""",
    "week_enc": _WEEK_CODE,
    "week_encoded": _WEEK_CODE,
    "weather_enc": _WEATHER_CODE,
    "weather_encoded": _WEATHER_CODE,
    "is_special_menu": _has("remarks", "お楽しみ", "スペシャル"),
    "is_otanoshimi": _has("remarks", "お楽しみ", "スペシャル"),
    "is_curry": _has("name", "カレー"),
    "is_donburi": _has("name", "丼"),
    "is_friday_curry": "CASE WHEN isodow(ds) = 5 AND contains(name, 'カレー') THEN 1 ELSE 0 END",
    "remarks_flag": "CASE WHEN remarks IS NULL THEN 0 ELSE 1 END",
    "has_remarks": "CASE WHEN remarks IS NULL THEN 0 ELSE 1 END",
    "event": "CASE WHEN event IS NULL THEN 0 ELSE 1 END",
    "event_flag": "CASE WHEN event IS NULL THEN 0 ELSE 1 END",
    "payday": "coalesce(payday, 0)",
    "payday_flag": "CAST(coalesce(payday, 0) AS INTEGER)",
    "soldout": "soldout",
    "soldout_flag": "soldout",
    "is_holiday": "CASE WHEN ds IN (SELECT ds FROM calendar) THEN 1 ELSE 0 END",
    "is_next_holiday": "CASE WHEN ds + 1 IN (SELECT ds FROM calendar) THEN 1 ELSE 0 END",
    "week_month": "CAST((isodow(ds) - 1) * month(ds) AS INTEGER)",
    "week_payday": "(isodow(ds) - 1) * coalesce(payday, 0)",
    "temp_month": "round(coalesce(temperature, med_t) * month(ds), 6)",
    "lag_1": "lag(y, 1) OVER w",
    "lag_5": "lag(y, 5) OVER w",
    "lag_7": "lag(y, 7) OVER w",
    "rolling_mean_5": _mean_before(5),
    "rolling_mean_10": _mean_before(10),
    "rolling_std_5": _mean_before(5, "stddev_samp"),
    "lag_diff": "lag(y, 1) OVER w - lag(y, 2) OVER w",
}
_RAINY = "CASE WHEN TRY_CAST(nullif(precipitation, '--') AS DOUBLE) > 0 THEN 1 ELSE 0 END"
_SQL_OWN = {
    "holiday_11": {"is_bad_weather": _RAINY},
    "lagged_13": {"is_bad_weather": _RAINY},
    "published_4": {"is_otanoshimi": _has("remarks", "お楽しみ")},
    "compact_5": {"is_special_menu": _has("remarks", "お楽しみ", "料理長")},
    "full_25": {"is_special_menu": _has("remarks", "お楽しみ", "料理長")},
    "codes_9": {"is_otanoshimi": _has("remarks", "お楽しみ")},
    "codes_12": {"precipitation": "coalesce(TRY_CAST(nullif(precipitation, '--') AS DOUBLE), med_p)"},
    "cyclic_31": {"event_flag": "CASE WHEN event IS NOT NULL AND event <> '' THEN 1 ELSE 0 END"},
}
_PATTERNS = {
    "lean_15": presets.LEAN_PATTERNS,
    "wide": presets.WIDE_PATTERNS,
    "tuned": presets.TUNED_PATTERNS,
}


def _preset_sql(preset: str) -> str:
    own = _SQL_OWN.get(preset, {})
    made = []
    for feature in presets.PRESETS[preset]:
        if feature in own or feature in _SQL_FEATURES:
            text = own.get(feature, _SQL_FEATURES.get(feature))
        elif feature.startswith("week_"):
            text = f"CASE WHEN week = '{feature[5:]}' THEN 1 ELSE 0 END"
        elif feature.startswith("weather_"):
            text = f"CASE WHEN weather = '{feature[8:]}' THEN 1 ELSE 0 END"
        elif preset in _PATTERNS:
            pattern = _PATTERNS[preset][feature[5:]]
            text = f"CASE WHEN regexp_matches(name, '{pattern}') THEN 1 ELSE 0 END"
        else:
            text = _has("name", *presets.MENU_WORDS[feature[5:]])
        made.append(f'{text} AS "{feature}"')
    return f"""
    WITH {SALES_SQL}, {CALENDAR_SQL},
    med AS (SELECT median(kcal) AS med_k, median(temperature) AS med_t,
                   median(TRY_CAST(nullif(precipitation, '--') AS DOUBLE)) AS med_p
            FROM sales WHERE ds < DATE '{CUT}')
    SELECT shop, strftime(ds, '%Y-%m-%d') AS day_key, y, {", ".join(made)}
    FROM sales, med WINDOW w AS (PARTITION BY shop ORDER BY ds)
    """


def _register_preset(preset: str) -> None:
    @query(f"m22_features_{preset}", _preset_sql(preset))
    def run(spark, sf):
        rows = sales(spark, sf)
        train = rows.filter(F.col("ds") < F.lit(CUT).cast("date"))
        stats = presets.fit_preset(train, preset)
        made = presets.build_features(rows, preset, stats, SHOP, calendar=calendar(spark, sf))
        shaky = ["month_sin", "month_cos", "temp_month", "rolling_mean_5", "rolling_mean_10", "rolling_std_5"]
        made = made.withColumns({c: F.round(c, 6) + 0 for c in shaky if c in made.columns})
        return made.withColumn("day_key", F.date_format("ds", "yyyy-MM-dd")).drop("ds")


for _name in presets.PRESETS:
    _register_preset(_name)
