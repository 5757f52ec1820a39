"""Queries over profiles, grouped statistics, sorting, reshaping and imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandkit.functions import dates, scalars
from demandkit.operators import choose, groups, impute, profile, reshape
from demandkit.operators.quantiles import exact_quantiles
from demandkit.plans import presets
from demandkit.plans.catalogue import day_text, query, rounded, table
from demandkit.plans.derived import CUT, DEMAND_SQL, ONE_SERIES_SQL, SALES_SQL, demand, demand_all, sales


def _train_test(rows):
    cut = F.lit(CUT).cast("date")
    return rows.filter(F.col("ds") < cut), rows.filter(F.col("ds") >= cut)


def _orders_with_gaps(spark, sf):
    return table(spark, sf, "orders").selectExpr(
        "o_orderpriority",
        "o_orderdate",
        "o_custkey",
        "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS price",
    )


_GAPS_SQL = """gaps AS (
  SELECT o_orderpriority, o_orderdate, o_custkey,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS price
  FROM orders)"""


def _summary_sql(column: str) -> str:
    def nearest(p: float) -> str:
        return (
            f"list_sort(list({column}) FILTER ({column} IS NOT NULL))"
            f"[CAST(floor({p} * (count({column}) - 1) + 0.5) AS BIGINT) + 1]"
        )

    return f"""
    SELECT '{column}' AS "column", count({column}) AS "count", count(*) - count({column}) AS null_count,
           round(avg({column}), 4) AS mean, round(stddev_samp({column}), 4) AS std,
           CAST(min({column}) AS DOUBLE) AS min, CAST(max({column}) AS DOUBLE) AS max,
           CAST({nearest(0.25)} AS DOUBLE) AS q25, CAST({nearest(0.5)} AS DOUBLE) AS q50,
           CAST({nearest(0.75)} AS DOUBLE) AS q75
    FROM gaps"""


@query("a1_summary", f"WITH {_GAPS_SQL} {_summary_sql('price')} UNION ALL {_summary_sql('o_custkey')}")
def a1(spark, sf):
    made = profile.summary(_orders_with_gaps(spark, sf), ["price", "o_custkey"])
    return made.withColumns({"mean": F.round("mean", 4), "std": F.round("std", 4)})


_NULL_COLUMNS = ["kcal", "remarks", "event", "payday", "temperature", "y"]


@query(
    "a2_null_profile",
    f"WITH {SALES_SQL} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) - count({c}) AS null_count,
            round(100.0 * (count(*) - count({c})) / count(*), 6) AS null_percent FROM sales"""
        for c in _NULL_COLUMNS
    ),
)
def a2(spark, sf):
    made = profile.null_profile(sales(spark, sf), _NULL_COLUMNS)
    return made.withColumn("null_percent", F.round("null_percent", 6))


@query(
    "a2_columns_with_nulls",
    f"WITH {SALES_SQL} SELECT * FROM ("
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) - count({c}) AS null_count,
            round(100.0 * (count(*) - count({c})) / count(*), 6) AS null_percent FROM sales"""
        for c in _NULL_COLUMNS
    )
    + ") WHERE null_count > 0",
)
def a2_only(spark, sf):
    made = profile.null_profile(sales(spark, sf), _NULL_COLUMNS, only_nulls=True)
    return made.withColumn("null_percent", F.round("null_percent", 6))


@query(
    "a3_target_stats",
    f"""
    WITH {ONE_SERIES_SQL}
    SELECT round(avg(y), 6) AS mean, median(y) AS median, round(stddev_samp(y), 6) AS std,
           min(y) AS min, max(y) AS max FROM demand
    """,
)
def a3(spark, sf):
    made = profile.target_stats(demand_all(spark, sf), "y")
    return made.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})


@query(
    "a4_group_stats",
    """
    SELECT o_orderpriority, count(*) AS n_rows, count(o_totalprice) AS n, round(avg(o_totalprice), 4) AS mean,
           round(median(o_totalprice), 4) AS median, round(stddev_samp(o_totalprice), 4) AS std,
           min(o_totalprice) AS min, max(o_totalprice) AS max
    FROM orders GROUP BY 1
    """,
)
def a4(spark, sf):
    made = groups.group_stats(table(spark, sf, "orders"), ["o_orderpriority"], "o_totalprice")
    made = choose.sort_rows(made, "mean", ["o_orderpriority"], descending=True)
    return made.withColumns({c: F.round(c, 4) for c in ["mean", "median", "std"]})


@query(
    "a4_weekday_stats",
    f"""
    WITH {DEMAND_SQL}
    SELECT CAST(isodow(ds) - 1 AS INTEGER) AS dayofweek, count(*) AS n_rows, count(y) AS n,
           round(avg(y), 6) AS mean, median(y) AS median, round(stddev_samp(y), 6) AS std,
           min(y) AS min, max(y) AS max
    FROM demand GROUP BY 1
    """,
)
def a4_weekday(spark, sf):
    rows = demand(spark, sf).withColumn("dayofweek", dates.weekday(F.col("ds")))
    # daily counts repeat, so the median comes from the value histogram of the same pass
    made = groups.group_stats(rows, ["dayofweek"], "y", discrete=True)
    return made.withColumns({c: F.round(c, 6) for c in ["mean", "std"]})


@query(
    "a5_rows_and_values",
    f"""
    WITH {SALES_SQL}
    SELECT weather, count(*) AS n_rows, count(kcal) AS n_values FROM sales GROUP BY 1
    """,
)
def a5(spark, sf):
    return sales(spark, sf).groupBy("weather").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("kcal").alias("n_values")
    )


@query(
    "a6_flag_means",
    f"WITH {SALES_SQL} SELECT soldout, round(avg(y), 6) AS mean, count(*) AS n_rows FROM sales GROUP BY 1",
)
def a6(spark, sf):
    made = groups.mean_and_count(sales(spark, sf), ["soldout"], "y")
    return made.select("soldout", rounded("mean", "mean"), "n_rows")


@query(
    "a7_rate_by_group",
    """
    SELECT o_orderpriority, count(*) AS n_rows, count(*) FILTER (o_orderstatus = 'F') AS hits,
           round(100.0 * count(*) FILTER (o_orderstatus = 'F') / count(*), 6) AS rate
    FROM orders GROUP BY 1
    UNION ALL
    SELECT 'overall', count(*), count(*) FILTER (o_orderstatus = 'F'),
           round(100.0 * count(*) FILTER (o_orderstatus = 'F') / count(*), 6)
    FROM orders
    """,
)
def a7(spark, sf):
    orders, hit = table(spark, sf, "orders"), F.col("o_orderstatus") == "F"
    overall = groups.rate_by(orders, hit).withColumn("o_orderpriority", F.lit("overall"))
    made = groups.rate_by(orders, hit, ["o_orderpriority"]).unionByName(overall)
    return made.withColumn("rate", F.round("rate", 6))


@query(
    "a8_presence_comparison",
    f"""
    WITH {SALES_SQL}
    SELECT CASE WHEN remarks IS NOT NULL THEN 1 ELSE 0 END AS present, count(*) AS n_rows, round(avg(y), 6) AS mean
    FROM sales GROUP BY 1
    """,
)
def a8(spark, sf):
    made = groups.presence_comparison(sales(spark, sf), "remarks", "y")
    return made.withColumn("mean", F.round("mean", 6))


@query(
    "a9_label_frequency",
    f"""
    WITH {SALES_SQL}
    SELECT remarks, count(*) AS n_rows, round(avg(kcal), 6) AS mean, median(kcal) AS median
    FROM sales WHERE remarks IS NOT NULL GROUP BY 1
    """,
)
def a9(spark, sf):
    made = groups.label_frequency(sales(spark, sf), "remarks", "kcal")
    return made.withColumn("mean", F.round("mean", 6))


@query(
    "a10_monthly_mean",
    f"WITH {DEMAND_SQL} SELECT CAST(month(ds) AS INTEGER) AS month, round(avg(y), 6) AS mean FROM demand GROUP BY 1",
)
def a10(spark, sf):
    return groups.monthly_mean(demand(spark, sf), "ds", "y").withColumn("mean", F.round("mean", 6))


@query(
    "a11_two_key_mean",
    f"""
    WITH {SALES_SQL}
    SELECT remarks, weather, round(avg(y), 6) AS mean FROM sales
    WHERE remarks IS NOT NULL AND weather IS NOT NULL GROUP BY 1, 2
    """,
)
def a11(spark, sf):
    made = groups.two_key_mean(sales(spark, sf), "remarks", "weather", "y")
    return made.withColumn("mean", F.round("mean", 6))


@query(
    "a11_two_key_mean_wide",
    f"""
    WITH {DEMAND_SQL}
    SELECT CAST(month(ds) AS INTEGER) AS month, """
    + ", ".join(f"round(avg(y) FILTER (isodow(ds) - 1 = {d}), 6) AS day_{d}" for d in range(7))
    + " FROM demand GROUP BY 1",
)
def a11_wide(spark, sf):
    rows = demand(spark, sf).withColumns({"month": F.month("ds"), "dayofweek": F.weekday("ds")})
    made = groups.two_key_mean_wide(rows, "month", "dayofweek", range(7), "y", "day")
    return made.withColumns({f"day_{d}": F.round(f"day_{d}", 6) for d in range(7)})


@query(
    "a12_two_way_counts",
    "SELECT o_orderpriority, o_orderstatus, count(*) AS n_rows FROM orders GROUP BY 1, 2",
)
def a12(spark, sf):
    return groups.two_way_counts(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus")


_CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "a13_correlations",
    "WITH m AS (SELECT * FROM lineitem) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM m" for a in _CORR for b in _CORR
    ),
)
def a13(spark, sf):
    made = profile.correlations(table(spark, sf, "lineitem"), _CORR)
    return made.withColumn("r", F.round("r", 6))


_SALES_CORR = ["y", "kcal", "temperature"]


def _corr_sql(relation: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM {relation}"
        for a in _SALES_CORR
        for b in _SALES_CORR
    )


@query(
    "a13_correlations_imputed",
    f"""
    WITH {SALES_SQL}, med AS (SELECT median(kcal) AS k, median(temperature) AS t FROM sales),
    m AS (SELECT y, coalesce(kcal, k) AS kcal, coalesce(temperature, t) AS temperature FROM sales, med)
    {_corr_sql("m")}
    """,
)
def a13_imputed(spark, sf):
    made = profile.correlations(sales(spark, sf), _SALES_CORR, nulls="impute")
    return made.withColumn("r", F.round("r", 6))


@query(
    "a13_correlations_complete",
    f"""
    WITH {SALES_SQL}, m AS (SELECT * FROM sales WHERE kcal IS NOT NULL AND temperature IS NOT NULL)
    {_corr_sql("m")}
    """,
)
def a13_complete(spark, sf):
    made = profile.correlations(sales(spark, sf), _SALES_CORR, nulls="complete")
    return made.withColumn("r", F.round("r", 6))


@query(
    "a14_target_correlations",
    """
    SELECT * FROM (
      SELECT 'l_quantity' AS "column", round(corr(l_quantity, l_extendedprice), 6) AS r FROM lineitem
      UNION ALL SELECT 'l_discount', round(corr(l_discount, l_extendedprice), 6) FROM lineitem
      UNION ALL SELECT 'l_tax', round(corr(l_tax, l_extendedprice), 6) FROM lineitem)
    ORDER BY abs(r) DESC LIMIT 2
    """,
)
def a14(spark, sf):
    made = profile.target_correlations(
        table(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", top=2
    )
    return made.withColumn("r", F.round("r", 6))


def _bins_sql(relation: str, column: str, max_bins: int, by: str = "") -> str:
    key = f"{by}, " if by else ""
    return f"""
    lim AS (SELECT min({column}) AS lo, max({column}) AS hi FROM {relation}),
    raw AS (SELECT (hi - lo) / {max_bins} AS r, floor(log10((hi - lo) / {max_bins})) AS p FROM lim),
    step AS (SELECT CASE WHEN r / power(10, p) <= 1 THEN 1 WHEN r / power(10, p) <= 2 THEN 2
                         WHEN r / power(10, p) <= 5 THEN 5 ELSE 10 END * power(10, p) AS w FROM raw)
    SELECT {key}CAST(floor({column} / w) * w AS DOUBLE) AS bin_start,
           CAST((floor({column} / w) + 1) * w AS DOUBLE) AS bin_end, count(*) AS n
    FROM {relation}, step WHERE {column} IS NOT NULL GROUP BY ALL"""


@query("a15_histogram", "WITH " + _bins_sql("lineitem", "l_extendedprice", 30))
def a15(spark, sf):
    return profile.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 30)


@query("a15_histogram_by_label", f"WITH {_GAPS_SQL}, " + _bins_sql("gaps", "price", 20, "o_orderpriority"))
def a15_by(spark, sf):
    return profile.histogram(_orders_with_gaps(spark, sf), "price", 20, ["o_orderpriority"])


_BOX_SQL = """fences AS (
  SELECT {key} AS k, quantile_cont({y}, 0.25) AS q1, quantile_cont({y}, 0.5) AS median,
         quantile_cont({y}, 0.75) AS q3 FROM {rel} GROUP BY 1),
fenced AS (
  SELECT r.*, q1, median, q3, {y} >= q1 - 1.5 * (q3 - q1) AND {y} <= q3 + 1.5 * (q3 - q1) AS inside
  FROM {rel} r JOIN fences ON r.{key} = fences.k)"""


@query(
    "a16_box_stats",
    f"""
    WITH {DEMAND_SQL}, {_BOX_SQL.format(key="series", y="y", rel="demand")}
    SELECT series, q1, median, q3, min(y) FILTER (inside) AS low_whisker, max(y) FILTER (inside) AS high_whisker,
           count(*) FILTER (NOT inside) AS n_outliers
    FROM fenced GROUP BY 1, 2, 3, 4
    """,
)
def a16(spark, sf):
    return profile.box_stats(demand(spark, sf), ["series"], "y", discrete=True)


@query(
    "a16_box_outliers",
    f"""
    WITH {SALES_SQL}, {_BOX_SQL.format(key="weather", y="y", rel="sales")}
    SELECT shop, strftime(ds, '%Y-%m-%d') AS ds, weather, y FROM fenced WHERE NOT inside
    """,
)
def a16_outliers(spark, sf):
    rows = sales(spark, sf).select("shop", "ds", "weather", "y")
    return profile.box_outliers(rows, ["weather"], "y").select("shop", day_text(), "weather", "y")


@query(
    "a17_daily_line",
    """
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS ds, count(*) AS y FROM orders GROUP BY 1
    """,
)
def a17(spark, sf):
    line = profile.daily_line(table(spark, sf, "orders"), "o_orderdate", F.count(F.lit(1)))
    return line.select(day_text(), "y")


@query(
    "a18_scatter",
    f"""
    WITH {SALES_SQL}
    SELECT temperature, kcal, shop, strftime(ds, '%Y-%m-%d') AS ds FROM sales
    WHERE kcal IS NOT NULL AND temperature > 0
    """,
)
def a18(spark, sf):
    points = profile.scatter(
        sales(spark, sf), "temperature", "kcal", ["shop", "ds"], positive="temperature"
    )
    return points.select("temperature", "kcal", "shop", day_text())


@query(
    "a4_quartiles_of_event_times",
    """
    SELECT event_type, count(*) AS n, quantile_cont(CAST(epoch(ts) AS DOUBLE), 0.25) AS q25,
           quantile_cont(CAST(epoch(ts) AS DOUBLE), 0.5) AS q50, quantile_cont(CAST(epoch(ts) AS DOUBLE), 0.75) AS q75
    FROM (SELECT event_type, date_trunc('second', ts) AS ts FROM events) e GROUP BY 1
    """,
)
def a4_times(spark, sf):
    """Values in a narrow band far from zero."""
    seconds = F.unix_timestamp(F.date_trunc("second", "ts")).cast("double")
    events = table(spark, sf, "events").select("event_type", seconds.alias("second"))
    made = exact_quantiles(events, ["second"], [0.25, 0.5, 0.75], ["event_type"])
    return made.select("event_type", "n", *[F.col("q")[i].alias(f"q{p}") for i, p in enumerate((25, 50, 75))])


@query(
    "a18_scatter_sample",
    """
    SELECT l_quantity, l_extendedprice, l_orderkey, l_linenumber FROM lineitem
    WHERE CAST('0x' || substr(md5('7:' || CAST(l_orderkey AS VARCHAR)), 1, 8) AS BIGINT) * (100.0 / 4294967296) < 10
    """,
)
def a18_sample(spark, sf):
    """A sampling operator: about a tenth of the orders, the same ones on every run."""
    return profile.scatter(
        table(spark, sf, "lineitem"),
        "l_quantity",
        "l_extendedprice",
        ["l_orderkey", "l_linenumber"],
        sample_key="l_orderkey",
        sample_percent=10.0,
        seed=7,
    )


@query(
    "a19_prediction_summary",
    f"""
    WITH {DEMAND_SQL}
    SELECT count(*) AS n, round(avg(y * 0.5), 6) AS mean, round(stddev_pop(y * 0.5), 6) AS std,
           CAST(min(y * 0.5) AS DOUBLE) AS min, CAST(max(y * 0.5) AS DOUBLE) AS max FROM demand
    """,
)
def a19(spark, sf):
    predicted = demand(spark, sf).withColumn("prediction", F.col("y") * F.lit(0.5))
    made = profile.prediction_summary(predicted, "prediction")
    return made.withColumns({c: F.round(c, 6) for c in ["mean", "std"]})


@query(
    "a20_target_range",
    f"WITH {ONE_SERIES_SQL} SELECT min(y) AS low, max(y) AS high, round(avg(y), 6) AS mean FROM demand",
)
def a20(spark, sf):
    return profile.target_range(demand_all(spark, sf), "y").withColumn("mean", F.round("mean", 6))


@query(
    "a22_nulls_after_cleaning",
    f"""
    WITH {SALES_SQL}
    SELECT CAST(0 AS BIGINT) AS nulls_after, CAST(sum(CASE WHEN kcal IS NULL THEN 1 ELSE 0 END
           + CASE WHEN temperature IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nulls_before
    FROM sales
    """,
)
def a22(spark, sf):
    rows, wanted = sales(spark, sf), ["kcal", "temperature"]
    cleaned = impute.apply_impute(rows, impute.fit_impute(rows, {c: "median" for c in wanted}))
    after = profile.total_nulls(profile.require_no_nulls(cleaned, wanted), wanted)
    before = profile.total_nulls(rows, wanted)
    return after.select(F.col("nulls").alias("nulls_after"), before.scalar().alias("nulls_before"))


# sorting and choosing


@query(
    "o1_sort",
    f"""
    WITH {SALES_SQL}
    SELECT shop, strftime(ds, '%Y-%m-%d') AS ds, kcal FROM sales ORDER BY kcal DESC NULLS LAST, shop, ds
    """,
)
def o1(spark, sf):
    ordered = choose.sort_rows(sales(spark, sf), "kcal", ["shop", "ds"], descending=True)
    return ordered.select("shop", day_text(), "kcal")


@query(
    "o2_top_k",
    """
    SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
    ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 20
    """,
)
def o2(spark, sf):
    top = choose.top_k(
        table(spark, sf, "lineitem"), "l_extendedprice", 20, ["l_orderkey", "l_linenumber"]
    )
    return top.select("l_orderkey", "l_linenumber", "l_extendedprice")


@query(
    "o3_declared_order",
    f"""
    WITH {SALES_SQL}
    SELECT week, count(*) AS n, CASE week WHEN '月' THEN 1 WHEN '火' THEN 2 WHEN '水' THEN 3
           WHEN '木' THEN 4 WHEN '金' THEN 5 ELSE 6 END AS place
    FROM sales GROUP BY 1
    """,
)
def o3(spark, sf):
    counted = sales(spark, sf).groupBy("week").agg(F.count(F.lit(1)).alias("n"))
    ordered = choose.order_by_list(counted, "week", presets.WEEK_DAYS)
    return ordered.withColumn("place", choose.declared_position(F.col("week"), presets.WEEK_DAYS))


@query(
    "o4_best_row",
    f"""
    WITH {DEMAND_SQL}
    SELECT series, strftime(arg_min(ds, (y, ds)), '%Y-%m-%d') AS ds, min(y) AS y FROM demand GROUP BY 1
    """,
)
def o4(spark, sf):
    return choose.best_row(demand(spark, sf), "y", "ds", ["series"]).select("series", day_text(), "y")


# reshaping


def _hot_sql(column: str, values: list, prefix: str) -> str:
    return ", ".join(
        f"CASE WHEN {column} = '{v}' THEN 1 ELSE 0 END AS \"{prefix}_{v}\"" for v in values
    )


_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("r1_one_hot_learned", f"SELECT p_partkey, {_hot_sql('p_type', _TYPES, 'type')} FROM part")
def r1(spark, sf):
    part = table(spark, sf, "part")
    categories = reshape.learn_categories(part, "p_type", 100)
    return reshape.add_one_hot(part.select("p_partkey", "p_type"), "p_type", categories, "type").drop("p_type")


@query(
    "r2_one_hot_fixed",
    f"""
    WITH {SALES_SQL}
    SELECT shop, strftime(ds, '%Y-%m-%d') AS ds, {_hot_sql('weather', presets.WEATHER, 'weather')} FROM sales
    """,
)
def r2(spark, sf):
    rows = sales(spark, sf).select("shop", day_text(), "weather")
    return reshape.add_one_hot(rows, "weather", presets.WEATHER).drop("weather")


@query(
    "r3_align_columns",
    f"""
    WITH {SALES_SQL}
    SELECT shop, strftime(ds, '%Y-%m-%d') AS ds, CASE WHEN weather = '雪' THEN 1 ELSE 0 END AS snow,
           0 AS storm, CASE WHEN weather = '雨' THEN 1 ELSE 0 END AS rain
    FROM sales WHERE ds >= DATE '{CUT}'
    """,
)
def r3(spark, sf):
    train, test = _train_test(sales(spark, sf))
    snow = scalars.flag(F.col("weather") == "雪").alias("snow")
    storm = scalars.flag(F.col("weather") == "雷電").alias("storm")
    rain = scalars.flag(F.col("weather") == "雨").alias("rain")
    _, aligned = reshape.align_columns(
        train.select("shop", "ds", "y", snow, storm), test.select("shop", "ds", rain, snow), target="y"
    )
    return aligned.select("shop", day_text(), "snow", "storm", "rain")


@query(
    "r4_melt",
    f"""
    WITH {SALES_SQL}
    SELECT shop, strftime(ds, '%Y-%m-%d') AS ds, 'kcal' AS variable, kcal AS value FROM sales
    UNION ALL SELECT shop, strftime(ds, '%Y-%m-%d'), 'temperature', temperature FROM sales
    """,
)
def r4(spark, sf):
    rows = sales(spark, sf).select("shop", day_text(), "kcal", "temperature")
    return reshape.melt(rows, ["shop", "ds"], ["kcal", "temperature"])


@query(
    "r5_results_as_rows",
    f"""
    WITH {DEMAND_SQL}
    SELECT CAST(isodow(ds) - 1 AS VARCHAR) AS model, round(avg(y), 6) AS mean, max(y) AS max
    FROM demand GROUP BY 1
    """,
)
def r5(spark, sf):
    """One row per result, without a way through the driver."""
    per_day = demand(spark, sf).groupBy(F.weekday("ds").cast("string").alias("model"))
    return per_day.agg(rounded(F.avg("y"), "mean"), F.max("y").alias("max"))


@query(
    "r6_standardise",
    f"""
    WITH {DEMAND_SQL}, s AS (SELECT avg(y) AS m, stddev_pop(y) AS sd FROM demand WHERE ds < DATE '{CUT}')
    SELECT series, strftime(ds, '%Y-%m-%d') AS ds, round((y - m) / sd, 6) AS y FROM demand, s
    """,
)
def r6(spark, sf):
    rows = demand(spark, sf)
    train, _ = _train_test(rows)
    scaled = reshape.apply_scaler(rows, reshape.fit_scaler(train, ["y"]), ["y"])
    return scaled.select("series", day_text(), rounded("y", "y"))


@query(
    "r7_stack_history_and_future",
    f"""
    WITH {DEMAND_SQL}
    SELECT series, strftime(ds, '%Y-%m-%d') AS ds, CASE WHEN ds < DATE '{CUT}' THEN y END AS y,
           CASE WHEN ds < DATE '{CUT}' THEN 0 ELSE 1 END AS is_future
    FROM demand
    """,
)
def r7(spark, sf):
    train, test = _train_test(demand(spark, sf))
    return reshape.stack_history(train, test.drop("y")).select("series", day_text(), "y", "is_future")


# imputation


def _imputed(spark, sf, how, columns):
    train, _ = _train_test(sales(spark, sf))
    rows = sales(spark, sf)
    filled = impute.apply_impute(rows, impute.fit_impute(train, how))
    return filled.select("shop", day_text(), *columns)


@query(
    "i1_impute_median",
    f"""
    WITH {SALES_SQL}, s AS (SELECT median(kcal) AS k, median(temperature) AS t FROM sales WHERE ds < DATE '{CUT}')
    SELECT shop, strftime(ds, '%Y-%m-%d') AS ds, coalesce(kcal, k) AS kcal, coalesce(temperature, t) AS temperature
    FROM sales, s
    """,
)
def i1(spark, sf):
    return _imputed(spark, sf, {"kcal": "median", "temperature": "median"}, ["kcal", "temperature"])


@query(
    "i2_impute_mean",
    f"""
    WITH {SALES_SQL}, s AS (SELECT avg(kcal) AS k FROM sales WHERE ds < DATE '{CUT}')
    SELECT shop, strftime(ds, '%Y-%m-%d') AS ds, round(coalesce(kcal, k), 6) AS kcal FROM sales, s
    """,
)
def i2(spark, sf):
    made = _imputed(spark, sf, {"kcal": "mean"}, ["kcal"])
    return made.withColumn("kcal", F.round("kcal", 6))


@query(
    "i3_impute_constant",
    f"""
    WITH {SALES_SQL}
    SELECT shop, strftime(ds, '%Y-%m-%d') AS ds, coalesce(payday, 0) AS payday,
           coalesce(remarks, 'None') AS remarks FROM sales
    """,
)
def i3(spark, sf):
    return _imputed(spark, sf, {"payday": 0.0, "remarks": "None"}, ["payday", "remarks"])


@query(
    "i4_sentinel_policies",
    f"""
    WITH {SALES_SQL},
    n AS (SELECT *, TRY_CAST(CASE WHEN precipitation = '--' THEN '0' ELSE precipitation END AS DOUBLE) AS z,
                 TRY_CAST(CASE WHEN precipitation = '--' THEN NULL ELSE precipitation END AS DOUBLE) AS u
          FROM sales),
    s AS (SELECT median(u) AS m FROM n WHERE ds < DATE '{CUT}')
    SELECT shop, strftime(ds, '%Y-%m-%d') AS ds, z AS as_zero, coalesce(u, m) AS as_unknown FROM n, s
    """,
)
def i4(spark, sf):
    rain = F.col("precipitation")
    rows = sales(spark, sf).withColumns(
        {
            "as_zero": scalars.sentinel_number(rain, presets.SENTINELS, "zero"),
            "as_unknown": scalars.sentinel_number(rain, presets.SENTINELS, "null"),
        }
    )
    train, _ = _train_test(rows)
    filled = impute.apply_impute(rows, impute.fit_impute(train, {"as_unknown": "median"}))
    return filled.select("shop", day_text(), "as_zero", "as_unknown")


@query(
    "i5_impute_group_median",
    f"""
    WITH {SALES_SQL}, s AS (SELECT shop, median(kcal) AS k FROM sales WHERE ds < DATE '{CUT}' GROUP BY 1)
    SELECT sales.shop, strftime(ds, '%Y-%m-%d') AS ds, coalesce(kcal, k) AS kcal
    FROM sales JOIN s ON s.shop = sales.shop
    """,
)
def i5(spark, sf):
    rows = sales(spark, sf)
    train, _ = _train_test(rows)
    stats = impute.fit_impute(train, {"kcal": "median"}, ["shop"])
    return impute.apply_impute(rows, stats, ["shop"]).select("shop", day_text(), "kcal")
