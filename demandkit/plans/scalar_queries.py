"""Queries over scans, scalar expressions, dates and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from demandkit.functions import columns, dates, encode, scalars, text
from demandkit.operators.calendar import with_holidays
from demandkit.operators.impute import apply_impute, fit_impute
from demandkit.operators.joins import lookup_join, missing_keys, with_expected
from demandkit.plans.catalogue import day_text, query, rounded, table
from demandkit.plans.derived import (
    CALENDAR_SQL,
    CUT,
    DEMAND_SQL,
    ONE_SERIES_SQL,
    SALES_SQL,
    calendar,
    demand,
    demand_all,
    sales,
)
from demandkit.plans import presets
from demandkit.session import new_folder
from demandkit.sources import sinks, tables

# sources and sinks


@query("s1_csv_scan", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def s1(spark, sf):
    """Write a headed CSV and read it back with a declared schema."""
    path = new_folder(spark, "customer-csv")
    sinks.write_features(
        table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"), path, "csv"
    )
    schema = StructType(
        [
            StructField("c_custkey", LongType()),
            StructField("c_name", StringType()),
            StructField("c_mktsegment", StringType()),
        ]
    )
    return tables.read_table(spark, path, schema)


@query(
    "s2_null_sentinel_scan",
    """
    SELECT l_linenumber, count(*) AS n_rows, count(tax) AS n_known,
           round(sum(tax), 6) AS total
    FROM (SELECT l_linenumber,
                 TRY_CAST(NULLIF(CASE WHEN l_linenumber % 3 = 0 THEN '--' ELSE CAST(l_tax AS VARCHAR) END, '--') AS DOUBLE) AS tax
          FROM lineitem) t
    GROUP BY l_linenumber
    """,
)
def s2(spark, sf):
    """CSV text with a sentinel, scanned as numbers."""
    path = new_folder(spark, "tax-csv")
    source = table(spark, sf, "lineitem").selectExpr(
        "l_linenumber",
        "CASE WHEN l_linenumber % 3 = 0 THEN '--' ELSE cast(l_tax AS string) END AS tax",
    )
    sinks.write_features(source, path, "csv")
    scanned = tables.read_table(
        spark, path, StructType.fromDDL("l_linenumber int, tax double"), null_values=["--"]
    )
    return scanned.groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("tax").alias("n_known"), rounded(F.sum("tax"), "total")
    )


@query(
    "s3_submission_frame",
    f"""
    WITH {ONE_SERIES_SQL}
    SELECT strftime(ds, '%Y-%-m-%-d') AS datetime, CAST(round_even(y * 0.5, 0) AS BIGINT) AS y
    FROM demand
    """,
)
def s3(spark, sf):
    predicted = demand_all(spark, sf).withColumn("prediction", F.col("y") * 0.5)
    return sinks.submission_frame(predicted, "ds", "prediction")


@query(
    "s3_submission_file",
    f"""
    WITH {ONE_SERIES_SQL}
    SELECT strftime(ds, '%Y-%-m-%-d') AS datetime, CAST(y * 0.25 AS DOUBLE) AS y FROM demand
    """,
)
def s3_file(spark, sf):
    """The headerless file, written and read back."""
    path = new_folder(spark, "submission")
    predicted = demand_all(spark, sf).withColumn("prediction", F.col("y") * 0.25)
    sinks.write_submission(predicted, path, "ds", "prediction", integer=False)
    return spark.read.schema("datetime string, y double").csv(path)


@query(
    "s4_feature_table",
    f"""
    WITH {DEMAND_SQL}
    SELECT series, CAST(month(ds) AS INTEGER) AS month, count(*) AS n, CAST(sum(y) AS BIGINT) AS y
    FROM demand GROUP BY 1, 2
    """,
)
def s4(spark, sf):
    """A feature table partitioned by series, written and read back."""
    path = new_folder(spark, "features")
    featured = demand(spark, sf).withColumns(dates.date_parts(F.col("ds")))
    sinks.write_features(featured, path, partition_by=["series"])
    return spark.read.parquet(path).groupBy("series", "month").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("y"))


@query("s5_shape", "SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_columns FROM lineitem")
def s5(spark, sf):
    return tables.shape(table(spark, sf, "lineitem"))


@query("s6_head", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 10")
def s6(spark, sf):
    return tables.head(
        table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), 10, ["o_orderkey"]
    )


# projection, filters, scalars


@query(
    "p1_select_expressions",
    """SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS net FROM lineitem""",
)
def p1(spark, sf):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", rounded(net, "net", 4))


@query("p2_select_numeric", "SELECT p_partkey, p_size, p_retailprice FROM part")
def p2(spark, sf):
    return columns.select_numeric(table(spark, sf, "part"))


@query("p3_select_available", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def p3(spark, sf):
    customer = table(spark, sf, "customer")
    kept = columns.feature_columns(customer, ["c_name", "c_mktsegment"])
    wanted = ["c_custkey", "c_missing", "c_nationkey", "c_acctbal"]
    return customer.select(columns.available(customer.select(*kept), wanted))


@query(
    "p4_add_columns",
    """SELECT s_suppkey, s_nationkey + 1 AS s_nationkey, round(s_acctbal * 2, 4) AS doubled FROM supplier""",
)
def p4(spark, sf):
    changed = table(spark, sf, "supplier").withColumns(
        {"s_nationkey": F.col("s_nationkey") + 1, "doubled": F.round(F.col("s_acctbal") * 2, 4)}
    )
    return changed.select("s_suppkey", "s_nationkey", "doubled")


@query(
    "p5_comparison_filter",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 250000",
)
def p5(spark, sf):
    kept = table(spark, sf, "orders").filter(
        (F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 250000)
    )
    return kept.select("o_orderkey", "o_totalprice")


@query(
    "p6_null_filter",
    f"""
    WITH {SALES_SQL}
    SELECT shop, strftime(ds, '%Y-%m-%d') AS ds, remarks FROM sales
    WHERE remarks IS NOT NULL AND kcal IS NULL
    """,
)
def p6(spark, sf):
    kept = sales(spark, sf).filter(F.col("remarks").isNotNull() & F.col("kcal").isNull())
    return kept.select("shop", day_text(), "remarks")


@query(
    "p7_drop_nulls",
    f"""
    WITH {SALES_SQL}
    SELECT 'subset' AS rule, count(*) AS n FROM sales WHERE kcal IS NOT NULL AND temperature IS NOT NULL
    UNION ALL
    SELECT 'any', count(*) FROM sales
    WHERE kcal IS NOT NULL AND temperature IS NOT NULL AND remarks IS NOT NULL
      AND event IS NOT NULL AND payday IS NOT NULL
    """,
)
def p7(spark, sf):
    rows = sales(spark, sf)

    def counted(df, rule):
        return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(rule).alias("rule"), "n")

    return counted(rows.dropna(subset=["kcal", "temperature"]), "subset").unionByName(
        counted(rows.dropna(), "any")
    )


@query(
    "p8_membership_flag",
    f"""
    WITH {SALES_SQL}
    SELECT shop, strftime(ds, '%Y-%m-%d') AS ds,
           CASE WHEN weather IN ('雨', '雪', '雷電') THEN 1 ELSE 0 END AS is_bad_weather,
           CASE WHEN remarks IN ('お楽しみメニュー') THEN 1 ELSE 0 END AS is_fun
    FROM sales
    """,
)
def p8(spark, sf):
    return sales(spark, sf).select(
        "shop",
        day_text(),
        scalars.member_flag(F.col("weather"), presets.BAD_WEATHER).alias("is_bad_weather"),
        scalars.member_flag(F.col("remarks"), ["お楽しみメニュー"]).alias("is_fun"),
    )


@query(
    "p9_conjunction_flags",
    f"""
    WITH {SALES_SQL}
    SELECT shop, strftime(ds, '%Y-%m-%d') AS ds,
           CASE WHEN isodow(ds) = 5 AND name LIKE '%カレー%' THEN 1 ELSE 0 END AS is_friday_curry,
           CASE WHEN weather IN ('雨', '雪', '雷電') AND temperature < 15 THEN 1 ELSE 0 END AS is_bad_cold
    FROM sales
    """,
)
def p9(spark, sf):
    friday_curry = scalars.all_flag(F.weekday("ds") == 4, F.col("name").contains(presets.CURRY))
    bad_cold = scalars.all_flag(
        F.col("weather").isin(presets.BAD_WEATHER), F.col("temperature") < presets.COLD_BELOW
    )
    return sales(spark, sf).select(
        "shop", day_text(), friday_curry.alias("is_friday_curry"), bad_cold.alias("is_bad_cold")
    )


@query(
    "p10_case_label",
    f"""
    WITH {SALES_SQL}
    SELECT CASE WHEN remarks IS NULL THEN '通常メニュー'
                WHEN remarks LIKE '%お楽しみ%' THEN 'お楽しみメニュー'
                WHEN remarks LIKE '%料理長%' THEN '料理長のこだわり'
                ELSE 'その他特別' END AS menu_type, count(*) AS n
    FROM sales GROUP BY 1
    """,
)
def p10(spark, sf):
    label = scalars.case_label(
        F.col("remarks"), presets.MENU_TYPES, presets.MENU_TYPE_OTHER, presets.MENU_TYPE_NORMAL
    )
    return sales(spark, sf).groupBy(label.alias("menu_type")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "p11_presence_flag",
    f"""
    WITH {SALES_SQL}
    SELECT shop, strftime(ds, '%Y-%m-%d') AS ds,
           CASE WHEN event IS NOT NULL THEN 1 ELSE 0 END AS has_event,
           CASE WHEN event IS NOT NULL AND event <> '' THEN 1 ELSE 0 END AS has_named_event
    FROM sales
    """,
)
def p11(spark, sf):
    return sales(spark, sf).select(
        "shop",
        day_text(),
        scalars.presence_flag(F.col("event")).alias("has_event"),
        scalars.presence_flag(F.col("event"), non_empty=True).alias("has_named_event"),
    )


@query(
    "p12_presence_label",
    f"""
    WITH {SALES_SQL}
    SELECT CASE WHEN remarks IS NOT NULL THEN 'with' ELSE 'without' END AS label, count(*) AS n
    FROM sales GROUP BY 1
    """,
)
def p12(spark, sf):
    label = scalars.presence_label(F.col("remarks"), "with", "without").alias("label")
    return sales(spark, sf).groupBy(label).agg(F.count(F.lit(1)).alias("n"))


@query(
    "p13_placeholder_columns",
    f"""
    WITH {DEMAND_SQL}
    SELECT series, strftime(ds, '%Y-%m-%d') AS ds, CAST(NULL AS DOUBLE) AS lag_1, CAST(0 AS DOUBLE) AS lag_5
    FROM demand WHERE ds >= DATE '{CUT}'
    """,
)
def p13(spark, sf):
    future = demand(spark, sf).filter(F.col("ds") >= F.lit(CUT).cast("date")).drop("y")
    return columns.add_missing(future, {"lag_1": None, "lag_5": 0}).select(
        "series", day_text(), "lag_1", "lag_5"
    )


@query(
    "p14_percent",
    """
    SELECT o_orderpriority, round(100.0 * count(*) FILTER (o_orderstatus = 'F') / count(*), 6) AS rate,
           round(100.0 * (count(*) - count(*) FILTER (o_orderstatus = 'F')) / count(*), 6) AS improvement
    FROM orders GROUP BY 1
    """,
)
def p14(spark, sf):
    counted = table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("hits")
    )
    return counted.select(
        "o_orderpriority",
        rounded(scalars.percent(F.col("hits"), F.col("n")), "rate"),
        rounded(scalars.improvement_percent(F.col("n"), F.col("hits")), "improvement"),
    )


@query(
    "p15_clip",
    """
    SELECT c_custkey, greatest(c_acctbal, 0) AS at_least_zero,
           least(greatest(c_acctbal, 1000), 5000) AS in_range
    FROM customer
    """,
)
def p15(spark, sf):
    balance = F.col("c_acctbal")
    return table(spark, sf, "customer").select(
        "c_custkey",
        scalars.clip(balance, 0.0).alias("at_least_zero"),
        scalars.clip(balance, 1000.0, 5000.0).alias("in_range"),
    )


@query(
    "p16_round_half_even",
    """SELECT l_orderkey, l_linenumber, CAST(round_even(l_quantity / 2, 0) AS BIGINT) AS half FROM lineitem""",
)
def p16(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", scalars.round_even(F.col("l_quantity") / 2).alias("half")
    )


@query(
    "p17_round_digits",
    """SELECT p_partkey, round(p_retailprice / 3, 2) AS third FROM part""",
)
def p17(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", F.round(F.col("p_retailprice") / 3, 2).alias("third")
    )


@query(
    "p18_strict_cast",
    f"""
    WITH {SALES_SQL}
    SELECT shop, strftime(ds, '%Y-%m-%d') AS ds, CAST(temperature AS BIGINT) AS degrees,
           CAST(y AS VARCHAR) AS y_text
    FROM (SELECT shop, ds, y, floor(temperature) AS temperature FROM sales)
    """,
)
def p18(spark, sf):
    return sales(spark, sf).select(
        "shop",
        day_text(),
        F.floor("temperature").cast("bigint").alias("degrees"),
        F.col("y").cast("string").alias("y_text"),
    )


@query(
    "p19_coercing_cast",
    f"""
    WITH {SALES_SQL}
    SELECT shop, strftime(ds, '%Y-%m-%d') AS ds, TRY_CAST(precipitation AS DOUBLE) AS rain FROM sales
    """,
)
def p19(spark, sf):
    return sales(spark, sf).select(
        "shop", day_text(), scalars.parse_number(F.col("precipitation")).alias("rain")
    )


@query(
    "p20_fill_constant",
    f"""
    WITH {SALES_SQL}
    SELECT shop, strftime(ds, '%Y-%m-%d') AS ds, coalesce(payday, 0) AS payday,
           coalesce(remarks, 'None') AS remarks, coalesce(event, '') AS event
    FROM sales
    """,
)
def p20(spark, sf):
    filled = sales(spark, sf).fillna({"payday": 0.0, "remarks": "None", "event": ""})
    return filled.select("shop", day_text(), "payday", "remarks", "event")


@query(
    "p21_replace_value",
    f"""
    WITH {SALES_SQL}
    SELECT shop, strftime(ds, '%Y-%m-%d') AS ds,
           CASE WHEN precipitation = '--' THEN '0' ELSE precipitation END AS precipitation
    FROM sales
    """,
)
def p21(spark, sf):
    replaced = scalars.replace_value(F.col("precipitation"), "--", "0")
    return sales(spark, sf).select("shop", day_text(), replaced.alias("precipitation"))


@query(
    "p22_replace_first",
    "SELECT p_partkey, regexp_replace(p_name, 'l', 'L') AS p_name FROM part",
)
def p22(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", scalars.replace_first(F.col("p_name"), "l", "L").alias("p_name")
    )


@query(
    "p23_map_values",
    f"""
    WITH {SALES_SQL}
    SELECT shop, strftime(ds, '%Y-%m-%d') AS ds,
           CASE week WHEN '月' THEN 0 WHEN '火' THEN 1 WHEN '水' THEN 2 WHEN '木' THEN 3 WHEN '金' THEN 4
                     WHEN '土' THEN 5 WHEN '日' THEN 6 END AS week_enc,
           CASE weather WHEN '快晴' THEN 0 WHEN '晴れ' THEN 1 WHEN '薄曇' THEN 2 WHEN '曇' THEN 3
                        WHEN '雨' THEN 4 WHEN '雪' THEN 5 WHEN '雷電' THEN 6 ELSE 3 END AS weather_enc,
           CASE remarks WHEN 'お楽しみメニュー' THEN 1 END AS fun
    FROM sales
    """,
)
def p23(spark, sf):
    return sales(spark, sf).select(
        "shop",
        day_text(),
        scalars.map_values(F.col("week"), presets.WEEK_CODES, scalars.RAISE).alias("week_enc"),
        scalars.map_values(F.col("weather"), presets.WEATHER_CODES, presets.WEATHER_DEFAULT).alias(
            "weather_enc"
        ),
        scalars.map_values(F.col("remarks"), {"お楽しみメニュー": 1}).alias("fun"),
    )


@query(
    "p24_interactions",
    f"""
    WITH {SALES_SQL}
    SELECT shop, strftime(ds, '%Y-%m-%d') AS ds,
           CAST((isodow(ds) - 1) * month(ds) AS INTEGER) AS week_month,
           (isodow(ds) - 1) * coalesce(payday, 0) AS week_payday,
           round(temperature * month(ds), 6) AS temp_month
    FROM sales
    """,
)
def p24(spark, sf):
    weekday, month = dates.weekday(F.col("ds")), F.month("ds")
    return sales(spark, sf).select(
        "shop",
        day_text(),
        (weekday * month).alias("week_month"),
        (weekday * F.coalesce(F.col("payday"), F.lit(0.0))).alias("week_payday"),
        rounded(F.col("temperature") * month, "temp_month"),
    )


@query(
    "p25_cyclical",
    f"""
    WITH {DEMAND_SQL}
    SELECT series, strftime(ds, '%Y-%m-%d') AS ds,
           round(sin(2 * pi() * month(ds) / 12), 6) + 0 AS month_sin,
           round(cos(2 * pi() * month(ds) / 12), 6) + 0 AS month_cos
    FROM demand
    """,
)
def p25(spark, sf):
    sine, cosine = scalars.cyclical(F.month("ds"), 12)
    return demand(spark, sf).select(
        "series",
        day_text(),
        (F.round(sine, 6) + 0).alias("month_sin"),
        (F.round(cosine, 6) + 0).alias("month_cos"),
    )


@query(
    "p26_contains_flag",
    f"""
    WITH {SALES_SQL}
    SELECT shop, strftime(ds, '%Y-%m-%d') AS ds,
           CASE WHEN name LIKE '%カレー%' THEN 1 ELSE 0 END AS is_curry,
           CASE WHEN remarks LIKE '%お楽しみ%' THEN 1 ELSE 0 END AS is_fun
    FROM sales
    """,
)
def p26(spark, sf):
    return sales(spark, sf).select(
        "shop",
        day_text(),
        text.contains_flag(F.col("name"), presets.CURRY).alias("is_curry"),
        text.contains_flag(F.col("remarks"), presets.FUN_MENU).alias("is_fun"),
    )


def _pattern_sql(patterns: dict[str, str], column: str) -> str:
    return ", ".join(
        f"CASE WHEN regexp_matches({column}, '{pattern}') THEN 1 ELSE 0 END AS menu_{name}"
        for name, pattern in patterns.items()
    )


@query(
    "p27_pattern_flags",
    f"""
    WITH {SALES_SQL}
    SELECT shop, strftime(ds, '%Y-%m-%d') AS ds, {_pattern_sql(presets.WIDE_PATTERNS, 'name')} FROM sales
    """,
)
def p27(spark, sf):
    flags = text.pattern_flags(F.col("name"), presets.WIDE_PATTERNS, "menu_")
    return sales(spark, sf).select("shop", day_text(), *[c.alias(n) for n, c in flags.items()])


_PART_WORDS = {"warm": ["red", "old"], "metal": ["anvil", "bolt", "ring"]}


@query(
    "p28_keyword_flags",
    """
    SELECT p_partkey,
           CASE WHEN contains(p_name, 'red') OR contains(p_name, 'old') THEN 1 ELSE 0 END AS has_warm,
           CASE WHEN contains(p_name, 'anvil') OR contains(p_name, 'bolt') OR contains(p_name, 'ring')
                THEN 1 ELSE 0 END AS has_metal
    FROM part
    """,
)
def p28(spark, sf):
    flags = text.keyword_flags(F.col("p_name"), _PART_WORDS, "has_")
    return table(spark, sf, "part").select("p_partkey", *[c.alias(n) for n, c in flags.items()])


@query(
    "p29_keyword_tags",
    f"""
    WITH {SALES_SQL}
    SELECT shop, strftime(ds, '%Y-%m-%d') AS ds,
           concat_ws(',', CASE WHEN regexp_matches(name, 'カレー') THEN 'curry' END,
                     CASE WHEN regexp_matches(name, 'フライ|カツ|唐揚げ') THEN 'fry' END,
                     CASE WHEN regexp_matches(name, 'ハンバーグ') THEN 'hamburg' END) AS tags
    FROM sales
    """,
)
def p29(spark, sf):
    tags = text.keyword_tags(F.col("name"), presets.TAG_PATTERNS)
    return sales(spark, sf).select("shop", day_text(), F.array_join(tags, ",").alias("tags"))


@query("p30_rename", "SELECT n_nationkey AS nation, n_name AS label FROM nation")
def p30(spark, sf):
    renamed = table(spark, sf, "nation").withColumnsRenamed({"n_nationkey": "nation", "n_name": "label"})
    return renamed.select("nation", "label")


@query(
    "p31_side_by_side_columns",
    f"""
    WITH {SALES_SQL}
    SELECT shop, strftime(ds, '%Y-%m-%d') AS ds, y, CASE WHEN week = '月' THEN 1 ELSE 0 END AS week_1,
           CASE WHEN weather = '雨' THEN 1 ELSE 0 END AS weather_1
    FROM sales
    """,
)
def p31(spark, sf):
    """Derived frames of the same rows are columns of one select, not a join."""
    week = encode.one_hot(F.col("week"), ["月"], "week").values()
    weather = encode.one_hot(F.col("weather"), ["雨"], "weather").values()
    return sales(spark, sf).select(
        "shop",
        day_text(),
        "y",
        *[c.alias(f"week_{i}") for i, c in enumerate(week, 1)],
        *[c.alias(f"weather_{i}") for i, c in enumerate(weather, 1)],
    )


@query(
    "p32_row_sum",
    f"""
    WITH {SALES_SQL}
    SELECT shop, strftime(ds, '%Y-%m-%d') AS ds,
           round(coalesce(kcal, 0) + coalesce(temperature, 0) + coalesce(payday, 0), 6) AS total
    FROM sales
    """,
)
def p32(spark, sf):
    total = scalars.row_sum([F.col(c) for c in ["kcal", "temperature", "payday"]])
    return sales(spark, sf).select("shop", day_text(), rounded(total, "total"))


@query(
    "p33_absolute_error",
    f"""
    WITH {DEMAND_SQL}
    SELECT series, strftime(ds, '%Y-%m-%d') AS ds,
           round(abs(y - avg(y) OVER (PARTITION BY series)), 6) AS abs_error
    FROM demand
    """,
)
def p33(spark, sf):
    rows = demand(spark, sf)
    means = rows.groupBy("series").agg(F.avg("y").alias("mean"))
    scored = lookup_join(rows, means, ["series"])
    error = scalars.absolute_error(F.col("y"), F.col("mean"))
    return scored.select("series", day_text(), rounded(error, "abs_error"))


@query(
    "p34_column_list_table",
    f"""
    WITH {SALES_SQL}
    SELECT 'kcal' AS feature, 'number' AS category, count(kcal) AS n FROM sales
    UNION ALL SELECT 'temperature', 'number', count(temperature) FROM sales
    UNION ALL SELECT 'remarks', 'text', count(remarks) FROM sales
    UNION ALL SELECT 'event', 'text', count(event) FROM sales
    """,
)
def p34(spark, sf):
    """A declared list of columns with categories, as a table with their counts."""
    listed = {"kcal": "number", "temperature": "number", "remarks": "text", "event": "text"}
    counts = sales(spark, sf).agg(*[F.count(c).alias(c) for c in listed])
    rows = [
        F.struct(F.lit(c).alias("feature"), F.lit(kind).alias("category"), F.col(c).alias("n"))
        for c, kind in listed.items()
    ]
    return counts.select(F.inline(F.array(*rows)))


# dates


@query(
    "d1_parse_date",
    """
    SELECT CAST(strptime(strftime(o_orderdate, '%Y-%-m-%-d'), '%Y-%m-%d') AS DATE)::VARCHAR AS ds, count(*) AS n
    FROM orders GROUP BY 1
    """,
)
def d1(spark, sf):
    unpadded = table(spark, sf, "orders").select(F.date_format("o_orderdate", "yyyy-M-d").alias("d"))
    parsed = unpadded.select(dates.parse_date(F.col("d")).alias("ds"))
    return parsed.groupBy("ds").agg(F.count(F.lit(1)).alias("n")).select(day_text(), "n")


def _date_query(name, expressions, sql):
    @query(
        name,
        f"WITH {DEMAND_SQL} SELECT series, strftime(ds, '%Y-%m-%d') AS ds, {sql} FROM demand",
    )
    def run(spark, sf):
        made = expressions(F.col("ds"))
        return demand(spark, sf).select("series", day_text(), *[c.alias(n) for n, c in made.items()])

    return run


_date_query(
    "d2_date_parts",
    dates.date_parts,
    "CAST(year(ds) AS INTEGER) AS year, CAST(month(ds) AS INTEGER) AS month, CAST(day(ds) AS INTEGER) AS day",
)
_date_query(
    "d3_weekday",
    lambda d: {"dayofweek": dates.weekday(d)},
    "CAST(isodow(ds) - 1 AS INTEGER) AS dayofweek",
)
_date_query(
    "d4_iso_weekday", lambda d: {"weekday": dates.iso_weekday(d)}, "CAST(isodow(ds) AS INTEGER) AS weekday"
)
_date_query(
    "d5_iso_week", lambda d: {"weekofyear": dates.iso_week(d)}, "CAST(week(ds) AS INTEGER) AS weekofyear"
)
_date_query(
    "d6_month_third_flags",
    dates.month_third_flags,
    """CASE WHEN day(ds) <= 10 THEN 1 ELSE 0 END AS is_beginning_of_month,
       CASE WHEN day(ds) BETWEEN 11 AND 20 THEN 1 ELSE 0 END AS is_middle_of_month,
       CASE WHEN day(ds) > 20 THEN 1 ELSE 0 END AS is_end_of_month""",
)
_date_query(
    "d7_weekday_flag",
    lambda d: {"is_friday": dates.weekday_flag(d)},
    "CASE WHEN isodow(ds) = 5 THEN 1 ELSE 0 END AS is_friday",
)
_date_query(
    "d8_season_flags",
    dates.season_flags,
    """CASE WHEN month(ds) IN (7, 8) THEN 1 ELSE 0 END AS is_summer,
       CASE WHEN month(ds) IN (12, 1, 2) THEN 1 ELSE 0 END AS is_winter""",
)
_date_query(
    "d9_add_days",
    lambda d: {"next_day": F.date_format(dates.add_days(d, 1), "yyyy-MM-dd")},
    "strftime(ds + 1, '%Y-%m-%d') AS next_day",
)
_date_query(
    "d10_unpadded_date",
    lambda d: {"label": dates.unpadded_date(d)},
    "strftime(ds, '%Y-%-m-%-d') AS label",
)


@query(
    "d11_holiday_flags",
    f"""
    WITH {DEMAND_SQL}, {CALENDAR_SQL}
    SELECT series, strftime(ds, '%Y-%m-%d') AS ds, y,
           CASE WHEN ds IN (SELECT ds FROM calendar) THEN 1 ELSE 0 END AS is_holiday,
           CASE WHEN ds + 1 IN (SELECT ds FROM calendar) THEN 1 ELSE 0 END AS is_next_holiday
    FROM demand
    """,
)
def d11(spark, sf):
    flagged = with_holidays(demand(spark, sf), "ds", calendar(spark, sf))
    return flagged.select("series", day_text(), "y", "is_holiday", "is_next_holiday")


# lookups


@query(
    "j1_dimension_lookup",
    """
    SELECT c_custkey, n_name, r_name FROM customer
    LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
    """,
)
def j1(spark, sf):
    nation = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name", F.col("n_regionkey").alias("r_regionkey")
    )
    region = table(spark, sf, "region").select("r_regionkey", "r_name")
    with_nation = lookup_join(table(spark, sf, "customer"), nation, ["c_nationkey"])
    return lookup_join(with_nation, region, ["r_regionkey"]).select("c_custkey", "n_name", "r_name")


@query(
    "j2_statistics_of_train_on_test",
    f"""
    WITH {SALES_SQL}, stats AS (
      SELECT quantile_cont(kcal, 0.5) AS kcal, quantile_cont(temperature, 0.5) AS temperature
      FROM sales WHERE ds < DATE '{CUT}')
    SELECT shop, strftime(ds, '%Y-%m-%d') AS ds, coalesce(s.kcal, stats.kcal) AS kcal,
           coalesce(s.temperature, stats.temperature) AS temperature
    FROM sales s, stats WHERE ds >= DATE '{CUT}'
    """,
)
def j2(spark, sf):
    rows = sales(spark, sf)
    cut = F.lit(CUT).cast("date")
    stats = fit_impute(rows.filter(F.col("ds") < cut), {"kcal": "median", "temperature": "median"})
    filled = apply_impute(rows.filter(F.col("ds") >= cut), stats)
    return filled.select("shop", day_text(), "kcal", "temperature")


@query(
    "j3_expected_and_missing_days",
    f"""
    WITH {DEMAND_SQL}, {CALENDAR_SQL}, d AS (SELECT DISTINCT ds FROM demand)
    SELECT 'present' AS side, strftime(ds, '%Y-%m-%d') AS ds FROM d WHERE ds IN (SELECT ds FROM calendar)
    UNION ALL
    SELECT 'missing', strftime(ds, '%Y-%m-%d') FROM calendar WHERE ds NOT IN (SELECT ds FROM d)
    """,
)
def j3(spark, sf):
    days, expected = demand(spark, sf).select("ds").distinct(), calendar(spark, sf)
    present = with_expected(days, expected, ["ds"]).select(F.lit("present").alias("side"), day_text())
    missing = missing_keys(expected, days, ["ds"]).select(F.lit("missing").alias("side"), day_text())
    return present.unionByName(missing)
