"""Relations the queries share, derived from the given tables, with their SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from demandkit.operators.groups import daily_series
from demandkit.operators.series import Series, add_series_features
from demandkit.plans.catalogue import table

CUT = "2001-06-01"
DEMAND = Series(("series",), "ds")
SHOP = Series(("shop",), "ds")

DEMAND_SQL = """demand AS (
  SELECT o_orderpriority AS series, CAST(o_orderdate AS DATE) AS ds, count(*) AS y
  FROM orders GROUP BY 1, 2)"""

ONE_SERIES_SQL = """demand AS (
  SELECT 'all' AS series, CAST(o_orderdate AS DATE) AS ds, count(*) AS y
  FROM orders GROUP BY 1, 2)"""

# Attributes of a sales day, from the smallest (a) and largest (b) customer key of the day.
# The tables hold no nulls, so the sparse columns are derived here.
_SALES_COLUMNS = {
    "soldout": "CASE WHEN b % 3 = 0 THEN 1 ELSE 0 END",
    "name": """CASE a % 9 WHEN 0 THEN 'チキンカレー' WHEN 1 THEN '白身魚フライ'
        WHEN 2 THEN '和風ハンバーグ' WHEN 3 THEN '鶏の唐揚げ' WHEN 4 THEN '親子丼'
        WHEN 5 THEN '豚肉の生姜焼' WHEN 6 THEN '野菜炒め' WHEN 7 THEN '鮭の塩焼'
        ELSE 'さんま' END""",
    "kcal": "CASE WHEN a % 5 = 0 THEN NULL ELSE CAST(350 + b % 120 AS DOUBLE) END",
    "remarks": """CASE b % 10 WHEN 0 THEN 'お楽しみメニュー' WHEN 1 THEN '料理長のこだわりメニュー'
        WHEN 2 THEN 'スペシャルメニュー' WHEN 3 THEN '手作りの味' END""",
    "event": "CASE a % 7 WHEN 0 THEN 'ママの会' WHEN 1 THEN '' END",
    "payday": "CASE WHEN day(ds) = 10 THEN CAST(1 AS DOUBLE) END",
    "weather": """CASE a % 8 WHEN 0 THEN '快晴' WHEN 1 THEN '晴れ' WHEN 2 THEN '曇'
        WHEN 3 THEN '薄曇' WHEN 4 THEN '雨' WHEN 5 THEN '雪' WHEN 6 THEN '雷電'
        ELSE '霧' END""",
    "precipitation": """CASE WHEN b % 4 <> 0 THEN '--' WHEN b % 20 = 0 THEN 'trace'
        WHEN b % 8 = 0 THEN '0.5' ELSE '2' END""",
    "temperature": "CASE WHEN b % 13 = 0 THEN NULL ELSE CAST(a % 300 AS DOUBLE) / 10 END",
}
_WEEK = """CASE {} WHEN 0 THEN '月' WHEN 1 THEN '火' WHEN 2 THEN '水' WHEN 3 THEN '木'
        WHEN 4 THEN '金' WHEN 5 THEN '土' ELSE '日' END"""

SALES_SQL = (
    """sales AS (
  SELECT shop, ds, y, """
    + _WEEK.format("isodow(ds) - 1")
    + " AS week, "
    + ", ".join(f"{text} AS {name}" for name, text in _SALES_COLUMNS.items())
    + """ FROM (
    SELECT o_orderpriority AS shop, CAST(o_orderdate AS DATE) AS ds, count(*) AS y,
           min(o_custkey) AS a, max(o_custkey) AS b
    FROM orders GROUP BY 1, 2))"""
)

CALENDAR_SQL = """calendar AS (
  SELECT DISTINCT make_date(year(o_orderdate), m, d) AS ds
  FROM orders, (VALUES (1, 1), (7, 4), (12, 25)) AS v(m, d))"""

# One row per series and day with the two features the linear queries use.
MODEL_SQL = f"""{DEMAND_SQL},
feat AS (
  SELECT series, ds, y, lag(y, 1) OVER w AS lag_1,
         avg(y) OVER (PARTITION BY series ORDER BY ds ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS rolling_mean_5
  FROM demand WINDOW w AS (PARTITION BY series ORDER BY ds)),
clean AS (
  SELECT series, ds, CAST(y AS DOUBLE) AS y, CAST(lag_1 AS DOUBLE) AS lag_1, rolling_mean_5
  FROM feat WHERE lag_1 IS NOT NULL)"""

BLOCKS_SQL = """days AS (
  SELECT ds, row_number() OVER (ORDER BY ds) - 1 AS pos, count(*) OVER () AS n
  FROM (SELECT DISTINCT ds FROM clean)),
blocks AS (
  SELECT ds, CASE WHEN pos < n - 5 * (n // 6) THEN 0
                  ELSE CAST((pos - (n - 5 * (n // 6))) // (n // 6) AS INTEGER) + 1 END AS block
  FROM days),
placed AS (SELECT clean.*, block FROM clean JOIN blocks USING (ds)),
folds AS (SELECT unnest(range(1, 6)) AS fold),
training AS (SELECT fold, p.* FROM folds JOIN placed p ON p.block < fold)"""


def demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderpriority", "series")
    return daily_series(orders, "o_orderdate", ["series"])


def demand_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("series", F.lit("all"))
    return daily_series(orders, "o_orderdate", ["series"])


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sales per shop with the columns of the lunch-sales schema."""
    orders = table(spark, sf_dir, "orders")
    days = orders.groupBy(
        F.col("o_orderpriority").alias("shop"), F.col("o_orderdate").cast("date").alias("ds")
    ).agg(
        F.count(F.lit(1)).alias("y"),
        F.min("o_custkey").alias("a"),
        F.max("o_custkey").alias("b"),
    )
    return days.selectExpr(
        "shop",
        "ds",
        "y",
        _WEEK.format("weekday(ds)") + " AS week",
        *[f"{text} AS {name}" for name, text in _SALES_COLUMNS.items()],
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """1 January, 4 July and 25 December of every year with orders."""
    years = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year")).distinct()
    days = F.explode(
        F.array(*[F.make_date("year", F.lit(m), F.lit(d)) for m, d in [(1, 1), (7, 4), (12, 25)]])
    )
    return years.select(days.alias("ds"))


def model_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demand with ``lag_1`` and ``rolling_mean_5``, without the first day of each series."""
    featured = add_series_features(demand(spark, sf_dir), DEMAND, "y", ["lag_1", "rolling_mean_5"])
    return featured.dropna(subset=["lag_1"])


def tree_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Demand with calendar and series features, for the tree models."""
    featured = add_series_features(
        demand(spark, sf_dir), DEMAND, "y", ["lag_1", "lag_5", "rolling_mean_5"]
    )
    return featured.withColumns(
        {"dayofweek": F.weekday("ds"), "month": F.month("ds")}
    ).dropna()
