"""All queries, and the flagship one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from demandkit.operators.groups import group_stats
from demandkit.operators.series import add_series_features
from demandkit.plans import aggregate_queries, category_queries, model_queries, scalar_queries, series_queries, stream_queries, tree_queries  # noqa: F401
from demandkit.plans.catalogue import QUERIES, TWINS, query
from demandkit.plans.derived import DEMAND, DEMAND_SQL, demand

__all__ = ["QUERIES", "TWINS", "flagship"]


@query(
    "flagship_weekday_lags",
    f"""
    WITH {DEMAND_SQL},
    feat AS (SELECT ds, y, lag(y, 1) OVER (PARTITION BY series ORDER BY ds) AS lag_1 FROM demand)
    SELECT CAST(isodow(ds) - 1 AS INTEGER) AS dayofweek, count(*) AS n_rows, count(lag_1) AS n,
           round(avg(lag_1), 6) AS mean, round(stddev_samp(lag_1), 6) AS std, min(lag_1) AS min,
           max(lag_1) AS max, median(lag_1) AS median
    FROM feat GROUP BY 1
    """,
)
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders to daily demand, to lags, to statistics of yesterday's demand per weekday."""
    featured = add_series_features(demand(spark, sf_dir), DEMAND, "y", ["lag_1"])
    per_day = featured.withColumn("dayofweek", F.weekday("ds"))
    stats = group_stats(per_day, ["dayofweek"], "lag_1", discrete=True)
    return stats.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})
