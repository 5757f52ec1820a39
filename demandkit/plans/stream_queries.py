"""Queries that run a stream over the event table to its end."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandkit.plans.catalogue import day_text, query, rounded, table
from demandkit.session import new_folder
from demandkit.streaming import daily

# Days are closed one day after the newest event: the watermark of an append-mode stream.
_CLOSED_SQL = """closed AS (
  SELECT event_type, CAST(ts AS DATE) AS ds, count(*) AS y FROM events
  GROUP BY 1, 2
  HAVING CAST(ts AS DATE) + INTERVAL 2 DAY <= (SELECT max(ts) FROM events))"""

_STREAM_FEATURES = ["lag_1", "lag_5", "rolling_mean_5", "rolling_std_5", "lag_diff"]


def _closed_days(spark, path):
    events = daily.read_stream(spark, path)
    stream = daily.daily_demand_stream(events, "ts", ["event_type"], "1 day")
    return daily.run_available(stream, "daily")


@query(
    "x1_daily_demand_stream",
    f"WITH {_CLOSED_SQL} SELECT event_type, strftime(ds, '%Y-%m-%d') AS ds, y FROM closed",
)
def x1(spark, sf):
    return spark.read.parquet(_closed_days(spark, f"{sf}/events.parquet")).select("event_type", day_text(), "y")


@query(
    "x1_daily_demand_many_files",
    f"WITH {_CLOSED_SQL} SELECT event_type, strftime(ds, '%Y-%m-%d') AS ds, y FROM closed",
)
def x1_many_files(spark, sf):
    """The events as a table of part files, dealt by hash: no file is older than another."""
    folder = new_folder(spark, "events")
    events = table(spark, sf, "events").select("event_id", "ts", "event_type")
    events.repartition(8, "event_id").write.parquet(folder)
    return spark.read.parquet(_closed_days(spark, folder)).select("event_type", day_text(), "y")


_P = "PARTITION BY event_type ORDER BY ds"


@query(
    "x2_feature_stream",
    f"""
    WITH {_CLOSED_SQL}
    SELECT event_type, strftime(ds, '%Y-%m-%d') AS ds, y, CAST(lag(y, 1) OVER w AS DOUBLE) AS lag_1,
           CAST(lag(y, 5) OVER w AS DOUBLE) AS lag_5,
           round(avg(y) OVER ({_P} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), 6) AS rolling_mean_5,
           round(stddev_samp(y) OVER ({_P} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), 6) AS rolling_std_5,
           CAST(lag(y, 1) OVER w - lag(y, 2) OVER w AS DOUBLE) AS lag_diff
    FROM closed WINDOW w AS ({_P})
    """,
)
def x2(spark, sf):
    """The closed days of the first stream feed a second one that keeps ten values per series."""
    days = daily.read_closed_days(spark, _closed_days(spark, f"{sf}/events.parquet"))
    out = daily.run_available(daily.feature_stream(days, "event_type", _STREAM_FEATURES), "features")
    made = spark.read.parquet(out)
    return made.select("event_type", day_text(), "y", *[rounded(c, c) for c in _STREAM_FEATURES])


@query(
    "x1_amended_days",
    "SELECT event_type, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS ds, count(*) AS y FROM events GROUP BY 1, 2",
)
def x1_amended(spark, sf):
    """Three deliveries, each with rows of all days, the second one replayed: every day counts every row once."""
    source, out = new_folder(spark, "deliveries"), new_folder(spark, "amended")
    events = table(spark, sf, "events").select("event_id", "ts", "event_type")
    for n in range(3):
        part = events.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == n)
        part.write.mode("append").parquet(source)
        daily.amend_days(spark.readStream.schema(part.schema).parquet(source), "ts", ["event_type"], out)
        if n == 1:  # a batch that failed after it had written runs again
            again = part.groupBy("event_type", F.to_date("ts").alias("ds")).agg(F.count(F.lit(1)).alias("y"))
            again.write.mode("overwrite").parquet(f"{out}/days/batch=1")
    return daily.amended_days(spark, out, ["event_type"]).select("event_type", day_text(), "y")


@query(
    "x2_feature_stream_any_order",
    f"""
    WITH {_CLOSED_SQL},
    made AS (
      SELECT event_type, ds, y, CAST(lag(y, 1) OVER w AS DOUBLE) AS lag_1, CAST(lag(y, 5) OVER w AS DOUBLE) AS lag_5,
             round(avg(y) OVER ({_P} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), 6) AS rolling_mean_5,
             round(stddev_samp(y) OVER ({_P} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), 6) AS rolling_std_5,
             CAST(lag(y, 1) OVER w - lag(y, 2) OVER w AS DOUBLE) AS lag_diff
      FROM closed WINDOW w AS ({_P}))
    SELECT event_type, strftime(ds, '%Y-%m-%d') AS ds, CAST(y AS DOUBLE) AS y, lag_1, lag_5, rolling_mean_5, rolling_std_5, lag_diff
    FROM made WHERE ds <= (SELECT max(ds) FROM closed) - INTERVAL 5 DAY
    """,
)
def x2_any_order(spark, sf):
    """Closed days delivered out of order, some days late, in several runs of one stream."""
    days = spark.read.parquet(_closed_days(spark, f"{sf}/events.parquet"))
    source, out = new_folder(spark, "days"), new_folder(spark, "ordered")
    late = F.pmod(F.xxhash64("event_type", "ds"), F.lit(3))
    delivery = F.floor((F.datediff("ds", F.lit("2024-01-01")) + late) / 10).cast("int")
    days = days.withColumn("delivery", delivery)
    for r in days.select("delivery").distinct().orderBy("delivery").collect():
        part = days.where(F.col("delivery") == r.delivery).drop("delivery")
        part.repartition(3, "event_type", "ds").write.mode("append").parquet(source)
        stream = spark.readStream.schema(part.schema).parquet(source)
        made = daily.ordered_feature_stream(stream, "event_type", _STREAM_FEATURES, "5 days")
        with daily.rocksdb_state(spark):
            result = daily.run_available(made, "ordered", out=out)
    found = spark.read.parquet(result)
    return found.select("event_type", day_text(), "y", *[rounded(c, c) for c in _STREAM_FEATURES])
