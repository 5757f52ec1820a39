"""Holiday flags from a user-supplied calendar table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from demandkit.functions.scalars import flag
from demandkit.operators.joins import lookup_join


def with_holidays(df: DataFrame, ts: str, calendar: DataFrame, day: str = "ds") -> DataFrame:
    """Add ``is_holiday`` and ``is_next_holiday``. The calendar lists one row per holiday.

    Distinct calendar days bound the lookup, so it is broadcast.
    """
    holidays = calendar.select(F.col(day).cast("date").alias("_day")).dropna().distinct()
    today = holidays.withColumn("_today", F.lit(True))
    tomorrow = holidays.withColumn("_tomorrow", F.lit(True))
    keyed = df.withColumn("_day", F.col(ts).cast("date"))
    joined = lookup_join(keyed, today, ["_day"], bounded=True)
    shifted = joined.withColumn("_day", F.date_add("_day", 1))
    both = lookup_join(shifted, tomorrow, ["_day"], bounded=True)
    return both.withColumns(
        {"is_holiday": flag(F.col("_today")), "is_next_holiday": flag(F.col("_tomorrow"))}
    ).drop("_day", "_today", "_tomorrow")
