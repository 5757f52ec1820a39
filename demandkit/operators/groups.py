"""Grouped statistics. Every aggregate here merges partial results before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from demandkit.functions.scalars import percent
from demandkit.operators.quantiles import exact_median



def daily_series(
    df: DataFrame, ts: str, keys: Sequence[str] = (), value: Column | None = None, name: str = "y"
) -> DataFrame:
    """One row per series and calendar day: ``keys, ds, name``.

    ``value`` is an aggregate; the default counts rows. The result holds at most one row
    per key and day, which is what bounds the per-series windows downstream.
    """
    measure = F.count(F.lit(1)) if value is None else value
    return df.groupBy(*keys, F.col(ts).cast("date").alias("ds")).agg(measure.alias(name))


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of two group results; a null key matches a null key."""
    renamed = right.select(
        *[F.col(c).alias(f"_r_{c}") for c in keys], *[c for c in right.columns if c not in keys]
    )
    condition = reduce(
        lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in keys], F.lit(True)
    )
    return left.join(renamed, condition, "left").drop(*[f"_r_{c}" for c in keys])


def group_stats(df: DataFrame, keys: Sequence[str], y: str, discrete: bool = False) -> DataFrame:
    """Rows, non-null count, mean, median, sample std, min and max of ``y`` per group.

    ``discrete`` says ``y`` has few distinct values per group (counts, codes): the median
    then comes from Spark's value histogram in the same pass. Otherwise it is found
    without gathering a group in one task.
    """
    keys = list(keys)
    aggregates = [
        F.count(F.lit(1)).alias("n_rows"),
        F.count(y).alias("n"),
        F.avg(y).alias("mean"),
        F.stddev_samp(y).alias("std"),
        F.min(y).alias("min"),
        F.max(y).alias("max"),
    ]
    if discrete:
        aggregates.append(F.median(y).alias("median"))
        return df.groupBy(*keys).agg(*aggregates)
    return null_safe_join(df.groupBy(*keys).agg(*aggregates), exact_median(df, y, keys), keys)


def mean_and_count(df: DataFrame, keys: Sequence[str], y: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(y).alias("mean"), F.count(F.lit(1)).alias("n_rows"))


def rate_by(df: DataFrame, condition: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Rows, hits and hit rate in percent, per group or overall."""
    return (
        df.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(condition).alias("hits"),
        )
        .withColumn("rate", percent(F.col("hits"), F.col("n_rows")))
    )


def presence_comparison(df: DataFrame, column: str, y: str) -> DataFrame:
    """Rows and mean of ``y`` with and without a value in ``column``, in one pass."""
    return df.groupBy(F.col(column).isNotNull().cast("int").alias("present")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg(y).alias("mean")
    )


def label_frequency(df: DataFrame, label: str, y: str, discrete: bool = False) -> DataFrame:
    """Non-null labels with count, mean and median of ``y``, most frequent first."""
    kept = df.filter(F.col(label).isNotNull())
    stats = group_stats(kept, [label], y, discrete).select(label, "n_rows", "mean", "median")
    return stats.orderBy(F.col("n_rows").desc_nulls_last(), F.col(label).asc_nulls_last())


def monthly_mean(df: DataFrame, ts: str, y: str) -> DataFrame:
    return df.groupBy(F.month(ts).alias("month")).agg(F.avg(y).alias("mean"))


def two_key_mean(
    df: DataFrame, row_key: str, column_key: str, y: str, drop_null_keys: bool = True
) -> DataFrame:
    """Mean of ``y`` per pair of keys, long form."""
    if drop_null_keys:
        df = df.dropna(subset=[row_key, column_key])
    return df.groupBy(row_key, column_key).agg(F.avg(y).alias("mean"))


def two_key_mean_wide(
    df: DataFrame, row_key: str, column_key: str, values: Sequence, y: str, prefix: str
) -> DataFrame:
    """The same with one column per listed value of ``column_key``."""
    kept = df.dropna(subset=[row_key, column_key])
    return kept.groupBy(row_key).agg(
        *[F.avg(F.when(F.col(column_key) == v, F.col(y))).alias(f"{prefix}_{v}") for v in values]
    )


def two_way_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.groupBy(a, b).agg(F.count(F.lit(1)).alias("n_rows"))
