"""Splitting rows into training and validation parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DateType

from demandkit.operators.joins import lookup_join
from demandkit.operators.profile import hash_percent
from demandkit.operators.series import Series, with_position


def _block(position: Column, n: Column, n_splits: int) -> Column:
    """Block of a 0-based position: 0 trains only, block i validates fold i."""
    size = F.floor(n / (n_splits + 1))
    first_test = n - n_splits * size
    block = F.floor((position - first_test) / size) + 1
    return F.when(position < first_test, F.lit(0)).otherwise(block).cast("int")


def fold_cuts(df: DataFrame, ts: str, n_splits: int, extra: Sequence[Column] = ()) -> DataFrame:
    """One row: the first date of every validation block, as ``cuts``, and ``extra`` aggregates.

    The set of distinct dates is bounded by the calendar.
    """
    if not isinstance(df.schema[ts].dataType, DateType):
        raise TypeError("time folds are cut between days; cast the time column to date")
    days = df.agg(F.array_sort(F.collect_set(ts)).alias("_days"), *extra)
    n = F.size("_days")
    size = F.floor(n / (n_splits + 1))
    cuts = [F.get("_days", (n - (n_splits - i) * size).cast("int")) for i in range(n_splits)]
    enough = F.assert_true(size > 0, F.lit("fewer dates than folds"))
    return days.withColumn("cuts", F.when(enough.isNull(), F.array(*cuts))).drop("_days")


def block_of(ts: Column, cuts: Column, n_splits: int) -> Column:
    """Number of cut dates that a date has reached."""
    reached = [(F.get(cuts, F.lit(i)) <= ts).cast("int") for i in range(n_splits)]
    return sum(reached[1:], reached[0])


def time_folds(df: DataFrame, ts: str, n_splits: int = 5, name: str = "block") -> DataFrame:
    """Expanding folds over the distinct dates of all series together.

    Fold ``i`` (1-based) validates on block ``i`` and trains on all blocks before it. With
    one row per date this is the positional expanding split. The cut dates reach the rows
    as a constant, so assigning blocks needs no join and no shuffle.
    """
    cut = df.withColumn("_cuts", fold_cuts(df, ts, n_splits).scalar())
    return cut.withColumn(name, block_of(F.col(ts), F.col("_cuts"), n_splits)).drop("_cuts")


def series_folds(df: DataFrame, series: Series, n_splits: int = 5, name: str = "block") -> DataFrame:
    """The same split by row position, separately for every series."""
    counts = df.groupBy(*series.keys).agg(F.count(F.lit(1)).alias("_n"))
    placed = lookup_join(with_position(df, series, "_pos"), counts, series.keys)
    block = _block(F.col("_pos") - 1, F.col("_n"), n_splits)
    return placed.withColumn(name, block).drop("_pos", "_n")


def fold_bounds(df: DataFrame, ts: str, n_splits: int = 5) -> DataFrame:
    """Rows and date range of both sides of every fold."""
    blocks = (
        time_folds(df, ts, n_splits)
        .groupBy("block")
        .agg(F.count(F.lit(1)).alias("n"), F.min(ts).alias("first"), F.max(ts).alias("last"))
    )
    sides = blocks.select("*", F.explode(F.sequence(F.lit(1), F.lit(n_splits))).alias("fold"))
    train, test = F.col("block") < F.col("fold"), F.col("block") == F.col("fold")
    return sides.groupBy("fold").agg(
        F.sum(F.when(train, F.col("n"))).alias("n_train"),
        F.sum(F.when(test, F.col("n"))).alias("n_test"),
        F.max(F.when(train, F.col("last"))).alias("train_end"),
        F.min(F.when(test, F.col("first"))).alias("test_start"),
        F.max(F.when(test, F.col("last"))).alias("test_end"),
    )


def holdout_flag(key: Column, percent: float = 20.0, seed: int = 42) -> Column:
    """1 for held-out rows: a seeded hash of the key, repeatable under any partitioning.

    A random split leaks the future on time-ordered rows; prefer ``time_folds`` there.
    """
    return (hash_percent(key, seed) < percent).cast("int")


def train_rows(df: DataFrame, fold: int, name: str = "block") -> DataFrame:
    return df.filter(F.col(name) < fold)


def validation_rows(df: DataFrame, fold: int, name: str = "block") -> DataFrame:
    return df.filter(F.col(name) == fold)


def folds_of(df: DataFrame, n_splits: int, name: str = "block") -> Sequence[tuple[int, DataFrame, DataFrame]]:
    return [(i, train_rows(df, i, name), validation_rows(df, i, name)) for i in range(1, n_splits + 1)]
