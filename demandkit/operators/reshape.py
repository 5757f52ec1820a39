"""One-hot encoding, column alignment, melting, scaling and stacking."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from demandkit.functions.encode import one_hot
from demandkit.operators.joins import attach_row

def learn_categories(train: DataFrame, column: str, max_categories: int) -> list:
    """Sorted distinct values of a training column.

    Each value becomes a column, so the caller says how many there may be; a longer list is an
    error rather than a silently cut one.
    """
    values = train.select(column).distinct().dropna().limit(max_categories + 1).collect()
    if len(values) > max_categories:
        raise ValueError(f"{column} has more than {max_categories} categories")
    return sorted(row[0] for row in values)


def add_one_hot(df: DataFrame, column: str, categories: Sequence, prefix: str | None = None) -> DataFrame:
    """Add one flag per category; unseen and null values get zeros."""
    return df.withColumns(one_hot(F.col(column), categories, prefix or column))


def align_columns(
    train: DataFrame, test: DataFrame, target: str | None = None, fill=0
) -> tuple[DataFrame, DataFrame]:
    """Give both frames the same columns in the same order, absent ones filled.

    The target stays with the training frame only.
    """
    shared = list(dict.fromkeys([*train.columns, *test.columns]))

    def complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
        return df.select(*[F.col(c) if c in df.columns else F.lit(fill).alias(c) for c in columns])

    test_columns = [c for c in shared if c != target]
    return complete(train, shared), complete(test, test_columns)


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Long form: ``ids, variable, value``."""
    return df.unpivot(list(ids), list(values), "variable", "value")


def rows_frame(spark: SparkSession, rows: Mapping[str, Mapping[str, object]], name: str, schema: str) -> DataFrame:
    """A small result mapping as rows: the outer key goes to column ``name``."""
    return spark.createDataFrame([{name: key, **values} for key, values in rows.items()], schema)


def fit_scaler(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: mean and population std per column."""
    return train.agg(
        *[F.avg(c).alias(f"{c}__mean") for c in columns],
        *[F.stddev_pop(c).alias(f"{c}__std") for c in columns],
    )


def apply_scaler(df: DataFrame, stats: DataFrame, columns: Sequence[str], suffix: str = "") -> DataFrame:
    """Standardise with fitted statistics; a constant column becomes zero."""

    def scaled(c: str):
        mean, spread = F.col("_fitted")[f"{c}__mean"], F.col("_fitted")[f"{c}__std"]
        return (F.col(c) - mean) / F.when(spread > 0, spread).otherwise(F.lit(1.0))

    fitted = attach_row(df, stats, "_fitted")
    return fitted.withColumns({c + suffix: scaled(c) for c in columns}).drop("_fitted")


def stack_history(history: DataFrame, future: DataFrame, flag: str = "is_future") -> DataFrame:
    """History and future rows in one frame, told apart by a 0/1 flag."""
    return history.withColumn(flag, F.lit(0)).unionByName(
        future.withColumn(flag, F.lit(1)), allowMissingColumns=True
    )
