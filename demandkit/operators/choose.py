"""Sorting, top-k and picking the best row. Null order and tie order are always explicit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def sort_rows(df: DataFrame, column: str, ties: Sequence[str], descending: bool = False) -> DataFrame:
    """Order by one column, nulls last, ties broken by further columns."""
    key = F.col(column).desc_nulls_last() if descending else F.col(column).asc_nulls_last()
    return df.orderBy(key, *[F.col(c).asc_nulls_last() for c in ties])


def top_k(df: DataFrame, by: Column | str, k: int, ties: Sequence[str]) -> DataFrame:
    """The ``k`` largest rows; ``ties`` makes the cut repeatable."""
    key = F.col(by) if isinstance(by, str) else by
    return df.orderBy(key.desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in ties]).limit(k)


def declared_position(col: Column, order: Sequence) -> Column:
    """1-based place in a declared list; values outside the list come last."""
    place = F.array_position(F.array(*[F.lit(v) for v in order]), col)
    return F.when(place > 0, place).otherwise(F.lit(len(order) + 1)).cast("int")


def order_by_list(df: DataFrame, column: str, order: Sequence) -> DataFrame:
    return df.orderBy(declared_position(F.col(column), order), F.col(column).asc_nulls_last())


def best_row(df: DataFrame, metric: str, listed: str, keys: Sequence[str] = ()) -> DataFrame:
    """Row with the lowest metric per group; ties go to the one listed first.

    Either form keeps one row per group and task before anything is shuffled.
    """
    order = [F.col(metric).asc_nulls_last(), F.col(listed).asc_nulls_last()]
    if not keys:
        return df.orderBy(*order).limit(1)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")
