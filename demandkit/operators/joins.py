"""Joining a large frame to a small one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

KINDS = ("inner", "left", "left_semi", "left_anti")


def lookup_join(
    df: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "left", bounded: bool = False
) -> DataFrame:
    """Join ``df`` to a lookup frame with at most one row per key.

    ``bounded`` says the lookup is small by construction (calendar days, folds, columns): it is
    broadcast. Otherwise it is a plain join, for which adaptive execution picks the form from the
    sizes it has measured and splits hot keys of ``df``. Only joins that keep or drop rows of ``df``
    are allowed: the others would not survive that split. Keys compare null-safe: a null group
    finds its row.
    """
    if how not in KINDS:
        raise ValueError(f"how must be one of {KINDS}")
    on = list(on)
    values = [c for c in dim.columns if c not in on]
    right = dim.select(*[F.col(c).alias(f"_r_{c}") for c in on], *values)
    if bounded:
        right = F.broadcast(right)
    condition = F.lit(True)
    for c in on:
        condition = condition & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return df.join(right, condition, how).drop(*[f"_r_{c}" for c in on])


def attach_row(df: DataFrame, stats: DataFrame, name: str) -> DataFrame:
    """Add the values of a one-row frame to every row, as the struct column ``name``.

    It is a scalar subquery: the frame is computed once and the large side needs neither a
    join nor a shuffle. Being a column it is planned once however many fields are used.
    """
    return df.withColumn(name, stats.select(F.struct(*stats.columns)).scalar())


def with_expected(df: DataFrame, expected: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is among the expected keys."""
    return lookup_join(df, expected.select(*on).distinct(), on, "left_semi")


def missing_keys(expected: DataFrame, df: DataFrame, on: Sequence[str]) -> DataFrame:
    """Expected keys that ``df`` has no row for."""
    # repeated keys are dropped before the shuffle, so a hot one does not travel
    return expected.join(df.select(*on).distinct(), list(on), "left_anti")
