"""Imputation in two steps: statistics are learned from training rows, then applied anywhere."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from demandkit.operators.groups import null_safe_join
from demandkit.operators.joins import attach_row, lookup_join
from demandkit.operators.quantiles import exact_quantiles


def fit_impute(
    train: DataFrame, how: Mapping[str, object], keys: Sequence[str] = (), approx: bool = False
) -> DataFrame:
    """Fill values per column: ``"median"``, ``"mean"`` or a constant.

    One row, or one row per group with ``keys``. The columns carry the names they fill.
    Medians are exact unless ``approx`` asks for Spark's sketch.
    """
    keys = list(keys)
    medians = [c for c, rule in how.items() if rule == "median"]
    means = [c for c, rule in how.items() if rule == "mean"]
    constants = {c: F.lit(rule) for c, rule in how.items() if c not in medians + means}
    aggregates = [F.avg(c).alias(c) for c in means]
    if approx:
        aggregates += [F.percentile_approx(F.col(c).cast("double"), 0.5).alias(c) for c in medians]
        medians = []
    if not medians:
        # a row count keeps the one row, or the group rows, when only constants are asked for
        stats = train.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *aggregates)
    else:
        found = exact_quantiles(train, medians, [0.5], keys)
        stats = found.groupBy(*keys).agg(
            *[F.max(F.when(F.col("column") == c, F.col("q")[0])).alias(c) for c in medians]
        )
        if aggregates and keys:
            stats = null_safe_join(train.groupBy(*keys).agg(*aggregates), stats, keys)
        elif aggregates:
            stats = attach_row(train.agg(*aggregates), stats, "_m").withColumns(
                {c: F.col("_m")[c] for c in medians}
            )
    return stats.withColumns(constants).select(*keys, *how) if constants else stats.select(*keys, *how)


def apply_impute(
    df: DataFrame, stats: DataFrame, keys: Sequence[str] = (), suffix: str = ""
) -> DataFrame:
    """Fill nulls from fitted statistics, in place or into ``<column><suffix>``."""
    columns = [c for c in stats.columns if c not in keys]
    if not keys:
        filled = attach_row(df, stats, "_fill").withColumns(
            {c + suffix: F.coalesce(F.col(c), F.col("_fill")[c]) for c in columns}
        )
        return filled.drop("_fill")
    renamed = stats.select(*keys, *[F.col(c).alias(f"_fill_{c}") for c in columns])
    joined = lookup_join(df, renamed, keys)
    filled = joined.withColumns(
        {c + suffix: F.coalesce(F.col(c), F.col(f"_fill_{c}")) for c in columns}
    )
    return filled.drop(*[f"_fill_{c}" for c in columns])
