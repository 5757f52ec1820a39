"""Table and column profiles."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from demandkit.functions.columns import numeric_columns
from demandkit.functions.scalars import percent
from demandkit.operators.impute import apply_impute, fit_impute
from demandkit.operators.joins import lookup_join
from demandkit.operators.quantiles import exact_quantiles

QUARTILES = (0.25, 0.5, 0.75)


def _as_rows(wide: DataFrame, names: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Turn ``<name>__<field>`` columns of a one-row frame into one row per name."""
    structs = [
        F.struct(F.lit(n).alias("column"), *[F.col(f"{n}__{f}").alias(f) for f in fields])
        for n in names
    ]
    return wide.select(F.inline(F.array(*structs)))


def summary(
    df: DataFrame, columns: Sequence[str] | None = None, method: str = "nearest", approx: bool = False
) -> DataFrame:
    """count, null_count, mean, std, min, quartiles and max per numeric column.

    Quartiles are exact; ``approx`` replaces them by Spark's sketch in the same pass.
    """
    columns = list(columns or numeric_columns(df))
    wide = []
    for c in columns:
        value = F.col(c).cast("double")
        wide += [
            F.count(value).alias(f"{c}__count"),
            F.count_if(value.isNull()).alias(f"{c}__null_count"),
            F.avg(value).alias(f"{c}__mean"),
            F.stddev_samp(value).alias(f"{c}__std"),
            F.min(value).alias(f"{c}__min"),
            F.max(value).alias(f"{c}__max"),
        ]
        if approx:
            wide.append(F.percentile_approx(value, list(QUARTILES)).alias(f"{c}__q"))
    fields = ["count", "null_count", "mean", "std", "min", "max"]
    basic = _as_rows(df.agg(*wide), columns, [*fields, "q"] if approx else fields)
    if not approx:
        quartiles = exact_quantiles(df, columns, QUARTILES, method=method).select("column", "q")
        basic = lookup_join(basic, quartiles, ["column"], bounded=True)
    return basic.select(
        "column", *fields, *[F.get("q", i).alias(n) for i, n in enumerate(["q25", "q50", "q75"])]
    )


def null_profile(df: DataFrame, columns: Sequence[str] | None = None, only_nulls: bool = False) -> DataFrame:
    """Null count and percent per column, all counted in one pass."""
    columns = list(columns or df.columns)
    wide = [F.count_if(F.col(c).isNull()).alias(f"{c}__null_count") for c in columns]
    counted = df.agg(F.count(F.lit(1)).alias("_n"), *wide)
    named = counted.select(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"{c}__null_count").alias("null_count"),
                percent(F.col(f"{c}__null_count"), F.col("_n")).alias("null_percent"),
            ).alias(c)
            for c in columns
        ]
    )
    rows = named.select(F.inline(F.array(*columns)))
    return rows.filter("null_count > 0") if only_nulls else rows


def total_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: nulls left over all columns."""
    columns = list(columns or df.columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.select(sum((F.col(c) for c in columns), F.lit(0)).cast("long").alias("nulls"))


def require_no_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``df`` itself, or an error naming the columns that still hold nulls."""
    left = {r["column"]: r["null_count"] for r in null_profile(df, columns, True).collect()}
    if left:
        raise ValueError(f"nulls left: {left}")
    return df


def target_stats(df: DataFrame, y: str, discrete: bool = False) -> DataFrame:
    """Mean, median, sample std, min and max of one column."""
    basic = [
        F.avg(y).alias("mean"),
        F.stddev_samp(y).alias("std"),
        F.min(y).alias("min"),
        F.max(y).alias("max"),
    ]
    if discrete:
        return df.agg(*basic, F.median(y).alias("median"))
    median = exact_quantiles(df, [y], [0.5]).select(F.col("q")[0].alias("median"))
    return df.agg(*basic).withColumn("median", median.scalar())


def prediction_summary(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, population std and range of predictions."""
    return df.agg(
        F.count(column).alias("n"),
        F.avg(column).alias("mean"),
        F.stddev_pop(column).alias("std"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
    )


def target_range(df: DataFrame, y: str) -> DataFrame:
    return df.agg(F.min(y).alias("low"), F.max(y).alias("high"), F.avg(y).alias("mean"))


def _with_null_policy(df: DataFrame, columns: Sequence[str], nulls: str) -> DataFrame:
    if nulls == "complete":
        return df.select(*columns).dropna()
    if nulls == "impute":
        return apply_impute(df.select(*columns), fit_impute(df, {c: "median" for c in columns}))
    if nulls == "pairwise":
        return df.select(*columns)
    raise ValueError("nulls must be 'impute', 'pairwise' or 'complete'")


def correlations(df: DataFrame, columns: Sequence[str], nulls: str = "pairwise") -> DataFrame:
    """Correlation matrix in long form: ``a, b, r``, all pairs from one pass.

    ``nulls``: fill with the column median, drop per pair, or keep complete rows only.
    """
    columns = list(columns)
    base = _with_null_policy(df, columns, nulls)
    pairs = list(itertools.combinations_with_replacement(columns, 2))
    wide = base.agg(
        *[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_{i}") for i, (a, b) in enumerate(pairs)]
    )
    structs = []
    for i, (a, b) in enumerate(pairs):
        for left, right in dict.fromkeys([(a, b), (b, a)]):
            structs.append(
                F.struct(F.lit(left).alias("a"), F.lit(right).alias("b"), F.col(f"_{i}").alias("r"))
            )
    return wide.select(F.inline(F.array(*structs)))


def target_correlations(
    df: DataFrame,
    columns: Sequence[str],
    y: str,
    nulls: str = "pairwise",
    by_magnitude: bool = True,
    top: int | None = None,
) -> DataFrame:
    """Correlation of each column with the target, strongest first: ``column, r``."""
    columns = [c for c in columns if c != y]
    base = _with_null_policy(df, [*columns, y], nulls)
    wide = base.agg(
        *[F.corr(F.col(c).cast("double"), F.col(y).cast("double")).alias(c) for c in columns]
    )
    rows = wide.select(
        F.inline(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("r")) for c in columns])
        )
    )
    key = F.abs("r") if by_magnitude else F.col("r")
    ranked = rows.orderBy(key.desc_nulls_last(), F.col("column").asc())
    return ranked.limit(top) if top else ranked


def round_step(low: Column, high: Column, max_bins: int) -> Column:
    """Smallest width of the form 1, 2 or 5 times a power of ten that needs at most ``max_bins``."""
    raw = (high - low) / max_bins
    power = F.floor(F.log10(raw))
    # negative powers as a division, so that a tenth is the nearest double to 0.1
    scale = F.pow(F.lit(10.0), F.abs(power))
    lead = F.when(power >= 0, raw / scale).otherwise(raw * scale)
    digit = F.when(lead <= 1, 1.0).when(lead <= 2, 2.0).when(lead <= 5, 5.0).otherwise(10.0)
    width = F.when(power >= 0, digit * scale).otherwise(digit / scale)
    return F.when(high > low, width).otherwise(F.lit(1.0))


def histogram(
    df: DataFrame, column: str, max_bins: int = 10, by: Sequence[str] = ()
) -> DataFrame:
    """Counts per round-width bin: ``by, bin_start, bin_end, n``. Nulls are left out."""
    value = F.col(column).cast("double")
    limits = df.agg(F.min(value).alias("low"), F.max(value).alias("high"))
    step = limits.select(round_step(F.col("low"), F.col("high"), max_bins).alias("step")).scalar()
    stepped = df.filter(F.col(column).isNotNull()).withColumn("_step", step)
    binned = stepped.select(*by, F.floor(value / F.col("_step")).alias("_bin"), "_step")
    counted = binned.groupBy(*by, "_bin", "_step").agg(F.count(F.lit(1)).alias("n"))
    return counted.select(
        *by,
        (F.col("_bin") * F.col("_step")).alias("bin_start"),
        ((F.col("_bin") + 1) * F.col("_step")).alias("bin_end"),
        "n",
    )


def _fences(df: DataFrame, keys: Sequence[str], y: str, discrete: bool) -> DataFrame:
    if discrete:
        quartiles = df.groupBy(*keys).agg(F.percentile(y, list(QUARTILES)).alias("q"))
    else:
        quartiles = exact_quantiles(df, [y], QUARTILES, keys).select(*keys, "q")
    q1, q2, q3 = (F.col("q")[i] for i in range(3))
    return quartiles.select(
        *keys,
        q1.alias("q1"),
        q2.alias("median"),
        q3.alias("q3"),
        (q1 - 1.5 * (q3 - q1)).alias("low_fence"),
        (q3 + 1.5 * (q3 - q1)).alias("high_fence"),
    )


def box_stats(df: DataFrame, keys: Sequence[str], y: str, discrete: bool = False) -> DataFrame:
    """Quartiles, whisker ends within 1.5 IQR and the number of outliers per group."""
    keys = list(keys)
    fenced = lookup_join(df.select(*keys, y), _fences(df, keys, y, discrete), keys, "inner")
    inside = (F.col(y) >= F.col("low_fence")) & (F.col(y) <= F.col("high_fence"))
    return (
        fenced.groupBy(*keys, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col(y))).alias("low_whisker"),
            F.max(F.when(inside, F.col(y))).alias("high_whisker"),
            F.count_if(~inside).alias("n_outliers"),
        )
    )


def box_outliers(df: DataFrame, keys: Sequence[str], y: str, discrete: bool = False) -> DataFrame:
    """The rows beyond the 1.5 IQR fences of their group."""
    fences = _fences(df, keys, y, discrete).select(*keys, "low_fence", "high_fence")
    fenced = lookup_join(df, fences, keys, "inner")
    return fenced.filter((F.col(y) < F.col("low_fence")) | (F.col(y) > F.col("high_fence"))).drop(
        "low_fence", "high_fence"
    )


def daily_line(df: DataFrame, ts: str, y: Column, name: str = "y") -> DataFrame:
    """One point per day in date order, for a line chart."""
    return df.groupBy(F.col(ts).cast("date").alias("ds")).agg(y.alias(name)).orderBy("ds")


def hash_percent(key: Column, seed: int = 0) -> Column:
    """Repeatable number in [0, 100) per key, the same on every engine and partitioning.

    All 32 bits of the hash count, so shares of a millionth of a percent can be told apart.
    """
    text = F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string")))
    return F.conv(F.substring(text, 1, 8), 16, 10).cast("long") * (100.0 / 2**32)


def scatter(
    df: DataFrame,
    x: str,
    y: str,
    extra: Sequence[str] = (),
    positive: str | None = None,
    sample_key: str | None = None,
    sample_percent: float = 100.0,
    seed: int = 0,
) -> DataFrame:
    """Points with both coordinates present, optionally positive, optionally a hash sample."""
    points = df.dropna(subset=[x, y])
    if positive:
        points = points.filter(F.col(positive) > 0)
    if sample_key is not None and sample_percent < 100.0:
        points = points.filter(hash_percent(F.col(sample_key), seed) < sample_percent)
    return points.select(*dict.fromkeys([x, y, *extra]))
