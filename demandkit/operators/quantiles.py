"""Exact quantiles that never gather a group in one task.

Spark's ``percentile`` merges all distinct values of a group in one task. Here a histogram
over narrow value buckets locates the bucket that holds the wanted rank. While such a bucket holds
many rows, as timestamps or prices in a narrow band do, it is cut into cells between its smallest
and largest value, and the cell that holds the rank takes its place. Only the values of the last
bucket or cell are ranked. Buckets and cells are pure functions of the data, so a recomputed task
agrees with the first run, and they only steer the work: the result is exact whatever the
distribution.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, FloatType

from demandkit.session import checkpointed

# Targets (one per group, column and wanted rank, of about a hundred bytes) that are broadcast;
# more of them are joined by shuffling.
BROADCAST_ROWS = 100_000
# Rows of a bucket that may be ranked together; a larger one is cut into cells.
RANKED_ROWS = 100_000
_CELLS = 4096
# Buckets per doubling of the value: enough for values spread over some octaves, few enough for
# a group's histogram to be small.
_BUCKETS_PER_OCTAVE = float(2**12)
# keeps log2 of the smallest positive double above zero
_LOG_SHIFT = 1100.0


def _bucket(value: Column) -> Column:
    """Integer that never decreases as ``value`` grows."""
    magnitude = F.floor((F.log2(F.abs(value)) + _LOG_SHIFT) * _BUCKETS_PER_OCTAVE)
    return (
        F.when(value > 0, magnitude).when(value < 0, -magnitude).otherwise(F.lit(0)).cast("long")
    )


def _wanted_ranks(probs: Sequence[float], method: str, n: Column) -> list[Column]:
    """0-based ranks needed for all probabilities."""
    ranks = []
    for p in probs:
        position = F.lit(float(p)) * (n - 1)
        if method == "nearest":
            ranks.append(F.floor(position + 0.5))
        else:
            ranks += [F.floor(position), F.ceil(position)]
    return [r.cast("long") for r in ranks]


def _interpolated(probs: Sequence[float], method: str, n: Column, at_rank: Column) -> Column:
    values = []
    for p in probs:
        position = F.lit(float(p)) * (n - 1)
        if method == "nearest":
            values.append(F.element_at(at_rank, F.floor(position + 0.5).cast("long")))
        else:
            low = F.element_at(at_rank, F.floor(position).cast("long"))
            high = F.element_at(at_rank, F.ceil(position).cast("long"))
            values.append(low + (high - low) * (position - F.floor(position)))
    return F.array(*values)


def _ranked_slice(
    counts: DataFrame, part: Sequence[str], order: str, count: str, start: Column
) -> DataFrame:
    """Add the first rank (``_lo``) and the rank after the last (``_hi``) of each row."""
    w = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    high = start + F.sum(count).over(w)
    return counts.withColumn("_hi", high).withColumn("_lo", F.col("_hi") - F.col(count))


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    keys: Sequence[str] = (),
    method: str = "linear",
) -> DataFrame:
    """One row per group and column: ``keys, column, n, q`` with ``q`` aligned to ``probs``.

    Nulls and NaN are left out. ``linear`` interpolates between neighbours, ``nearest``
    takes the closest row. Groups without any value have no row.
    """
    if method not in ("linear", "nearest"):
        raise ValueError("method must be 'linear' or 'nearest'")
    keys = list(keys)
    group = [*keys, "column"]
    types = {f.name: f.dataType for f in df.schema}

    def value_of(c: str) -> Column:
        col = F.col(c)
        if isinstance(types[c], (DoubleType, FloatType)):
            col = F.when(~F.isnan(col), col)
        return col.cast("double")

    if len(columns) == 1:
        long = df.select(*keys, F.lit(columns[0]).alias("column"), value_of(columns[0]).alias("_v"))
    else:
        wide = df.select(*keys, *[value_of(c).alias(f"_v_{i}") for i, c in enumerate(columns)])
        pairs = F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.col(f"_v_{i}").alias("_v"))
                for i, c in enumerate(columns)
            ]
        )
        long = wide.select(*keys, F.inline(pairs))

    rows = long.filter(F.col("_v").isNotNull()).withColumn("_b", _bucket(F.col("_v")))
    bounds = [F.min("_v").alias("_from"), F.max("_v").alias("_to")]
    histogram = rows.groupBy(*group, "_b").agg(F.count(F.lit(1)).alias("_bc"), *bounds)
    ranks = _wanted_ranks(probs, method, F.col("n"))
    holds_a_rank = reduce(
        lambda a, b: a | b, [(F.col("_lo") <= r) & (r < F.col("_hi")) for r in ranks]
    )
    targets = (
        _ranked_slice(histogram, group, "_b", "_bc", F.lit(0))
        .withColumn("n", F.sum("_bc").over(Window.partitionBy(*group)))
        .filter(holds_a_rank)
        .withColumn("_rank", F.explode(F.array_distinct(F.array(*ranks))))
        .filter("_lo <= _rank AND _rank < _hi")
        .select(*group, "_b", "_rank", "n", F.col("_lo").alias("_base"), "_from", "_to", "_bc")
    )
    targets = checkpointed(targets)
    most = F.max(F.when(F.col("_from") < F.col("_to"), F.col("_bc")))
    n_targets, worst = targets.agg(F.count(F.lit(1)), most).first()
    small = n_targets <= BROADCAST_ROWS
    if small:
        # a second scan that keeps the target buckets is cheaper than shuffling the values
        rows = rows.withColumn("_c", F.lit(1).cast("long"))
    else:
        # shrink to distinct values; the bucket in the join key keeps a large group spread
        rows = rows.groupBy(*group, "_b", "_v").agg(F.count(F.lit(1)).alias("_c"))
    while (worst or 0) > RANKED_ROWS:
        width = F.col("_to") - F.col("_from")
        cell = F.floor((F.col("_v") - F.col("_from")) / F.when(width > 0, width).otherwise(1.0) * _CELLS)
        cells = (
            _match(rows, targets, [*group, "_b"], small)
            .withColumn("_cell", cell)
            .groupBy(*group, "_b", "n", "_rank", "_base", "_cell")
            .agg(F.sum("_c").alias("_bc"), *bounds)
        )
        targets = checkpointed(
            _ranked_slice(cells, [*group, "_rank"], "_cell", "_bc", F.col("_base"))
            .filter("_lo <= _rank AND _rank < _hi")
            .select(*group, "_b", "_rank", "n", F.col("_lo").alias("_base"), "_from", "_to", "_bc")
        )
        before, worst = worst, targets.agg(most).first()[0]
        if worst == before:  # values too close for a cell of their own
            break
    candidates = (
        _match(rows, targets, [*group, "_b"], small)
        .groupBy(*group, "n", "_rank", "_base", "_v")
        .agg(F.sum("_c").alias("_c"))
    )
    found = _ranked_slice(candidates, [*group, "_rank"], "_v", "_c", F.col("_base")).filter(
        "_lo <= _rank AND _rank < _hi"
    )
    by_rank = found.groupBy(*group, "n").agg(
        F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_at")
    )
    return by_rank.select(*group, "n", _interpolated(probs, method, F.col("n"), F.col("_at")).alias("q"))


def _match(rows: DataFrame, targets: DataFrame, on: Sequence[str], small: bool) -> DataFrame:
    """Keep the values between the bounds of the wanted buckets, once per wanted rank."""
    right = targets.select(
        *[F.col(c).alias(f"_t_{c}") for c in on], *[c for c in targets.columns if c not in on]
    )
    condition = F.lit(True)
    for c in on:
        condition = condition & F.col(c).eqNullSafe(F.col(f"_t_{c}"))
    condition = condition & F.col("_v").between(F.col("_from"), F.col("_to"))
    joined = rows.join(F.broadcast(right) if small else right, condition)
    return joined.drop(*[f"_t_{c}" for c in on])


def exact_median(df: DataFrame, column: str, keys: Sequence[str] = (), name: str = "median") -> DataFrame:
    """``keys, name`` for one column."""
    return exact_quantiles(df, [column], [0.5], keys).select(*keys, F.col("q")[0].alias(name))
