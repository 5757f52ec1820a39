"""Forecasting future rows: frozen lags and the recursive walk.

The recursive forecast is sequential in time and independent between series. Every series
becomes one row holding its last actual values and its future rows; the walk over the
future is a fold over that array, done inside the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from demandkit.functions.scalars import clip
from demandkit.operators.joins import attach_row, lookup_join
from demandkit.operators.series import Series, parse_feature, tail_buffer

BUFFER = 10


def array_mean(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda s, v: s + v)
    return F.when(F.size(values) > 0, total / F.size(values)).otherwise(F.lit(0.0))


def array_std(values: Column) -> Column:
    """Sample std; 0 with fewer than two values."""
    mean = array_mean(values)
    squares = F.aggregate(values, F.lit(0.0), lambda s, v: s + (v - mean) * (v - mean))
    return F.when(F.size(values) > 1, F.sqrt(squares / (F.size(values) - 1))).otherwise(F.lit(0.0))


def tail(values: Column, n: int) -> Column:
    """Last ``n`` elements, or all of them."""
    return F.slice(values, F.greatest(F.size(values) - (n - 1), F.lit(1)), F.lit(n))


def buffer_feature(name: str, buffer: Column) -> Column | None:
    """A series feature computed from the last actual or predicted values, newest last.

    A buffer too short for a lag falls back to its mean, an empty one to 0.
    """
    parsed = parse_feature(name)
    if parsed is None:
        return None
    kind, n = parsed
    size = F.size(buffer)
    if kind == "lag":
        return F.when(size >= n, F.get(buffer, size - n)).otherwise(array_mean(buffer))
    if kind == "rolling_mean":
        return array_mean(tail(buffer, n))
    if kind == "rolling_std":
        return array_std(tail(buffer, n))
    change = F.get(buffer, size - 1) - F.get(buffer, size - 2)
    return F.when(size >= 2, change).otherwise(F.lit(0.0))


def frozen_lags(
    history: DataFrame, future: DataFrame, series: Series, y: str, names: Sequence[str]
) -> DataFrame:
    """Future rows with series features frozen at the end of the history.

    As many last values are looked at as the longest feature asks for.
    """
    features = {name: buffer_feature(name, F.col("buffer")) for name in names}
    if any(c is None for c in features.values()):
        raise ValueError(f"not all of {list(names)} are series features")
    look = max([parse_feature(name)[1] for name in names], default=1)
    last = tail_buffer(history, series, y, max(BUFFER, look)).select(
        *series.keys, *[c.alias(n) for n, c in features.items()]
    )
    return lookup_join(future, last, series.keys)


def recursive_forecast(
    history: DataFrame,
    future: DataFrame,
    series: Series,
    y: str,
    features: Sequence[str],
    predict: Callable[[list[Column]], Column],
    models: DataFrame | None = None,
    low: Column | float | None = None,
    high: Column | float | None = None,
    buffer_size: int = BUFFER,
) -> DataFrame:
    """``keys, ts, prediction`` for every future row.

    ``features`` names, in model order, series features and columns of ``future``.
    ``predict`` turns the feature values into one value; it may refer to the columns of
    ``models``, which holds one row per series, or a single row for all. A series without a
    model gets nulls. Bounds apply inside the walk, because a bounded prediction feeds the
    following lags. Only the last ``buffer_size`` rows of each history and the future rows
    are moved.
    """
    keys = list(series.keys)
    given = [f for f in features if parse_feature(f) is None]
    look = max([parse_feature(f)[1] for f in features if parse_feature(f)], default=1)
    buffer_size = max(buffer_size, look)
    ahead = F.sort_array(
        F.collect_list(F.struct(series.ts, *[F.col(c).cast("double").alias(c) for c in given]))
    )
    packed = future.groupBy(*keys).agg(ahead.alias("_ahead"))
    state = lookup_join(packed, tail_buffer(history, series, y, buffer_size, "_buffer"), keys)
    if models is not None:
        shared = [c for c in keys if c not in models.columns]
        if shared:
            single = attach_row(state, models, "_models")
            state = single.withColumns({c: F.col("_models")[c] for c in models.columns})
        else:
            state = lookup_join(state, models, keys)
    start = F.struct(
        F.coalesce("_buffer", F.array().cast("array<double>")).alias("buffer"),
        F.array().cast("array<double>").alias("predictions"),
    )

    def step(acc: Column, row: Column) -> Column:
        buffer = acc["buffer"]
        values = [row[f] if parse_feature(f) is None else buffer_feature(f, buffer) for f in features]
        value = predict([F.coalesce(v, F.lit(0.0)) for v in values])

        def remember(made: Column) -> Column:
            bounded = F.array(clip(made, low, high))
            return F.struct(
                tail(F.concat(buffer, bounded), buffer_size).alias("buffer"),
                F.concat(acc["predictions"], bounded).alias("predictions"),
            )

        # a one-element array binds the prediction, so that it is computed once per step
        return F.transform(F.array(value), remember)[0]

    walked = F.aggregate("_ahead", start, step, lambda acc: acc["predictions"])
    pairs = F.zip_with(
        "_ahead",
        walked,
        lambda row, p: F.struct(row[series.ts].alias(series.ts), p.alias("prediction")),
    )
    return state.select(*keys, F.inline(pairs))
