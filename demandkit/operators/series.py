"""Row-based window features over many series.

Lags count rows, not days. A series is identified by ``keys`` and ordered by ``ts``.
A daily series holds one row per day, so its window partition is bounded by the calendar.
A series of raw rows has no such bound: its rows are numbered without sorting the whole
series in one task, and the window then runs over fixed-size stretches of rows that carry
the few preceding rows they look back to.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from demandkit.operators.joins import lookup_join
from demandkit.session import checkpointed

STRETCH_ROWS = 100_000


@dataclass(frozen=True)
class Series:
    """What identifies and orders the rows of a series.

    ``daily`` promises one row per key and day, as ``daily_series`` returns. Without it
    ``ties`` must make the row order total within equal ``ts``.
    """

    keys: tuple[str, ...]
    ts: str = "ds"
    daily: bool = True
    ties: tuple[str, ...] = ()

    def __post_init__(self):
        if not self.keys:
            raise ValueError("a series needs a key column; give a single series a constant one")

    @property
    def order(self) -> list[str]:
        return [self.ts, *self.ties]

    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(*self.order)


def with_trailing(
    df: DataFrame,
    series: Series,
    columns: Mapping[str, Callable[[WindowSpec], Column]],
    lookback: int,
    stretch_rows: int = STRETCH_ROWS,
    position: str | None = None,
) -> DataFrame:
    """Add window columns that look at most ``lookback`` rows back.

    Each entry maps a name to a function from the ordered window to its column. ``position``
    names a column that already numbers the rows of each series, where there is one.
    """
    if series.daily:
        w = series.window()
        return df.withColumns({name: make(w) for name, make in columns.items()})

    if lookback >= stretch_rows:
        raise ValueError("a stretch must be longer than the lookback")
    if position is None:
        placed = with_position(df, series, "_pos")
    else:
        placed = df.withColumn("_pos", F.col(position))
    stretch = F.floor((F.col("_pos") - 1) / stretch_rows)
    # the last rows of a stretch are also needed, as context only, by the next one
    is_context = (F.col("_pos") - 1) % stretch_rows >= stretch_rows - lookback
    own = F.struct(stretch.alias("_stretch"), F.lit(True).alias("_own"))
    context = F.struct((stretch + 1).alias("_stretch"), F.lit(False).alias("_own"))
    spread = placed.select(
        "*", F.inline(F.when(is_context, F.array(own, context)).otherwise(F.array(own)))
    )
    w = Window.partitionBy(*series.keys, "_stretch").orderBy("_pos")
    featured = spread.withColumns({name: make(w) for name, make in columns.items()})
    return featured.filter("_own").drop("_pos", "_stretch", "_own")


def with_position(df: DataFrame, series: Series, name: str = "position") -> DataFrame:
    """1-based row number within each series."""
    if series.daily:
        return df.withColumn(name, F.row_number().over(series.window()).cast("long"))
    # ranges of (key, time, ties) are sorted where they lie; rows of one time are spread like others
    ranged = df.repartitionByRange(*series.keys, *series.order).sortWithinPartitions(*series.keys, *series.order)
    ranged = checkpointed(ranged.withColumn("_at", F.monotonically_increasing_id()))
    # structs are never null, so plain equality also matches null keys
    key, part = F.struct(*series.keys), F.shiftright("_at", 33)
    counts = ranged.groupBy(key.alias("_sk"), part.alias("_sp")).agg(F.count(F.lit(1)).alias("_c"), F.min("_at").alias("_first"))
    # one row for each range that a key lies in
    ranges = Window.partitionBy("_sk").orderBy("_sp")
    starts = counts.select("_sk", "_sp", (_sum_before("_c", ranges) - F.col("_first")).alias("_start"))
    placed = ranged.withColumns({"_k": key, "_p": part}).join(starts, (F.col("_k") == F.col("_sk")) & (F.col("_p") == F.col("_sp")))
    return placed.select(*df.columns, (F.col("_at") + F.col("_start") + 1).cast("long").alias(name))


def _sum_before(count: str, w: WindowSpec) -> Column:
    return F.coalesce(F.sum(count).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def date_positions(df: DataFrame, ts: str) -> DataFrame:
    """1-based place of every distinct date: ``ts, position``. Bounded by the calendar."""
    days = F.array_sort(F.collect_set(F.col(ts).cast("date")))
    placed = df.agg(days.alias("_days")).select(F.posexplode("_days").alias("_i", ts))
    return placed.select(ts, (F.col("_i") + 1).cast("long").alias("position"))


def with_date_position(df: DataFrame, ts: str, name: str = "position") -> DataFrame:
    """Place of each row's date among all distinct dates, over all series together."""
    places = date_positions(df, ts).withColumnRenamed("position", name)
    return lookup_join(df, places, [ts], bounded=True)


# Window columns. Each returns a function of the ordered window.


def lag(y: str, k: int):
    return lambda w: F.lag(y, k).over(w)


def trailing_mean(y: str, n: int, full_window: bool = False):
    """Mean of the ``n`` rows before this one; fewer rows are enough unless ``full_window``."""

    def column(w: WindowSpec) -> Column:
        frame = w.rowsBetween(-n, -1)
        mean = F.avg(y).over(frame)
        return F.when(F.count(y).over(frame) >= n, mean) if full_window else mean

    return column


def trailing_std(y: str, n: int):
    """Sample std of the ``n`` rows before this one; null with fewer than two."""
    return lambda w: F.stddev_samp(y).over(w.rowsBetween(-n, -1))


def difference(y: str):
    """This row minus the previous one. Contains today's value: not a forecasting feature."""
    return lambda w: F.col(y) - F.lag(y, 1).over(w)


def lagged_difference(y: str):
    """Previous row minus the one before it: known before today's value is."""
    return lambda w: F.lag(y, 1).over(w) - F.lag(y, 2).over(w)


_FEATURE = re.compile(r"(lag|rolling_mean|rolling_std)_(\d+)")


def parse_feature(name: str) -> tuple[str, int] | None:
    """``lag_5`` → ``("lag", 5)``; None for a column that is no series feature."""
    if name == "lag_diff":
        return "lag_diff", 2
    match = _FEATURE.fullmatch(name)
    return (match.group(1), int(match.group(2))) if match else None


def add_series_features(
    df: DataFrame, series: Series, y: str, names: Sequence[str], position: str | None = None
) -> DataFrame:
    """Add ``lag_k``, ``rolling_mean_n``, ``rolling_std_n`` and ``lag_diff`` columns by name."""
    makers, lookback = {}, 0
    for name in names:
        parsed = parse_feature(name)
        if parsed is None:
            raise ValueError(f"unknown series feature {name}")
        kind, n = parsed
        lookback = max(lookback, n)
        makers[name] = {
            "lag": lag,
            "rolling_mean": trailing_mean,
            "rolling_std": trailing_std,
            "lag_diff": lambda y, _: lagged_difference(y),
        }[kind](y, n)
    return with_trailing(df, series, makers, lookback, position=position)


def fill_with_series_mean(
    df: DataFrame, train: DataFrame, series: Series, y: str, columns: Sequence[str]
) -> DataFrame:
    """Fill nulls in lag columns with the mean of ``y`` over the series' training rows."""
    means = train.groupBy(*series.keys).agg(F.avg(y).alias("_series_mean"))
    joined = lookup_join(df, means, series.keys)
    return joined.withColumns(
        {c: F.coalesce(F.col(c).cast("double"), F.col("_series_mean")) for c in columns}
    ).drop("_series_mean")


def last_rows(df: DataFrame, series: Series, n: int) -> DataFrame:
    """The last ``n`` rows of each series. Spark cuts each task to ``n`` before the shuffle."""
    newest = Window.partitionBy(*series.keys).orderBy(*[F.col(c).desc() for c in series.order])
    return (
        df.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= n).drop("_rn")
    )


def tail_buffer(df: DataFrame, series: Series, y: str, n: int = 10, name: str = "buffer") -> DataFrame:
    """Last ``n`` values per series as an array, oldest first."""
    pairs = F.sort_array(F.collect_list(F.struct(*series.order, F.col(y).cast("double").alias("_y"))))
    return (
        last_rows(df.select(*series.keys, *series.order, y), series, n)
        .groupBy(*series.keys)
        .agg(F.transform(pairs, lambda p: p["_y"]).alias(name))
    )
