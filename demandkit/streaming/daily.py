"""Daily demand from an event stream, and lag features scored as days close."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import date

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from demandkit.operators.series import parse_feature
from demandkit.session import new_folder

BUFFER = 10


class LateRows(RuntimeError):
    """A stream left out rows that came later than its watermark allows."""


def read_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A parquet table, one file or a folder of part files, as a stream.

    Without ``max_files`` all files that are there make one batch, so that the order of files
    cannot make rows late. A cap is for tables whose files are written in the order of time.
    """
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # as a pattern the path may be a file as well as a folder: else a stream takes it for a folder
    whole = path.rstrip("/")
    return reader.parquet(f"{whole[:-1]}[{whole[-1]}]")


def read_closed_days(spark: SparkSession, folder: str) -> DataFrame:
    """The output of a daily demand stream as the next stream.

    The sink commits whole batches, and a day is only in one of them. Without a file limit
    every trigger takes whole batches too, so the days of a series never arrive out of order.
    """
    return spark.readStream.schema(spark.read.parquet(folder).schema).parquet(folder)


def daily_demand_stream(
    events: DataFrame, ts: str, keys: Sequence[str], delay: str = "1 day", name: str = "y"
) -> DataFrame:
    """Events per series and day; a day is emitted once, when the watermark has passed it.

    Rows that come in a later batch than the one that closed their day are dropped by the stream;
    ``run_available`` raises if there are any.
    """
    # day windows are cut at UTC midnight: move the local clock there and back
    zone = F.current_timezone()
    local = events.withColumn("_clock", F.from_utc_timestamp(F.col(ts).cast("timestamp"), zone))
    windowed = (
        local.withWatermark("_clock", delay)
        .groupBy(F.window("_clock", "1 day").alias("_day"), *keys)
        .agg(F.count(F.lit(1)).alias(name))
    )
    day = F.to_utc_timestamp(F.col("_day.start"), zone).cast("date")
    return windowed.select(*keys, day.alias("ds"), name)


def dropped_rows(progress: dict) -> int:
    return sum(int(s.get("numRowsDroppedByWatermark", 0)) for s in progress.get("stateOperators", ()))


def run_available(stream: DataFrame, name: str, allow_late: bool = False, out: str | None = None) -> str:
    """Process what is there, in append mode; returns the shared folder written to.

    With ``out``, a folder of an earlier call, the stream goes on where that stopped. Raises ``LateRows``
    if the watermark dropped rows, unless the caller allows that.
    """
    out = out or new_folder(stream.sparkSession, name)
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", f"{out}/data")
        .option("checkpointLocation", f"{out}/state")
        .trigger(availableNow=True)
        .start()
    )
    dropped: dict[int, int] = {}
    while True:
        ended = query.awaitTermination(1)
        for progress in map(dict, query.recentProgress):  # holds the newest hundred only
            dropped[progress["batchId"]] = dropped_rows(progress)
        if ended:
            break
    if sum(dropped.values()) and not allow_late:
        raise LateRows(f"{name}: {sum(dropped.values())} rows or groups came after their day was closed")
    return f"{out}/data"


def amend_days(events: DataFrame, ts: str, keys: Sequence[str], out: str, name: str = "y") -> None:
    """Process what is there and add it to the days below ``out``, days that were closed long ago too.

    Every batch leaves its own counts under its number. A batch that runs again after a failure replaces
    what it left before, so that nothing counts twice, and rows that come late change their day. The
    same ``out`` goes on where the last call stopped. ``amended_days`` adds up what the batches left.
    """

    def merge(batch: DataFrame, number: int) -> None:
        counts = batch.groupBy(*keys, F.to_date(ts).alias("ds")).agg(F.count(F.lit(1)).alias(name))
        counts.write.mode("overwrite").parquet(f"{out}/days/batch={number}")

    query = events.writeStream.foreachBatch(merge).option("checkpointLocation", f"{out}/state").trigger(availableNow=True).start()
    query.awaitTermination()


def amended_days(spark: SparkSession, out: str, keys: Sequence[str], name: str = "y") -> DataFrame:
    """``(*keys, ds, y)``: the days as all batches so far make them."""
    return spark.read.parquet(f"{out}/days").groupBy(*keys, "ds").agg(F.sum(name).alias(name))


def _value(kind: str, n: int, buffer: list[float]) -> float | None:
    """One series feature from the actual values before a day; None where a row has too few."""
    if kind == "lag":
        return buffer[-n] if len(buffer) >= n else None
    if kind == "rolling_mean":
        return float(np.mean(buffer[-n:])) if buffer else None
    if kind == "rolling_std":
        recent = buffer[-n:]
        return float(np.std(recent, ddof=1)) if len(recent) > 1 else None
    return buffer[-1] - buffer[-2] if len(buffer) > 1 else None


def feature_stream(
    daily: DataFrame, key: str, features: Sequence[str], ts: str = "ds", y: str = "y", buffer_size: int = BUFFER
) -> DataFrame:
    """Each closed day with its series features; the state is the last few values per series.

    Days have to arrive in order per series, as ``read_closed_days`` delivers them.
    """
    parsed = [(name, *parse_feature(name)) for name in features]
    size = max([buffer_size, *[n for _, _, n in parsed]])
    columns = [key, ts, y, *features]

    def advance(
        group: tuple, frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        buffer = list(state.get[0]) if state.exists else []
        rows = pd.concat(list(frames)).sort_values(ts)
        out = []
        for day, value in zip(rows[ts], rows[y]):
            made = [_value(kind, n, buffer) for _, kind, n in parsed]
            out.append((group[0], day, value, *made))
            buffer = [*buffer, float(value)][-size:]
        state.update((buffer,))
        yield pd.DataFrame(out, columns=columns).astype({f: "float64" for f in features})

    types = {f.name: f.dataType.simpleString() for f in daily.schema}
    schema = f"`{key}` {types[key]}, `{ts}` {types[ts]}, `{y}` {types[y]}, " + ", ".join(
        f"`{f}` double" for f in features
    )
    return daily.groupBy(key).applyInPandasWithState(
        advance, schema, "buffer array<double>", "append", GroupStateTimeout.NoTimeout
    )


_DAY_MS = 86_400_000


def _day_ms(day: date) -> int:
    return (day - date(1970, 1, 1)).days * _DAY_MS


class _OrderedDays(StatefulProcessor):
    """Keeps days until the watermark has passed them, then lets them go in order."""

    def __init__(self, key: str, ts: str, y: str, parsed: Sequence[tuple[str, str, int]], size: int):
        self.ts, self.y, self.parsed, self.size = ts, y, parsed, size
        self.names = [key, ts, y, *(name for name, *_ in parsed)]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "day date, value double")
        self.recent = handle.getValueState("recent", "value array<double>")

    def handleInputRows(self, key, rows, timerValues):
        for row in rows:
            self.waiting.appendValue((row[self.ts], float(row[self.y])))
            self.handle.registerTimer(_day_ms(row[self.ts]))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        passed = timerValues.getCurrentWatermarkInMs()
        waiting = sorted((r[0], r[1]) for r in self.waiting.get())
        ready = [r for r in waiting if _day_ms(r[0]) <= passed]
        if not ready:  # an earlier timer of this batch let them go
            return
        buffer = list(self.recent.get()[0]) if self.recent.exists() else []
        for day, value in ready:
            made = [_value(kind, n, buffer) for _, kind, n in self.parsed]
            yield Row(**dict(zip(self.names, [*key, day, value, *made])))
            buffer = [*buffer, value][-self.size :]
        self.recent.update((buffer,))
        if len(ready) < len(waiting):
            self.waiting.put(waiting[len(ready) :])
        else:
            self.waiting.clear()


def ordered_feature_stream(
    daily: DataFrame, key: str, features: Sequence[str], delay: str, ts: str = "ds", y: str = "y", buffer_size: int = BUFFER
) -> DataFrame:
    """Each day with its series features, days arriving in any order within ``delay``.

    The state of a series are the days that still wait and its last values. A day goes on when the newest
    day of all series is ``delay`` ahead of it; one that comes later than that is dropped, which
    ``run_available`` reports. State is kept in RocksDB, which the session has to be set to.
    """
    parsed = [(name, *parse_feature(name)) for name in features]
    size = max([buffer_size, *[n for _, _, n in parsed]])
    types = {f.name: f.dataType.simpleString() for f in daily.schema}
    schema = f"`{key}` {types[key]}, `{ts}` {types[ts]}, `{y}` double, " + ", ".join(f"`{f}` double" for f in features)
    clock = F.to_utc_timestamp(F.col(ts).cast("timestamp"), "UTC").alias("_clock")
    timed = daily.select(key, ts, y, clock).withWatermark("_clock", delay)
    return timed.groupBy(key).transformWithState(_OrderedDays(key, ts, y, parsed, size), schema, "Append", "EventTime")


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started within keep their state in RocksDB; the session's own choice holds again behind it."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
