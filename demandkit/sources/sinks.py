"""Writing forecasts and feature tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from demandkit.functions.dates import unpadded_date
from demandkit.functions.scalars import round_even


def submission_frame(df: DataFrame, ts: str, prediction: str, integer: bool = True) -> DataFrame:
    """``datetime`` as unpadded text and ``y``, the two columns of a result file."""
    value = F.col(prediction)
    return df.select(
        unpadded_date(F.col(ts)).alias("datetime"),
        (round_even(value) if integer else value.cast("double")).alias("y"),
    )


def write_submission(
    df: DataFrame, path: str, ts: str, prediction: str, integer: bool = True, single_file: bool = False
) -> None:
    """Headerless CSV in date order. ``single_file`` is for small results only.

    What computes ``df`` keeps its parallelism: only the finished rows come together in one task.
    """
    if single_file:
        ordered = df.select(ts, prediction).repartition(1).sortWithinPartitions(F.col(ts).asc_nulls_last())
    else:
        ordered = df.orderBy(F.col(ts).asc_nulls_last())
    frame = submission_frame(ordered, ts, prediction, integer)
    frame.write.mode("overwrite").option("header", False).csv(path)


def write_features(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """Materialise a feature table, partitioned by low-cardinality columns if given."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.parquet(path)
