"""Reading tables and looking at them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    null_values: Sequence[str] = (),
) -> DataFrame:
    """Read parquet or headed CSV.

    CSV takes a declared ``schema``; without one all columns are inferred, which costs
    an extra pass. ``null_values`` are the text tokens that mean null in any column.
    """
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    reader = spark.read.option("header", True)
    if schema is not None:
        if not null_values:
            return reader.schema(schema).csv(path)
        text = reader.schema(_as_text(schema)).csv(path)
        return cast_text(null_out(text, [*null_values, ""]), schema)
    if len(null_values) > 1:
        raise ValueError("several null tokens need a declared schema")
    for token in null_values:
        reader = reader.option("nullValue", token)
    return reader.option("inferSchema", True).csv(path)


def _as_text(schema: StructType) -> StructType:
    return StructType([StructField(f.name, StringType(), True) for f in schema])


def null_out(df: DataFrame, tokens: Iterable[str]) -> DataFrame:
    """Turn the given tokens into null in every text column."""
    tokens = list(tokens)
    return df.withColumns(
        {
            f.name: F.when(~F.col(f.name).isin(tokens), F.col(f.name))
            for f in df.schema
            if isinstance(f.dataType, StringType)
        }
    )


def cast_text(df: DataFrame, schema: StructType) -> DataFrame:
    """Strict cast of text columns to a declared schema; bad text raises."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def shape(df: DataFrame) -> DataFrame:
    """One row: how many rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("long")
    )


def schema_table(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")


def head(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """First ``n`` rows in a stated order, so that the preview is repeatable."""
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in order]).limit(n)
