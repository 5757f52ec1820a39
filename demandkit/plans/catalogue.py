"""Registry of runnable queries, each with its SQL twin where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is what another engine would run on the same tables."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            TWINS[name] = sql.strip()
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(col: Column | str, name: str, digits: int = 6) -> Column:
    """Round away the last digits, which depend on the order of summation."""
    return F.round(F.col(col) if isinstance(col, str) else col, digits).alias(name)


def day_text(col: str = "ds") -> Column:
    return F.date_format(col, "yyyy-MM-dd").alias(col)
