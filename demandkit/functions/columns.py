"""Choosing and adding columns by schema."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NumericType


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType)]


def select_numeric(df: DataFrame) -> DataFrame:
    return df.select(*numeric_columns(df))


def feature_columns(df: DataFrame, exclude: Iterable[str]) -> list[str]:
    dropped = set(exclude)
    return [c for c in df.columns if c not in dropped]


def available(df: DataFrame, wanted: Iterable[str]) -> list[str]:
    """The wanted columns that exist, in the wanted order."""
    present = set(df.columns)
    return [c for c in wanted if c in present]


def add_missing(df: DataFrame, defaults: Mapping[str, object], dtype: str = "double") -> DataFrame:
    """Add each absent column as a typed constant (``None`` for a placeholder)."""
    missing = {c: F.lit(v).cast(dtype) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df
