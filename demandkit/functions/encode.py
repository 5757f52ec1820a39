"""One-hot expressions over a declared category list."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column

from demandkit.functions.scalars import flag


def one_hot(col: Column, categories: Iterable, prefix: str) -> dict[str, Column]:
    """``prefix_category`` flags; a value outside the list gets zeros everywhere."""
    return {f"{prefix}_{value}": flag(col == value) for value in categories}
