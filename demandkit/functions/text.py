"""Keyword features over text columns, as plain column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, functions as F

from demandkit.functions.scalars import flag


def contains_flag(col: Column, text: str) -> Column:
    return flag(col.contains(text))


def any_of_flag(col: Column, words: Iterable[str]) -> Column:
    """1 when any of the literal words occurs."""
    return flag(reduce(lambda a, b: a | b, [col.contains(w) for w in words]))


def pattern_flags(col: Column, patterns: Mapping[str, str], prefix: str = "") -> dict[str, Column]:
    """One regex flag per named pattern, ready for a single ``withColumns``."""
    return {prefix + name: flag(col.rlike(pattern)) for name, pattern in patterns.items()}


def keyword_flags(col: Column, words: Mapping[str, Iterable[str]], prefix: str = "") -> dict[str, Column]:
    """One any-of flag per named word list."""
    return {prefix + name: any_of_flag(col, items) for name, items in words.items()}


def keyword_tags(col: Column, patterns: Mapping[str, str]) -> Column:
    """Array of the names whose pattern matches, in declared order; empty, never null."""
    return F.array_compact(
        F.array(*[F.when(col.rlike(pattern), F.lit(name)) for name, pattern in patterns.items()])
    )
