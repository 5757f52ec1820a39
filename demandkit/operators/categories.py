"""Very many categories without a column for each: codes from a learned dictionary, and ridge on them.

A one-hot column of a row has a single one, so its place says all; sums of products that skip the zeros
are counts and sums per category. The block of a ridge system that belongs to the categories is diagonal
and is eliminated by arithmetic: what is left to solve is as large as the other features are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from demandkit.operators.joins import lookup_join
from demandkit.operators.linear import cross_sums
from demandkit.operators.series import Series, with_position
from demandkit.session import checkpointed


def learn_codes(df: DataFrame, column: str, name: str = "code") -> DataFrame:
    """``(column, name)``: the distinct values that are not null, numbered from 0 in their order."""
    values = df.select(column).dropna().distinct().withColumn("_all", F.lit(0))
    placed = with_position(values, Series(("_all",), column, daily=False), name)
    return placed.select(column, (F.col(name) - 1).alias(name))


def encode(df: DataFrame, column: str, codes: DataFrame, name: str = "code") -> DataFrame:
    """``df`` with the place of the one in its one-hot vector; null where the value is null or was not learned."""
    return lookup_join(df, codes, [column])


@dataclass
class CategoryRidge:
    """``prediction = intercept + coef . features + effect``; a category that was not seen has effect 0."""

    intercept: float
    coef: list[float]
    effects: DataFrame

    def score(self, df: DataFrame, features: Sequence[str], category: str, name: str = "prediction") -> DataFrame:
        scored = lookup_join(df, self.effects, [category])
        line = reduce(lambda total, p: total + F.col(p[0]).cast("double") * F.lit(p[1]), zip(features, self.coef), F.lit(self.intercept))
        return scored.withColumn(name, line + F.coalesce("effect", F.lit(0.0))).drop("effect")


def fit_category_ridge(df: DataFrame, features: Sequence[str], y: str, category: str, alpha: float = 1.0) -> CategoryRidge:
    """Ridge with one effect per category beside ``features``, as if the category were one-hot columns.

    Features and effects share the penalty ``alpha``, above 0; the intercept has none. Rows with a null
    feature, target or category are left out. The driver solves one system of as many unknowns as there
    are features and one more; categories stay in tables. An empty table raises an error.
    """
    if alpha <= 0:
        raise ValueError("effects of all categories and an intercept need a penalty above 0")
    rows = df.select(category, *[F.col(c).cast("double").alias(c) for c in [*features, y]]).dropna()
    d = len(features)
    per = rows.groupBy(category).agg(
        F.count(F.lit(1)).cast("double").alias("_z0"), *[F.sum(c).alias(f"_z{i + 1}") for i, c in enumerate(features)], F.sum(y).alias("_y")
    )
    per = checkpointed(per)
    weight = F.col("_z0") + F.lit(float(alpha))

    def added(a: str, b: str) -> Column:
        return F.sum(F.col(a) * F.col(b) / weight)

    pairs = [(i, j) for i in range(d + 1) for j in range(i, d + 1)]
    gone = per.agg(*[added(f"_z{i}", f"_z{j}").alias(f"m{i}_{j}") for i, j in pairs], *[added(f"_z{i}", "_y").alias(f"v{i}") for i in range(d + 1)]).first()
    whole = cross_sums(rows, features, y, origin={}).first()
    if not whole["n"]:
        raise ValueError("no rows to fit")
    matrix, right = np.zeros((d + 1, d + 1)), np.zeros(d + 1)
    for i, j in pairs:
        total = whole["n"] if j == 0 else whole[f"sx_{j - 1}"] if i == 0 else whole[f"sxx_{i - 1}_{j - 1}"]
        matrix[i, j] = matrix[j, i] = total - gone[f"m{i}_{j}"] + (alpha if i == j > 0 else 0.0)
    for i in range(d + 1):
        right[i] = (whole["sy"] if i == 0 else whole[f"sxy_{i - 1}"]) - gone[f"v{i}"]
    beta = np.linalg.solve(matrix, right).tolist()
    rest = reduce(lambda total, k: total - F.col(f"_z{k}") * F.lit(beta[k]), range(d + 1), F.col("_y"))
    return CategoryRidge(beta[0], beta[1:], per.select(category, (rest / weight).alias("effect")))
