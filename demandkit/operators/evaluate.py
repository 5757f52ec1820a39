"""Errors, model comparison, cross-validation and parameter search."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from demandkit.functions.scalars import absolute_error, improvement_percent
from demandkit.operators.choose import best_row, top_k
from demandkit.operators.folds import folds_of, time_folds
from demandkit.operators.linear import (
    cross_validate_linear,
    fold_errors,
    fold_sums,
    sums_of_subset,
)
from demandkit.session import checkpointed

# fit_fn(train rows, validation rows) returns a function that adds ``prediction`` to any rows; the
# validation rows are there for models that stop by them, others leave them alone
FitFn = Callable[[DataFrame, DataFrame], Callable[[DataFrame], DataFrame]]


def rmse_of(y: Column, prediction: Column) -> Column:
    return F.sqrt(F.avg(F.pow(y.cast("double") - prediction, F.lit(2.0))))


def rmse(df: DataFrame, y: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), rmse_of(F.col(y), F.col(prediction)).alias("rmse")
    )


def fold_summary(folds: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean and population std of the fold errors, and the error pooled over all rows judged.

    Folds without an error, as nothing came before them, are counted in ``n_untrained`` only.
    """
    judged = F.when(F.col("rmse").isNotNull(), F.col("n"))
    pooled = F.sqrt(F.sum(F.col("n") * F.col("rmse") * F.col("rmse")) / F.sum(judged))
    return folds.groupBy(*by).agg(
        F.count("rmse").alias("n_folds"),
        F.count_if(F.col("rmse").isNull()).alias("n_untrained"),
        F.avg("rmse").alias("mean_rmse"),
        F.stddev_pop("rmse").alias("std_rmse"),
        pooled.alias("pooled_rmse"),
    )


def compare_models(results: DataFrame, baseline: str, metric: str = "mean_rmse") -> DataFrame:
    """Add the improvement over the baseline model in percent. ``results`` has ``model``."""
    reference = results.filter(F.col("model") == baseline).agg(F.min(metric).alias("m")).scalar()
    return results.withColumn("improvement", improvement_percent(reference, F.col(metric)))


def best_model(results: DataFrame, metric: str = "mean_rmse", listed: str = "listed") -> DataFrame:
    return best_row(results, metric, listed)


def residuals(df: DataFrame, y: str, prediction: str) -> DataFrame:
    return df.withColumn("abs_error", absolute_error(F.col(y), F.col(prediction)))


def worst_errors(df: DataFrame, y: str, prediction: str, k: int, ties: Sequence[str]) -> DataFrame:
    return top_k(residuals(df, y, prediction), "abs_error", k, ties)


def out_of_fold(
    df: DataFrame, fit_fn: FitFn, ts: str, n_splits: int = 5, parallelism: int = 2
) -> DataFrame:
    """Validation rows of every fold, scored by a model fitted on the rows before them.

    The rows are materialised once, since every fit reads them several times.
    """
    blocks = checkpointed(time_folds(df, ts, n_splits))
    return _score_folds(blocks, fit_fn, n_splits, parallelism)


def _score_folds(blocks: DataFrame, fit_fn: FitFn, n_splits: int, parallelism: int) -> DataFrame:
    """Folds are fitted a few at a time; every fit is a distributed job of its own."""

    def run(part: tuple[int, DataFrame, DataFrame]) -> DataFrame:
        fold, train, validation = part
        train, validation = train.drop("block"), validation.drop("block")
        scored = fit_fn(train, validation)(validation)
        return scored.withColumn("fold", F.lit(fold))

    with ThreadPoolExecutor(parallelism) as pool:
        parts = list(pool.map(run, folds_of(blocks, n_splits)))
    return reduce(DataFrame.unionByName, parts)


def cross_validate(
    df: DataFrame, fit_fn: FitFn, y: str, ts: str, n_splits: int = 5, parallelism: int = 2
) -> DataFrame:
    """RMSE per fold for any model: ``fold, n, rmse``."""
    return rmse(out_of_fold(df, fit_fn, ts, n_splits, parallelism), y, "prediction", ["fold"])


def compare_feature_sets(
    df: DataFrame,
    sets: Mapping[str, Sequence[str]],
    y: str,
    ts: str,
    n_splits: int = 5,
    alpha: float = 0.0,
    standardise: bool = False,
) -> DataFrame:
    """Linear cross-validation per named feature list: ``model, listed, …, improvement``.

    All sets share one pass over the rows and are judged on the same ones, those where the
    features of every set are known. Improvement is over the first set.
    """
    features = list(dict.fromkeys(name for names in sets.values() for name in names))
    sums = fold_sums(df, features, y, ts, n_splits)
    parts = []
    for i, (name, subset) in enumerate(sets.items()):
        own = sums_of_subset(sums, features, subset, ["block"])
        folds = fold_errors(own, subset, n_splits, alphas=(alpha,), standardise=standardise)
        parts.append(
            fold_summary(folds).select(F.lit(name).alias("model"), F.lit(i).alias("listed"), "*")
        )
    # a row per set; the baseline is read from it once more
    return compare_models(checkpointed(reduce(DataFrame.unionByName, parts)), next(iter(sets)))


def ridge_path(
    df: DataFrame,
    features: Sequence[str],
    y: str,
    ts: str,
    alphas: Sequence[float],
    n_splits: int = 5,
    standardise: bool = False,
) -> DataFrame:
    """Mean fold error per penalty. All penalties share one pass over the rows."""
    folds = cross_validate_linear(
        df, features, y, ts, n_splits, alphas=alphas, standardise=standardise
    )
    return fold_summary(folds, ["alpha"])


def random_candidates(space: Mapping[str, tuple], n: int, seed: int = 42) -> list[dict]:
    """Seeded draws from ``("int", lo, hi)``, ``("float", lo, hi)``, ``("log", lo, hi)`` or
    ``("choice", [...])``."""
    rng = random.Random(seed)

    def draw(rule: tuple):
        kind, *args = rule
        if kind == "int":
            return rng.randint(*args)
        if kind == "float":
            return rng.uniform(*args)
        if kind == "log":
            return math.exp(rng.uniform(math.log(args[0]), math.log(args[1])))
        if kind == "choice":
            return rng.choice(args[0])
        raise ValueError(f"unknown range {kind}")

    return [{name: draw(rule) for name, rule in space.items()} for _ in range(n)]


def search(
    spark: SparkSession,
    df: DataFrame,
    make_fit: Callable[[dict], FitFn],
    candidates: Sequence[dict],
    y: str,
    ts: str,
    n_splits: int = 5,
    parallelism: int = 2,
) -> DataFrame:
    """Mean fold error of every candidate, best first: ``trial, params, mean_rmse, std_rmse``.

    What comes back to the driver is one summary row per trial.
    """
    blocks = checkpointed(time_folds(df, ts, n_splits))
    trials = []
    for i, params in enumerate(candidates):
        scored = _score_folds(blocks, make_fit(params), n_splits, parallelism)
        row = fold_summary(rmse(scored, y, "prediction", ["fold"])).first()
        described = ", ".join(f"{k}={v}" for k, v in sorted(params.items()))
        trials.append((i, described, row["mean_rmse"], row["std_rmse"]))
    frame = spark.createDataFrame(
        trials, "trial int, params string, mean_rmse double, std_rmse double"
    )
    return frame.orderBy(F.col("mean_rmse").asc_nulls_last(), "trial")


def best_params(found: DataFrame, candidates: Sequence[dict]) -> dict:
    """The parameters of the best trial of a ``search`` over these candidates."""
    return candidates[found.orderBy(F.col("mean_rmse").asc_nulls_last(), "trial").first()["trial"]]
