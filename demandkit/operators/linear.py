"""Linear and ridge regression from cross-product sums.

One pass over the rows collects, per group and time block, the sums of all products of
features and target. They add up over blocks, so every expanding fold, every series and
every penalty is solved from the same small table. The d by d systems are solved in batches
inside tasks; no group's rows are ever gathered.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from demandkit.operators.folds import block_of, fold_cuts
from demandkit.operators.joins import attach_row, lookup_join
from demandkit.session import checkpointed


# Beyond this many features the products are added up as one vector: hundreds of separate sum
# aggregates do not compile into one loop any more.
WIDE = 12

# per-column numbers, a one-row frame holding them, or None for the means of the rows
Origin = Mapping[str, float] | DataFrame | None


def _pairs(d: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(d) for j in range(i, d)]


def _sum_names(features: Sequence[str]) -> list[str]:
    d = len(features)
    return (
        ["n", "sy", "syy"]
        + [f"sx_{i}" for i in range(d)]
        + [f"sxy_{i}" for i in range(d)]
        + [f"sxx_{i}_{j}" for i, j in _pairs(d)]
    )


def cross_sums(
    df: DataFrame,
    features: Sequence[str],
    y: str,
    by: Sequence[str] = (),
    origin: Origin = None,
) -> DataFrame:
    """Product sums per group, taken around an origin to keep their digits.

    The origin defaults to the overall means, one extra aggregate pass; pass numbers, or a
    one-row frame with the columns, to save it. Rows with a null feature or target are left out.
    """
    columns = [*features, y]
    rows = df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns]).dropna(subset=columns)
    if origin is None:
        origin = rows.agg(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in columns])

    def centered(frame: DataFrame) -> tuple[DataFrame, list[Column]]:
        if isinstance(origin, DataFrame):
            return attach_row(frame, origin, "_origin"), [F.col("_origin")[c] for c in columns]
        return frame, [F.lit(float(origin.get(c, 0.0))) for c in columns]

    rows, shift = centered(rows)
    moved = rows.select(
        *by,
        *[(F.col(c) - o).alias(f"_x{i}") for i, (c, o) in enumerate(zip(features, shift))],
        (F.col(y) - shift[-1]).alias("_y"),
    )
    add_up = _wide_sums if len(features) > WIDE else _plain_sums
    # the origin joins after the aggregate: an array in its buffer would force a sort
    totals, shift = centered(add_up(moved, len(features), by))
    return totals.withColumns({f"o_{i}": o for i, o in enumerate(shift)}).drop("_origin")


def _plain_sums(moved: DataFrame, d: int, by: Sequence[str]) -> DataFrame:
    xs, yc = [F.col(f"_x{i}") for i in range(d)], F.col("_y")
    sums = [F.count(F.lit(1)).cast("double").alias("n"), F.sum(yc).alias("sy"), F.sum(yc * yc).alias("syy")]
    sums += [F.sum(x).alias(f"sx_{i}") for i, x in enumerate(xs)]
    sums += [F.sum(x * yc).alias(f"sxy_{i}") for i, x in enumerate(xs)]
    sums += [F.sum(xs[i] * xs[j]).alias(f"sxx_{i}_{j}") for i, j in _pairs(d)]
    return moved.groupBy(*by).agg(*sums)


def _wide_sums(moved: DataFrame, d: int, by: Sequence[str]) -> DataFrame:
    """The same sums as one vector aggregate over the packed products of each row."""
    z = [F.lit(1.0), *[F.col(f"_x{i}") for i in range(d)], F.col("_y")]
    packed = {pair: n for n, pair in enumerate(_pairs(d + 2))}
    products = array_to_vector(F.array(*[z[i] * z[j] for i, j in packed]))
    added = moved.select(*by, products.alias("_z")).groupBy(*by).agg(vector_to_array(Summarizer.sum(F.col("_z"))).alias("_m"))

    def entry(i: int, j: int) -> Column:
        return F.get("_m", F.lit(packed[i, j]))

    # row 0 is the constant, rows 1 to d the features, the last one the target
    sums = [F.round(entry(0, 0)).alias("n"), entry(0, d + 1).alias("sy"), entry(d + 1, d + 1).alias("syy")]
    sums += [entry(0, i + 1).alias(f"sx_{i}") for i in range(d)]
    sums += [entry(i + 1, d + 1).alias(f"sxy_{i}") for i in range(d)]
    sums += [entry(i + 1, j + 1).alias(f"sxx_{i}_{j}") for i, j in _pairs(d)]
    return added.select(*by, *sums)


def expanding_sums(
    sums: DataFrame, features: Sequence[str], n_splits: int, by: Sequence[str] = (), block: str = "block"
) -> DataFrame:
    """Sums of the training part of every fold: all blocks before it."""
    exploded = sums.withColumn(
        "fold", F.explode(F.sequence(F.lit(1), F.lit(n_splits)))
    ).filter(F.col(block) < F.col("fold"))
    origin = [f"o_{i}" for i in range(len(features) + 1)]
    return exploded.groupBy(*by, "fold").agg(
        *[F.sum(c).alias(c) for c in _sum_names(features)], *[F.max(c).alias(c) for c in origin]
    )


def _packed(sums: DataFrame, features: Sequence[str], prefix: str = "") -> list[Column]:
    d = len(features)
    return [
        F.col("n").alias(prefix + "n"),
        F.col("sy").alias(prefix + "sy"),
        F.col("syy").alias(prefix + "syy"),
        F.array(*[F.col(f"sx_{i}") for i in range(d)]).alias(prefix + "sx"),
        F.array(*[F.col(f"sxy_{i}") for i in range(d)]).alias(prefix + "sxy"),
        F.array(*[F.col(f"sxx_{min(i, j)}_{max(i, j)}") for i in range(d) for j in range(d)]).alias(
            prefix + "sxx"
        ),
        F.array(*[F.col(f"o_{i}") for i in range(d + 1)]).alias(prefix + "origin"),
    ]


def _stack(pdf: pd.DataFrame, column: str) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=float) for v in pdf[column]])


def _solve_batch(pdf: pd.DataFrame, d: int, standardise: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slopes, intercepts and column spreads for one batch of packed sums."""
    n = pdf["n"].to_numpy()[:, None]
    sx, origin = _stack(pdf, "sx"), _stack(pdf, "origin")
    sy = pdf["sy"].to_numpy()[:, None]
    mean_x, mean_y = sx / n, sy / n
    cross = _stack(pdf, "sxx").reshape(-1, d, d) - n[:, :, None] * mean_x[:, :, None] * mean_x[:, None, :]
    target = _stack(pdf, "sxy") - n * mean_x * mean_y
    spread = np.sqrt(np.maximum(np.einsum("bii->bi", cross), 0.0) / n)
    scale = np.where(spread > 0, spread, 1.0) if standardise else np.ones_like(spread)
    cross = cross / scale[:, :, None] / scale[:, None, :]
    target = target / scale
    alpha = pdf["alpha"].to_numpy()[:, None, None]
    system = cross + alpha * np.eye(d)
    # the pseudo-inverse gives the least-norm fit where columns are collinear
    slopes = np.einsum("bij,bj->bi", np.linalg.pinv(system, rcond=1e-12, hermitian=True), target) / scale
    intercepts = (mean_y[:, 0] + origin[:, d]) - np.einsum(
        "bi,bi->b", slopes, mean_x + origin[:, :d]
    )
    return slopes, intercepts, spread


def solve(
    sums: DataFrame,
    features: Sequence[str],
    by: Sequence[str] = (),
    alphas: Sequence[float] = (0.0,),
    standardise: bool = False,
) -> DataFrame:
    """``by, alpha, intercept, coef, spread`` per group and penalty; penalty 0 is least squares.

    The intercept is not penalised. With ``standardise`` the penalty acts on features scaled
    to unit population std; coefficients always apply to the raw features.
    """
    by, d = list(by), len(features)
    penalties = F.explode(F.array(*[F.lit(float(a)) for a in alphas])).alias("alpha")
    packed = sums.select(*by, *_packed(sums, features)).select("*", penalties)
    keyed = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in sums.schema if f.name in by
    )
    schema = (keyed + ", " if keyed else "") + (
        "alpha double, n double, intercept double, coef array<double>, spread array<double>"
    )
    order = [f.name for f in sums.schema if f.name in by]

    def fit(batches):
        for pdf in batches:
            if len(pdf):
                slopes, intercepts, spread = _solve_batch(pdf, d, standardise)
                yield pdf[[*order, "alpha", "n"]].assign(
                    intercept=intercepts, coef=list(slopes), spread=list(spread)
                )

    return packed.mapInPandas(fit, schema)


def fit_linear(
    df: DataFrame,
    features: Sequence[str],
    y: str,
    by: Sequence[str] = (),
    alpha: float = 0.0,
    standardise: bool = False,
    origin: Origin = None,
) -> DataFrame:
    """Least squares (``alpha=0``) or ridge, one model per group."""
    return solve(cross_sums(df, features, y, by, origin), features, by, (alpha,), standardise)


def linear_value(intercept: Column, coef: Column, xs: Sequence[Column]) -> Column:
    """``intercept + coef · xs``, written out so that it stays in generated code."""
    value = intercept
    for i, x in enumerate(xs):
        value = value + F.get(coef, F.lit(i)) * x
    return value


def score(
    df: DataFrame,
    models: DataFrame,
    features: Sequence[str],
    by: Sequence[str] = (),
    name: str = "prediction",
    bounded: bool = False,
) -> DataFrame:
    """Add predictions. A single model reaches the rows as a constant, grouped ones by a lookup.

    ``bounded`` says the models are few by construction, such as one per fold. Rows of a
    group without a model keep a null prediction.
    """
    xs = [F.col(c).cast("double") for c in features]
    if not by:
        joined = attach_row(df, models.select("intercept", "coef"), "_model")
        model = F.col("_model")
        value = linear_value(model["intercept"], model["coef"], xs)
        return joined.withColumn(name, value).drop("_model")
    lookup = models.select(*by, F.col("intercept").alias("_b"), F.col("coef").alias("_w"))
    joined = lookup_join(df, lookup, by, "left", bounded)
    return joined.withColumn(name, linear_value(F.col("_b"), F.col("_w"), xs)).drop("_b", "_w")


def coefficient_importance(models: DataFrame, features: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Size of each coefficient on standardised features: ``by, feature, importance``."""
    names = F.array(*[F.lit(c) for c in features])
    size = F.zip_with("coef", "spread", lambda w, s: F.abs(w * s))
    return models.select(*by, F.posexplode(size).alias("_i", "importance")).select(
        *by, F.get(names, F.col("_i")).alias("feature"), "importance"
    )


def _squared_errors(pdf: pd.DataFrame, d: int, slopes: np.ndarray, intercepts: np.ndarray) -> np.ndarray:
    """Sum of squared errors of a validation block, from its product sums alone."""
    n, sy, syy = (pdf[c].to_numpy() for c in ["v_n", "v_sy", "v_syy"])
    sx, sxy, origin = (_stack(pdf, c) for c in ["v_sx", "v_sxy", "v_origin"])
    sxx = _stack(pdf, "v_sxx").reshape(-1, d, d)
    shift = intercepts - origin[:, d] + np.einsum("bi,bi->b", slopes, origin[:, :d])
    sse = (
        syy + n * shift**2 + np.einsum("bi,bij,bj->b", slopes, sxx, slopes)
        - 2 * shift * sy - 2 * np.einsum("bi,bi->b", slopes, sxy)
        + 2 * shift * np.einsum("bi,bi->b", slopes, sx)
    )
    return np.maximum(sse, 0.0)


def _blocks_and_center(
    df: DataFrame,
    features: Sequence[str],
    y: str,
    ts: str,
    n_splits: int,
    origin: Origin,
) -> tuple[DataFrame, Origin]:
    """Rows with their time block, and the origin, both from one aggregate."""
    columns = [] if origin is not None else [*features, y]
    means = [F.coalesce(F.avg(F.col(c).cast("double")), F.lit(0.0)).alias(c) for c in columns]
    known = fold_cuts(df, ts, n_splits, means)
    cut = attach_row(df, known, "_known")
    blocks = cut.withColumn("block", block_of(F.col(ts), F.col("_known")["cuts"], n_splits))
    return blocks.drop("_known"), known if origin is None else origin


def fold_sums(
    df: DataFrame,
    features: Sequence[str],
    y: str,
    ts: str,
    n_splits: int = 5,
    by: Sequence[str] = (),
    origin: Origin = None,
) -> DataFrame:
    """Materialised cross-product sums per group and time block."""
    needed = df.select(*dict.fromkeys([*by, ts, y, *features]))
    blocks, center = _blocks_and_center(needed, features, y, ts, n_splits, origin)
    return checkpointed(cross_sums(blocks, features, y, [*by, "block"], center))


def sums_of_subset(
    sums: DataFrame, features: Sequence[str], subset: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """The sums a subset of the features would have given."""
    place = {name: i for i, name in enumerate(features)}
    at = [place[name] for name in subset]
    picked = [F.col(f"sx_{i}").alias(f"sx_{k}") for k, i in enumerate(at)]
    picked += [F.col(f"sxy_{i}").alias(f"sxy_{k}") for k, i in enumerate(at)]
    picked += [
        F.col(f"sxx_{min(at[k], at[m])}_{max(at[k], at[m])}").alias(f"sxx_{k}_{m}")
        for k, m in _pairs(len(at))
    ]
    picked += [F.col(f"o_{i}").alias(f"o_{k}") for k, i in enumerate([*at, len(features)])]
    return sums.select(*by, "n", "sy", "syy", *picked)


def fold_errors(
    sums: DataFrame,
    features: Sequence[str],
    n_splits: int = 5,
    by: Sequence[str] = (),
    alphas: Sequence[float] = (0.0,),
    standardise: bool = False,
) -> DataFrame:
    """RMSE per group, penalty and fold from the sums alone: ``by, alpha, fold, n, sse, rmse``.

    A group that has no rows before a fold has no model there: ``n`` counts its rows, the errors
    are null.
    """
    by, d = list(by), len(features)
    train = expanding_sums(sums, features, n_splits, by)
    validation = sums.filter("block > 0").select(
        *by, F.col("block").alias("fold"), *_packed(sums, features, "v_")
    )
    keyed_on = [*by, "fold"]
    trained = train.select(*[F.col(c).alias(f"_t_{c}") for c in keyed_on], *_packed(train, features))
    same = reduce(lambda a, b: a & b, [validation[c].eqNullSafe(trained[f"_t_{c}"]) for c in keyed_on])
    both = validation.join(trained, same).drop(*[f"_t_{c}" for c in keyed_on])
    penalties = F.explode(F.array(*[F.lit(float(a)) for a in alphas])).alias("alpha")
    fields = [f for f in sums.schema if f.name in by]
    keyed = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields)

    def evaluate(batches):
        for pdf in batches:
            if len(pdf):
                slopes, intercepts, _ = _solve_batch(pdf, d, standardise)
                sse = _squared_errors(pdf, d, slopes, intercepts)
                yield pdf[[*[f.name for f in fields], "alpha", "fold", "v_n"]].assign(
                    sse=sse, rmse=np.sqrt(sse / pdf["v_n"].to_numpy())
                )

    schema = keyed + "alpha double, fold int, v_n double, sse double, rmse double"
    scored = both.select("*", penalties).mapInPandas(evaluate, schema)
    scored = scored.withColumn("v_n", F.col("v_n").cast("long")).withColumnRenamed("v_n", "n")
    # a group without rows before a fold has no model for it: its rows count, its error is null
    untrained = validation.join(trained, same, "left_anti").select(
        *by, penalties, "fold", F.col("v_n").cast("long").alias("n"), *[F.lit(None).cast("double").alias(c) for c in ("sse", "rmse")]
    )
    return scored.select(*by, "alpha", "fold", "n", "sse", "rmse").unionByName(untrained)


def cross_validate_linear(
    df: DataFrame,
    features: Sequence[str],
    y: str,
    ts: str,
    n_splits: int = 5,
    by: Sequence[str] = (),
    alphas: Sequence[float] = (0.0,),
    standardise: bool = False,
    origin: Origin = None,
) -> DataFrame:
    """RMSE per group, penalty and fold: ``by, alpha, fold, n, sse, rmse``.

    One pass finds the cut dates and the means, a second one serves all folds and all
    penalties, scoring included.
    """
    sums = fold_sums(df, features, y, ts, n_splits, by, origin)
    return fold_errors(sums, features, n_splits, by, alphas, standardise)


def out_of_fold_linear(
    df: DataFrame,
    features: Sequence[str],
    y: str,
    ts: str,
    n_splits: int = 5,
    alpha: float = 0.0,
    standardise: bool = False,
    origin: Origin = None,
) -> DataFrame:
    """Validation rows of every fold with ``fold`` and ``prediction``."""
    blocks, center = _blocks_and_center(df, features, y, ts, n_splits, origin)
    sums = cross_sums(blocks, features, y, ["block"], center)
    models = solve(expanding_sums(sums, features, n_splits), features, ["fold"], (alpha,), standardise)
    rows = blocks.filter("block > 0").withColumnRenamed("block", "fold")
    return score(rows, models, features, ["fold"], bounded=True)
