"""Parameter search that learns from its trials: Parzen draws, and losing trials that end early."""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from demandkit.operators import evaluate, grown
from demandkit.session import checkpointed

#: Share of trials that count as good, and draws from them for each new trial.
GOOD, DRAWS = 0.25, 24


def _unit(rule: tuple, value) -> float:
    kind, low, high = rule
    if kind == "log":
        low, high, value = math.log(low), math.log(high), math.log(value)
    return (value - low) / ((high - low) or 1)


def _value(rule: tuple, unit: float):
    kind, low, high = rule
    if kind == "log":
        return min(high, max(low, math.exp(math.log(low) + unit * (math.log(high) - math.log(low)))))
    made = low + unit * (high - low)
    return int(min(high, max(low, round(made)))) if kind == "int" else min(high, max(low, made))


def _density(rule: tuple, known: Sequence, value) -> float:
    """How close ``value`` is to the ``known`` ones, with a little of every value mixed in."""
    if rule[0] == "choice":
        return (known.count(value) + 1) / (len(known) + len(rule[1]))
    width = max(0.1, len(known) ** -0.5 / 2)
    at = _unit(rule, value)
    bumps = [math.exp(-(((at - _unit(rule, k)) / width) ** 2) / 2) / (width * math.sqrt(2 * math.pi)) for k in known]
    return (sum(bumps) + 1) / (len(known) + 1)


def parzen_candidates(space: Mapping[str, tuple], trials: Sequence[tuple[dict, float]], n: int, rng: random.Random) -> list[dict]:
    """``n`` new parameter sets, likelier near good trials than near others; never one that was tried.

    ``space`` is as in ``random_candidates``. Without trials the draws are random. A space of choices
    alone may have fewer sets left.
    """
    tried = [params for params, _ in trials]
    made: list[dict] = []
    ranked = [params for params, _ in sorted(trials, key=lambda t: t[1])]
    n_good = max(1, math.ceil(GOOD * len(ranked)))
    good, rest = ranked[:n_good], ranked[n_good:]

    def draw() -> dict:
        if not ranked:
            return evaluate.random_candidates(space, 1, rng.randrange(1 << 30))[0]
        out = {}
        for name, rule in space.items():
            near = [g[name] for g in good]
            if rule[0] == "choice":
                weights = [near.count(v) + 1 for v in rule[1]]
                out[name] = rng.choices(rule[1], weights)[0]
            else:
                width = max(0.1, len(near) ** -0.5 / 2)
                anywhere = rng.random() < 1 / (len(near) + 1)
                at = rng.random() if anywhere else rng.gauss(_unit(rule, rng.choice(near)), width)
                out[name] = _value(rule, min(1.0, max(0.0, at)))
        return out

    def worth(params: dict) -> float:
        return sum(math.log(_density(r, [g[k] for g in good], params[k])) - math.log(_density(r, [x[k] for x in rest], params[k])) for k, r in space.items())

    while len(made) < n:
        new = [p for p in (draw() for _ in range(DRAWS)) if p not in tried and p not in made]
        if not new:
            new = [p for p in evaluate.random_candidates(space, 50 * DRAWS, rng.randrange(1 << 30)) if p not in tried and p not in made][:1]
        if not new:
            return made
        made.append(max(new, key=worth) if ranked else new[0])
    return made


def adaptive_search(
    spark: SparkSession, blocks: DataFrame, features: int, space: Mapping[str, tuple], batches: int = 3, per_batch: int = 8,
    rounds: int = 32, halvings: Sequence[int] = (4, 8, 16), n_splits: int = 5, depth: int = 3, seed: int = 42,
) -> DataFrame:
    """``trial, batch, <one column per parameter>, rounds, mean_rmse, fold_rounds``, one row per trial.

    ``blocks(bins, y, block)`` are binned rows with their fold block, see ``time_folds``. Trials of a batch
    are boosted side by side, a model for each trial and fold. After the rounds in ``halvings`` the worse
    half of them, by the mean error of their folds, ends. The next batch is drawn near the good trials so
    far, among which those that went on longest come first. ``fold_rounds`` counts the rounds of all
    folds, which is what a trial costs. Draws follow from the seed; what comes to the driver is one row
    per trial.
    """
    blocks = checkpointed(blocks.where("y is not null").select("bins", "y", "block"))
    rng, trials, rows = random.Random(seed), [], []
    names = list(space)
    for batch in range(batches):
        drawn = parzen_candidates(space, [(p, (-made, error)) for p, made, error in trials], per_batch, rng)
        if not drawn:
            break
        keys = [len(rows) + i for i in range(len(drawn))]
        of_trials = F.explode(F.array(*[F.lit(k) for k in keys])).alias("trial")
        folds = F.explode(F.sequence(F.greatest(F.col("block"), F.lit(1)), F.lit(n_splits))).alias("fold")
        spread = blocks.select("*", folds).select("*", of_trials)
        model = F.concat_ws("/", F.col("trial").cast("string"), F.col("fold").cast("string"))
        spread = spread.select(model.alias("model"), "bins", "y", (F.col("block") == F.col("fold")).alias("valid"))
        params = spark.createDataFrame(
            [(f"{k}/{f}", *[float(p[c]) for c in names]) for k, p in zip(keys, drawn) for f in range(1, n_splits + 1)],
            "model string, " + ", ".join(f"{c} double" for c in names),
        )
        trial = F.substring_index("model", "/", 1).cast("int")

        def keep(errors: DataFrame, turn: int) -> DataFrame | None:
            if turn not in halvings:
                return None
            now = errors.where(F.col("round") == turn)
            means = sorted((r.e, r.trial) for r in now.groupBy(trial.alias("trial")).agg(F.round(F.avg("rmse"), 9).alias("e")).collect())
            left = [t for _, t in means[: math.ceil(len(means) / 2)]]
            return now.where(trial.isin(left))

        fitted = grown.fit_boosted_many(spread, features, rounds, depth, seed=seed, params=params, keep=keep)
        by_round = fitted.errors.groupBy(trial.alias("trial"), "round").agg(F.avg("rmse").alias("e"), F.count(F.lit(1)).alias("folds"))
        last = F.max(F.struct("round", "e")).alias("last")
        found = {r.trial: r for r in by_round.groupBy("trial").agg(last, F.sum("folds").alias("cost")).collect()}
        for key, params_of in zip(keys, drawn):
            end = found[key]
            trials.append((params_of, end.last.round, end.last.e))
            rows.append((key, batch, *[float(params_of[c]) for c in names], end.last.round, end.last.e, end.cost))
    schema = "trial int, batch int, " + "".join(f"{c} double, " for c in names) + "rounds int, mean_rmse double, fold_rounds long"
    return spark.createDataFrame(rows, schema)


def best_trial(found: DataFrame) -> DataFrame:
    """The row with the smallest error among those that made the most rounds; the first of equals."""
    return found.orderBy(F.col("rounds").desc(), F.round("mean_rmse", 9), "trial").limit(1)
