"""Trees for many models at once, and the search that learns from its trials."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandkit.operators import grown, tune

SCHEMA = "model string, bins array<int>, y double, valid boolean"


def sample(seed, models=3, n=120):
    rnd = random.Random(seed)
    rows = []
    for m in range(models):
        for _ in range(n):
            bins = [rnd.randrange(5), rnd.randrange(3), rnd.randrange(8)]
            y = 3.0 * (bins[0] > m) + bins[2] * (bins[1] == 1) + rnd.choice([0.0, 0.5, 1.0])
            rows.append((f"m{m}", bins, y, rnd.random() < 0.25))
    return rows


def plain_tree(rows, depth, leaves, penalty, min_rows, rate):
    """Rows of bins and gradients; returns a function from bins to the leaf's value."""
    nodes = [(None, [r for r in rows], 0.0)]

    def best(part):
        found = None
        g, h = sum(r for _, r in part), len(part)
        for f in range(len(part[0][0])):
            for b in sorted({x[f] for x, _ in part}):
                left = [r for x, r in part if x[f] <= b]
                if min(len(left), h - len(left)) < max(min_rows, 1):
                    continue
                gl, hl = sum(left), len(left)
                gain = round(gl**2 / (hl + penalty) + (g - gl) ** 2 / (h - hl + penalty) - g**2 / (h + penalty), 6)
                if gain > 0 and (found is None or (gain, -f, -b) > found[0]):
                    found = (gain, -f, -b), f, b, rate * gl / (hl + penalty), rate * (g - gl) / (h - hl + penalty)
        return found

    tree = {0: None}
    open_nodes, parts, values = [0], {0: rows}, {0: 0.0}
    count = 1
    for _ in range(depth):
        wishes = sorted(((best(parts[n]), n) for n in open_nodes if parts[n] and best(parts[n])), key=lambda w: (-w[0][0][0], w[1]))
        wishes = sorted(wishes[: leaves - count], key=lambda w: w[1])
        count += len(wishes)
        opened, size = [], len(tree)
        for k, ((_, f, b, low, high), n) in enumerate(wishes):
            left, right = size + 2 * k, size + 2 * k + 1
            tree[n] = (f, b, left, right)
            for at, value, side in ((left, low, True), (right, high, False)):
                tree[at], values[at] = None, value
                parts[at] = [(x, r) for x, r in parts[n] if (x[f] <= b) == side]
                opened.append(at)
        open_nodes = opened

    def value(x):
        at = 0
        while tree[at]:
            f, b, left, right = tree[at]
            at = left if x[f] <= b else right
        return values[at]

    assert nodes
    return value


def plain_boost(rows, rounds, depth, leaves=31, penalty=0.0, min_rows=1, rate=0.1):
    out, errors = {}, {}
    for m in sorted({r[0] for r in rows}):
        own = [r for r in rows if r[0] == m]
        base = np.mean([y for _, _, y, v in own if not v])
        fitted = [base] * len(own)
        for t in range(rounds):
            value = plain_tree([(b, y - p) for (_, b, y, v), p in zip(own, fitted) if not v], depth, leaves, penalty, min_rows, rate)
            fitted = [p + value(b) for (_, b, _, _), p in zip(own, fitted)]
            judged = [(y - p) ** 2 for (_, _, y, v), p in zip(own, fitted) if v]
            errors[m, t + 1] = np.sqrt(np.mean(judged)) if judged else None
        out[m] = fitted
    return out, errors


@pytest.mark.parametrize("settings", [{}, {"leaves": 3, "rate": 0.5}, {"penalty": 20.0, "min_rows": 9, "rate": 0.4}])
@pytest.mark.parametrize("broadcast", [10_000, 0])
def test_boosting_equals_plain(spark, monkeypatch, settings, broadcast):
    monkeypatch.setattr(grown, "BROADCAST_MODELS", broadcast)
    rows = sample(1)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    made = grown.fit_boosted_many(frame, 3, rounds=3, depth=3, **settings)
    want, errors = plain_boost(rows, 3, 3, **settings)
    got = {(r["model"], r["round"]): r["rmse"] for r in made.errors.collect()}
    assert got.keys() == errors.keys() and all(abs(got[k] - errors[k]) < 1e-9 for k in got)
    scored = made.score(spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], SCHEMA + ", i int")).orderBy("i").collect()
    assert np.allclose([r.prediction for r in scored], sum((want[m] for m in ("m0", "m1", "m2")), []))


def test_models_set_parameters_and_stop_for_themselves(spark):
    rows = sample(2, 3)
    rows += [("alone", [1, 1, 1], 5.0, False), ("untrained", [1, 1, 1], 5.0, True), ("m0", [0, 0, 0], None, False)]
    params = spark.createDataFrame([("m0", 1.0, None), ("m1", 0.2, 3)], "model string, rate double, leaves int")
    made = grown.fit_boosted_many(spark.createDataFrame(rows, SCHEMA), 3, rounds=7, depth=2, patience=2, params=params, rate=0.5)
    stopped = {r["model"]: r for r in made.stopped.collect()}
    for m, own in (("m0", {"rate": 1.0}), ("m1", {"rate": 0.2, "leaves": 3}), ("m2", {"rate": 0.5})):
        _, errors = plain_boost([r for r in rows if r[0] == m and r[2] is not None], 7, 2, **own)
        best, last = 1, 1
        for t in range(1, 8):
            best, last = (t if round(errors[m, t], 9) < round(errors[m, best], 9) else best), t
            if t - best >= 2:
                break
        assert (stopped[m]["rounds"], round(stopped[m]["rmse"], 9)) == (best, round(errors[m, best], 9))
        assert made.errors.where(F.col("model") == m).count() == last
    assert stopped["alone"]["rmse"] is None and stopped["alone"]["rounds"] == 7
    other = made.score(spark.createDataFrame([("alone", [0, 0, 0], 0.0, True), ("untrained", [0, 0, 0], 0.0, True)], SCHEMA))
    assert {r["model"]: r.prediction for r in other.collect()} == {"alone": 5.0, "untrained": None}


def test_bins_and_edges(spark):
    rows = spark.createDataFrame([(float(i), None if i % 7 == 0 else float("nan") if i % 11 == 0 else i * 1.0) for i in range(1, 101)], "a double, b double")
    edges = grown.quantile_edges(rows, ["a", "b"], 4)
    assert all(20 <= e <= 80 for e in edges["a"]) and len(edges["a"]) == 3
    got = [tuple(r.x) for r in rows.select(grown.binned({"a": [10, 50], "b": [30]}).alias("x")).collect()]
    want = [(1 + (i > 10) + (i > 50), 0 if i % 7 == 0 or i % 11 == 0 else 1 + (i > 30)) for i in range(1, 101)]
    assert got == want
    assert spark.createDataFrame([(None,)], "a double").select(grown.binned({"a": []}).alias("x")).first().x == [0]


def test_forest_draws_rows_and_features(spark):
    rows = sample(3, 2, 300)
    frame = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], SCHEMA + ", i int")
    made = grown.fit_forest_many(frame, 3, 12, F.col("i"), depth=3, min_rows=3, columns=0.67)
    scored = made.score(frame).collect()
    error = np.mean([(r.y - r.prediction) ** 2 for r in scored])
    spread = np.mean([np.var([r.y for r in scored if r["model"] == m]) for m in ("m0", "m1")])
    assert error < 0.45 * spread
    weights = frame.select(grown.bootstrap_weight("rows", 42, F.lit(1), F.col("i").cast("string")).alias("w"))
    drawn = [r.w for r in weights.collect()]
    assert 0.9 < np.mean(drawn) < 1.1 and 0.3 < np.mean([w == 0 for w in drawn]) < 0.44
    used = made.trees.select("model", F.explode(F.array_distinct(F.transform(F.filter("nodes", lambda n: n["feature"] >= 0), lambda n: n["feature"]))).alias("f"))
    assert used.groupBy("model").agg(F.count_distinct("f").alias("n")).where("n = 3").count() == 2
    assert not used.sparkSession.createDataFrame([(1,)], "a int").join(made.trees.select("round"), F.lit(True) & (F.col("a") == F.col("round")), "left_anti").count()


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    made = grown.fit_boosted_many(empty, 3, rounds=2, depth=2, patience=1)
    assert made.trees.count() == made.errors.count() == made.stopped.count() == 0
    assert made.score(spark.createDataFrame([("x", [0, 0, 0], 1.0, True)], SCHEMA)).first().prediction is None
    assert grown.importance(made, ["a", "b", "c"]).count() == 0
    assert grown.fit_forest_many(empty, 3, 2, F.lit(1)).trees.count() == 0
    with pytest.raises(ValueError, match="no such settings"):
        grown.fit_boosted_many(empty, 3, rounds=1, speed=3)


def test_draws_come_near_good_trials():
    space = {"rate": ("log", 0.001, 1.0), "depth": ("int", 1, 9), "kind": ("choice", ["a", "b", "c"])}

    def error(p):
        return (np.log10(p["rate"]) + 1.5) ** 2 + (p["depth"] - 3) ** 2 / 10 + 0.5 * (p["kind"] != "b")

    learned, plain = [], []
    for seed in range(40):
        rng, trials = random.Random(seed), []
        for _ in range(5):
            trials += [(p, error(p)) for p in tune.parzen_candidates(space, trials, 8, rng)]
        assert len({tuple(p.items()) for p, _ in trials}) == 40
        learned.append(min(e for _, e in trials))
        plain.append(min(error(p) for p in tune.evaluate.random_candidates(space, 40, seed)))
    assert np.median(learned) < 0.2 * np.median(plain) and np.mean(learned) < np.mean(plain)
    few = {"a": ("choice", [1, 2]), "b": ("choice", [1, 2, 3])}
    assert len(tune.parzen_candidates(few, [({"a": 1, "b": 1}, 0.5)], 20, random.Random(1))) == 5


def test_search_ends_losing_trials(spark):
    rows = [(b, y, i % 4) for i, (_, b, y, _) in enumerate(sample(4, 1, 400))]
    blocks = spark.createDataFrame(rows, "bins array<int>, y double, block int")
    space = {"rate": ("log", 0.01, 1.0), "leaves": ("choice", [2, 4, 8])}
    found = tune.adaptive_search(spark, blocks, 3, space, batches=2, per_batch=4, rounds=4, halvings=(1, 2), n_splits=3, depth=3)
    got = found.collect()
    assert [r.trial for r in got] == list(range(8)) and sorted(r.rounds for r in got if r.batch == 0) == [1, 1, 2, 4]
    assert [r.fold_rounds for r in got] == [3 * r.rounds for r in got]
    best = tune.best_trial(found).first()
    assert best.mean_rmse == min(r.mean_rmse for r in got if r.rounds == 4)
    again = tune.adaptive_search(spark, blocks, 3, space, batches=2, per_batch=4, rounds=4, halvings=(1, 2), n_splits=3, depth=3)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got))
