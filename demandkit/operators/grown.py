"""Trees for many models at once, grown from histograms.

A model is a series, a fold, a candidate of a search, or any combination: whatever the ``model`` column
says. Each level of the trees of all models is one aggregate, keyed by model, node, feature and bin, so
the number of jobs depends on rounds and depth, not on the number of models, and a model with a third of
all rows is summed up where its rows are. Only the trees are brought to the rows.

Levels split the nodes with the largest gains first, as many as a model has leaves left. Gains are
compared to six digits, then the first feature and the lowest bin win, so that the order of summation
does not decide. Everything random comes from MD5 sums of what is drawn for, and is the same on every run.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from demandkit.session import checkpointed

#: What a model may set for itself, in a ``params`` table, and the value without it.
DEFAULTS = {"rate": 0.1, "leaves": 31, "penalty": 0.0, "min_rows": 1, "columns": 1.0}
#: Up to so many models the trees of one round are broadcast; more are joined by shuffle.
BROADCAST_MODELS = 10_000
_NODE = "struct<feature: int, bin: int, left: int, right: int, value: double, gain: double>"
_LEAF = "named_struct('feature', -1, 'bin', -1, 'left', -1, 'right', -1, 'value', {value}, 'gain', cast(0 as double))"
#: Distribution of how often a row is drawn with replacement from very many.
_POISSON = (0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563, 0.9994058151824183)


def quantile_edges(df: DataFrame, features: Sequence[str], bins: int = 32) -> dict[str, list[float]]:
    """Distinct cut points per feature, at approximate quantiles; nulls and NaN count for nothing."""
    shares = [i / bins for i in range(1, bins)]
    known = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in features}
    row = df.agg(*[F.percentile_approx(known[c], shares).alias(c) for c in features]).first()
    return {c: sorted(set(row[c] or [])) for c in features}


def binned(edges: Mapping[str, Sequence[float]]) -> Column:
    """One bin per feature, in the order of ``edges``: 0 for null and NaN, then 1 and one more for each edge below the value."""

    def one(name: str, cuts: Sequence[float]) -> Column:
        x = F.col(name).cast("double")
        above = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: x > c)) if cuts else F.lit(0)
        return F.when(x.isNull() | F.isnan(x), 0).otherwise(above + 1)

    return F.array(*[one(c, cuts) for c, cuts in edges.items()])


def drawn(*parts: Column | str | int) -> Column:
    """A number from 0 to below 1 that follows from the parts."""
    text = F.concat_ws(":", *[(p if isinstance(p, Column) else F.lit(p)).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def bootstrap_weight(*parts: Column | str | int) -> Column:
    """How often a row is drawn with replacement."""
    u = drawn(*parts)
    return reduce(lambda total, p: total + (u >= p).cast("int"), _POISSON, F.lit(0)).cast("double")


def _walk(nodes: Column, bins: Column, depth: int) -> Column:
    """The leaf a row comes to."""

    def step(at: Column, _: Column) -> Column:
        node = F.get(nodes, at)
        down = F.when(F.get(bins, node["feature"]) <= node["bin"], node["left"]).otherwise(node["right"])
        return F.when(node["feature"] < 0, at).otherwise(down)

    return F.aggregate(F.sequence(F.lit(1), F.lit(max(depth, 1))), F.lit(0), step) if depth else F.lit(0)


def _beside(rows: DataFrame, small: DataFrame, models: int) -> DataFrame:
    return rows.join(F.broadcast(small) if models <= BROADCAST_MODELS else small, "model")


def _roots(params: DataFrame, features: int, seed: int, turn: Column | int) -> DataFrame:
    """A tree without a split for each model, and the features it may use."""
    order = F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(features - 1)), lambda i: F.struct(drawn("columns", seed, F.col("model"), turn, i).alias("u"), i.alias("i"))))
    many = F.greatest(F.ceil(F.col("columns") * features).cast("int"), F.lit(1))
    nodes = F.expr(f"cast(array({_LEAF.format(value='cast(0 as double)')}) as array<{_NODE}>)")
    return params.withColumn("used", F.transform(F.slice(order, 1, many), lambda x: x["i"])).withColumn("nodes", nodes).withColumn("open", F.array(F.lit(0)))


def _level(state: DataFrame, trees: DataFrame, level: int, models: int) -> DataFrame:
    """``trees`` one level deeper. ``state`` has ``model, bins, gradient, weight``: sums of these are all that counts."""
    placed = _beside(state, trees.select("model", "nodes", "open", "used"), models)
    placed = placed.withColumn("node", _walk(F.col("nodes"), F.col("bins"), level)).where(F.array_contains("open", F.col("node")))
    cells = placed.select("model", "node", "gradient", "weight", "used", F.posexplode("bins").alias("feature", "bin"))
    cells = cells.where(F.array_contains("used", F.col("feature"))).groupBy("model", "node", "feature", "bin")
    cells = cells.agg(F.sum("gradient").alias("g"), F.sum("weight").alias("w"))
    # a window has as many rows as a feature has bins
    whole = Window.partitionBy("model", "node", "feature")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = {"gl": F.sum("g").over(upto), "wl": F.sum("w").over(upto), "g": F.sum("g").over(whole), "w": F.sum("w").over(whole)}
    settings = trees.select("model", "penalty", "min_rows", "rate", "leaves", F.expr("aggregate(nodes, 0, (n, x) -> n + if(x.feature < 0, 1, 0))").alias("now"))
    cuts = _beside(cells.select("model", "node", "feature", "bin", *[c.alias(f"_{k}") for k, c in sums.items()]), settings, models)

    def score(g: str, w: str) -> Column:
        return F.col(g) * F.col(g) / (F.col(w) + F.col("penalty"))

    cuts = cuts.withColumns({"_gr": F.col("_g") - F.col("_gl"), "_wr": F.col("_w") - F.col("_wl")})
    cuts = cuts.where((F.col("_wl") >= F.col("min_rows")) & (F.col("_wr") >= F.col("min_rows")) & (F.col("_wl") > 0) & (F.col("_wr") > 0))
    cuts = cuts.withColumn("gain", F.round(score("_gl", "_wl") + score("_gr", "_wr") - score("_g", "_w"), 6)).where("gain > 0")
    value = {side: F.col("rate") * F.col(f"_g{side}") / (F.col(f"_w{side}") + F.col("penalty")) for side in "lr"}
    best = F.max(F.struct("gain", (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b"), value["l"].alias("low"), value["r"].alias("high"), (F.col("leaves") - F.col("now")).alias("room")))
    found = cuts.groupBy("model", "node").agg(best.alias("s")).select("model", "node", "s.*")
    # of a model's open nodes, at most as many as it has leaves
    split = F.struct((-F.col("gain")).alias("worse"), "node", (-F.col("f")).alias("feature"), (-F.col("b")).alias("bin"), "low", "high", "gain")
    splits = found.groupBy("model").agg(F.array_sort(F.collect_list(split)).alias("splits"), F.greatest(F.max("room"), F.lit(0)).alias("room"))
    in_order = F.array_sort(F.transform(F.slice("splits", F.lit(1), F.col("room")), lambda x: F.struct(*[x[c].alias(c) for c in ("node", "feature", "bin", "low", "high", "gain")])))
    splits = splits.select("model", in_order.alias("splits"))
    grown = trees.join(splits, "model", "left")
    # the k-th split node gets the leaves 2k and 2k + 1 behind the nodes so far
    renewed = f"""transform(nodes, (x, i) -> coalesce(
        get(transform(filter(transform(splits, (s, k) -> struct(s, k)), t -> t.s.node = i),
            t -> named_struct('feature', t.s.feature, 'bin', t.s.bin, 'left', cast(size(nodes) + 2 * t.k as int),
                              'right', cast(size(nodes) + 2 * t.k + 1 as int), 'value', cast(0 as double), 'gain', t.s.gain)), 0), x))"""
    leaves = f"flatten(transform(splits, s -> array({_LEAF.format(value='s.low')}, {_LEAF.format(value='s.high')})))"
    more = F.expr(f"if(splits is null or size(splits) = 0, nodes, concat(cast({renewed} as array<{_NODE}>), cast({leaves} as array<{_NODE}>)))")
    opened = F.expr("if(splits is null or size(splits) = 0, cast(array() as array<int>), sequence(size(nodes), size(nodes) + 2 * size(splits) - 1))")
    return checkpointed(grown.withColumns({"open": opened, "nodes": more}).drop("splits"))


def grow(state: DataFrame, trees: DataFrame, depth: int, models: int) -> DataFrame:
    """Trees of ``depth`` levels at most, from roots; ``(model, ..., nodes)``."""
    for level in range(depth):
        trees = _level(state, trees, level, models)
    return trees


def settings(models: DataFrame, params: DataFrame | None, **common: float) -> DataFrame:
    """One row of settings for each model: those of ``params``, else those given, else the defaults."""
    made = models if params is None else models.join(params, "model", "left")
    given = {**DEFAULTS, **common}
    unknown = set(given) - set(DEFAULTS)
    if unknown:
        raise ValueError(f"no such settings: {sorted(unknown)}")
    own = set(made.columns) - {"model"}
    kinds = {"leaves": "int", "min_rows": "double"}
    return made.select("model", *[
        (F.coalesce(F.col(k), F.lit(v)) if k in own else F.lit(v)).cast(kinds.get(k, "double")).alias(k) for k, v in given.items()
    ])


@dataclass
class Boosted:
    """``trees(model, round, nodes, ...)``, ``base(model, base)``, ``errors(model, round, n, rmse)``, ``stopped(model, rounds, rmse)``.

    ``rounds`` are those a model keeps: up to its best one if validation rows decided, else all.
    """

    trees: DataFrame
    base: DataFrame
    errors: DataFrame
    stopped: DataFrame
    depth: int

    def models(self) -> DataFrame:
        """One row per model with all its trees, as long as the model is."""
        kept = self.trees.join(self.stopped.select("model", "rounds"), "model").where("round <= rounds")
        lists = kept.groupBy("model").agg(F.array_sort(F.collect_list(F.struct("round", "nodes"))).alias("t"))
        return self.base.join(lists, "model", "left").select("model", "base", F.transform("t", lambda x: x["nodes"]).alias("trees"))

    def score(self, rows: DataFrame, name: str = "prediction") -> DataFrame:
        """``rows`` with a prediction; rows of a model that was never fitted have null."""
        made = rows.join(self.models(), "model", "left")
        return made.withColumn(name, ensemble_value(F.col("base"), F.col("trees"), F.col("bins"), self.depth)).drop("base", "trees")


def ensemble_value(base: Column, trees: Column, bins: Column, depth: int) -> Column:
    steps = F.aggregate(F.coalesce(trees, F.array().cast(f"array<array<{_NODE}>>")), F.lit(0.0), lambda total, t: total + F.get(t, _walk(t, bins, depth))["value"])
    return base + steps


def _stopped(errors: DataFrame) -> DataFrame:
    """For each model the first of its rounds with the smallest error, that error, and the last round made."""
    best = F.min(F.struct(F.round("rmse", 9).alias("e"), "round", "rmse"))
    return errors.groupBy("model").agg(best.alias("b"), F.max("round").alias("last")).select("model", F.col("b.round").alias("rounds"), F.col("b.rmse").alias("rmse"), "last")


def fit_boosted_many(
    rows: DataFrame, features: int, rounds: int, depth: int = 3, patience: int | None = None, seed: int = 42,
    params: DataFrame | None = None, keep: Callable[[DataFrame, int], DataFrame | None] | None = None, **common: float,
) -> Boosted:
    """Boosting for squared error, of every model in ``rows(model, bins, y, valid)`` side by side.

    Rows with ``valid`` only measure the error after each round. With ``patience`` a model stops when so
    many rounds have not bettered its error, and keeps those up to its best; ``rounds`` bounds all. A model
    without validation rows goes on to the end. ``keep(errors, round)``, if given, returns the models that
    go on, or nothing if all do, for searches that end losing trials. ``params`` may have a row of settings per model; others
    are taken from the arguments, see ``DEFAULTS``: the learning rate, the number of leaves, the penalty
    added to a leaf's weight, its least number of rows, and the share of features each tree may use.
    Models without a training row have no base and predict null; rows with a null ``y`` are left out.
    """
    rows = rows.where("y is not null").select("model", "bins", F.col("y").cast("double").alias("y"), "valid")
    base = checkpointed(rows.where("not valid").groupBy("model").agg(F.avg("y").alias("base")))
    models = base.count()
    state = checkpointed(_beside(rows, base, models).withColumnRenamed("base", "fitted"))
    chosen = checkpointed(settings(base.select("model"), params, **common))
    going, n_going, all_trees, measured = chosen, models, [], bool(state.where("valid").take(1))
    errors = base.select("model", F.lit(0).alias("round"), F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("rmse")).limit(0)
    for turn in range(1, rounds + 1):
        learning = state.where("not valid").select("model", "bins", (F.col("y") - F.col("fitted")).alias("gradient"), F.lit(1.0).alias("weight"))
        trees = grow(learning, _roots(going, features, seed, turn), depth, models)
        all_trees.append(trees.select("model", F.lit(turn).alias("round"), "nodes"))
        step = F.get(F.col("nodes"), _walk(F.col("nodes"), F.col("bins"), depth))["value"]
        state = checkpointed(_beside(state, trees.select("model", "nodes"), models).withColumn("fitted", F.col("fitted") + step).drop("nodes"))
        if not measured:
            continue
        squared = F.pow(F.col("y") - F.col("fitted"), F.lit(2.0))
        now = state.where("valid").groupBy("model").agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(squared)).alias("rmse"))
        now = checkpointed(now.select("model", F.lit(turn).alias("round"), "n", "rmse"))
        errors = errors.unionByName(now)
        left = going
        if patience is not None and patience <= turn < rounds:
            over = _stopped(errors).where(F.col("last") - F.col("rounds") >= patience)
            left = left.join(over.select("model"), "model", "left_anti")
        kept = keep(errors, turn) if keep is not None and turn < rounds else None
        if kept is not None:
            left = left.join(kept.select("model"), "model", "left_semi")
        if left is going:
            continue
        left = checkpointed(left)
        n_left = left.count()
        if not n_left:
            break
        if n_left < n_going:
            going, n_going, state = left, n_left, checkpointed(_beside(state, left.select("model"), models))
    errors = checkpointed(errors)
    trees = checkpointed(reduce(DataFrame.unionByName, all_trees))
    last = trees.groupBy("model").agg(F.max("round").alias("made"))
    judged = _stopped(errors).drop("last")
    ended = F.coalesce("rounds", "made") if patience is not None else F.col("made")
    stopped = base.select("model").join(last, "model").join(judged, "model", "left").select("model", ended.alias("rounds"), "rmse")
    return Boosted(trees, base, errors, checkpointed(stopped), depth)


def fit_forest_many(
    rows: DataFrame, features: int, n_trees: int, row_id: Column, depth: int = 6, bootstrap: bool = True, seed: int = 42, **common: float,
) -> Boosted:
    """Random forests of every model in ``rows(model, bins, y)``, all trees of all models side by side.

    A tree sees each row as often as it is drawn with replacement, which follows from ``row_id``, the tree
    and the seed; ``columns`` is the share of features it may use. The result predicts like ``Boosted``:
    the trees' leaves are divided by their number.
    """
    rows = rows.where("y is not null").select(F.col("model").alias("_of"), "bins", F.col("y").cast("double").alias("y"), row_id.cast("string").alias("_id"))
    each = rows.withColumn("tree", F.explode(F.sequence(F.lit(1), F.lit(n_trees))))
    each = each.withColumn("weight", bootstrap_weight("rows", seed, F.col("tree"), F.col("_id")) if bootstrap else F.lit(1.0)).where("weight > 0")
    state = each.select(F.concat_ws("#", F.col("_of"), F.col("tree").cast("string")).alias("model"), "_of", "tree", "bins", (F.col("y") * F.col("weight")).alias("gradient"), "weight")
    state = checkpointed(state)
    keys = checkpointed(state.groupBy("model").agg(F.first("_of").alias("_of"), F.first("tree").alias("tree"), (F.sum("gradient") / F.sum("weight")).alias("mean")))
    models = keys.count()
    chosen = settings(keys.select("model"), None, rate=1.0 / n_trees, **common)
    trees = grow(state.drop("_of", "tree"), checkpointed(_roots(chosen, features, seed, 0)), depth, models)
    # a root that is not split predicts the mean of what it saw
    plain = F.expr(f"if(size(nodes) > 1, nodes, cast(array({_LEAF.format(value='mean / ' + str(n_trees))}) as array<{_NODE}>))")
    made = checkpointed(trees.join(keys, "model").select(F.col("_of").alias("model"), F.col("tree").alias("round"), plain.alias("nodes")))
    base = checkpointed(made.groupBy("model").agg(F.lit(0.0).alias("base"), F.max("round").alias("rounds")))
    errors = base.select("model", F.lit(0).alias("round"), F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("rmse")).limit(0)
    return Boosted(made, base.select("model", "base"), errors, base.select("model", "rounds", F.lit(None).cast("double").alias("rmse")), depth)


def importance(boosted: Boosted, features: Sequence[str]) -> DataFrame:
    """``model, feature, gain, splits``: shares of a model's gain and of its splits, over the trees it keeps."""
    kept = boosted.trees.join(boosted.stopped.select("model", "rounds"), "model").where("round <= rounds")
    nodes = kept.select("model", F.explode("nodes").alias("x")).where("x.feature >= 0")
    sums = nodes.groupBy("model", F.col("x.feature").alias("at")).agg(F.sum("x.gain").alias("g"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("model")
    named = F.element_at(F.array(*[F.lit(f) for f in features]), F.col("at") + 1)
    return sums.select("model", named.alias("feature"), (F.col("g") / F.sum("g").over(whole)).alias("gain"), (F.col("n") / F.sum("n").over(whole)).alias("splits"))
