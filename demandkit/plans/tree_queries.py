"""Queries over trees for many models at once, with twins that grow the same trees in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandkit.operators import folds, grown, tune
from demandkit.plans.catalogue import day_text, query, rounded
from demandkit.plans.derived import CUT, DEMAND_SQL, tree_rows
from demandkit.session import checkpointed

#: Fixed cut points, so that both sides see the same bins.
EDGES = {"dayofweek": [0, 1, 2, 3, 4, 5], "month": [2, 4, 6, 8, 10], "lag_1": [0, 1, 2, 3, 5, 8, 13, 21], "lag_5": [0, 1, 2, 3, 5, 8, 13, 21]}
_NAMES = list(EDGES)
_ROWS_SQL = f"""{DEMAND_SQL},
feat AS (SELECT series, ds, CAST(y AS DOUBLE) AS y, isodow(ds) - 1 AS dayofweek, month(ds) AS month,
                lag(y, 1) OVER w AS lag_1, lag(y, 5) OVER w AS lag_5
         FROM demand WINDOW w AS (PARTITION BY series ORDER BY ds)),
clean AS (SELECT series, ds, y, [{", ".join(f"len(list_filter({[float(c) for c in cuts]}, lambda c: {name} > c)) + 1" for name, cuts in EDGES.items())}] AS bins
          FROM feat WHERE lag_5 IS NOT NULL)"""


def _blocks_sql(n_splits: int) -> str:
    return f"""days AS (SELECT ds, row_number() OVER (ORDER BY ds) - 1 AS pos, count(*) OVER () AS n FROM (SELECT DISTINCT ds FROM clean)),
blocks AS (SELECT ds, CASE WHEN pos < n - {n_splits} * (n // {n_splits + 1}) THEN 0
                           ELSE CAST((pos - (n - {n_splits} * (n // {n_splits + 1}))) // (n // {n_splits + 1}) AS INTEGER) + 1 END AS block FROM days),
placed AS (SELECT clean.*, block FROM clean JOIN blocks USING (ds)),
spread AS (SELECT fold, p.*, block = fold AS valid FROM placed p JOIN (SELECT unnest(range(1, {n_splits + 1})) AS fold) ON block <= fold)"""


def _grown_sql(rounds: int, depth: int, root: str = "0.0", used: str = "true") -> str:
    """Rounds of trees from ``state0(k, ..., valid, y, w, fitted, bins, rate, penalty, min_rows, leaves)``.

    Nodes are numbered as in a heap. ``root`` is the value of a root without a split, ``used`` says which
    features a model may take. Round t ends with ``state<t>``, ``splits<t>`` and ``errors<t>``.
    """
    text = []
    for t in range(1, rounds + 1):
        text.append(f"at{t}_0 AS (SELECT *, 0 AS node, CAST({root} AS DOUBLE) AS value FROM state{t - 1})")
        for level in range(depth):
            text.append(f"""long{t}_{level} AS (
  SELECT k, node, rate, penalty, min_rows, leaves, (y - fitted) * w AS r, w, unnest(range({len(_NAMES)})) AS feature, unnest(bins) AS bin
  FROM at{t}_{level} WHERE NOT valid AND node >= {2**level - 1}),
cells{t}_{level} AS (
  SELECT k, node, feature, bin, any_value(rate) AS rate, any_value(penalty) AS penalty, any_value(min_rows) AS min_rows,
         any_value(leaves) AS leaves, sum(r) AS r, sum(w) AS w
  FROM long{t}_{level} WHERE {used} GROUP BY k, node, feature, bin),
cuts{t}_{level} AS (
  SELECT *, sum(r) OVER upto AS gl, sum(w) OVER upto AS wl, sum(r) OVER whole AS g, sum(w) OVER whole AS h
  FROM cells{t}_{level} WINDOW whole AS (PARTITION BY k, node, feature),
       upto AS (PARTITION BY k, node, feature ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
gains{t}_{level} AS (
  SELECT *, round(gl * gl / (wl + penalty) + (g - gl) * (g - gl) / (h - wl + penalty) - g * g / (h + penalty), 6) AS gain
  FROM cuts{t}_{level} WHERE wl >= min_rows AND h - wl >= min_rows AND wl > 0 AND h - wl > 0),
best{t}_{level} AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY gain DESC, node) AS place FROM (
    SELECT *, row_number() OVER (PARTITION BY k, node ORDER BY gain DESC, feature, bin) AS nth FROM gains{t}_{level} WHERE gain > 0)
  WHERE nth = 1),
split{t}_{level} AS MATERIALIZED (
  SELECT k, node, feature, bin, gain, rate * gl / (wl + penalty) AS low, rate * (g - gl) / (h - wl + penalty) AS high
  FROM best{t}_{level} WHERE place <= leaves - {level + 1}),
at{t}_{level + 1} AS MATERIALIZED (
  SELECT a.* REPLACE (
    CASE WHEN s.k IS NULL THEN a.node WHEN a.bins[s.feature + 1] <= s.bin THEN 2 * a.node + 1 ELSE 2 * a.node + 2 END AS node,
    CASE WHEN s.k IS NULL THEN a.value WHEN a.bins[s.feature + 1] <= s.bin THEN s.low ELSE s.high END AS value)
  FROM at{t}_{level} a LEFT JOIN split{t}_{level} s ON a.k = s.k AND a.node = s.node)""")
        text.append(f"""state{t} AS MATERIALIZED (SELECT * EXCLUDE (node, value) REPLACE (fitted + value AS fitted) FROM at{t}_{depth}),
errors{t} AS (SELECT k, {t} AS round, count(*) AS n, sqrt(avg(power(y - fitted, 2))) AS rmse FROM state{t} WHERE valid GROUP BY k)""")
    return ",\n".join(text)


def _errors_sql(rounds: int) -> str:
    return "errors AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT * FROM errors{t}" for t in range(1, rounds + 1)) + ")"


def _stopped_sql(rounds: int, patience: int) -> str:
    """The rounds a model keeps: those up to its best when so many have not bettered it."""
    return f"""{_errors_sql(rounds)},
best_so_far AS (SELECT *, (min([round(rmse, 9), round]) OVER (PARTITION BY k ORDER BY round))[2] AS best FROM errors),
ends AS (SELECT k, coalesce(min(round) FILTER (round - best >= {patience}), max(round)) AS last FROM best_so_far GROUP BY k),
stopped AS (SELECT b.k, CAST(b.best AS INTEGER) AS rounds FROM best_so_far b JOIN ends e ON b.k = e.k AND b.round = e.last)"""


_START_SQL = "1.0 AS w, avg(CASE WHEN NOT valid THEN y END) OVER (PARTITION BY k) AS fitted"
_BOOST = {"rate": 0.3, "leaves": 3, "penalty": 1.0, "min_rows": 5}
_BOOST_SQL = ", ".join(f"{v} AS {k}" for k, v in _BOOST.items())


def binned_rows(spark, sf):
    return tree_rows(spark, sf).withColumn("bins", grown.binned(EDGES))


def _per_series(spark, sf):
    return binned_rows(spark, sf).select(F.col("series").alias("model"), "ds", "y", "bins", (F.col("ds") >= F.lit(CUT).cast("date")).alias("valid"))


_SERIES_SQL = f"""{_ROWS_SQL},
state0 AS (SELECT *, {_START_SQL}, {_BOOST_SQL} FROM (SELECT series AS k, *, ds >= DATE '{CUT}' AS valid FROM clean))"""


@query(
    "m8_boosted_per_series",
    f"""
    WITH {_SERIES_SQL}, {_grown_sql(4, 2)}
    SELECT k AS series, strftime(ds, '%Y-%m-%d') AS ds, y, round(fitted, 6) AS prediction FROM state4 WHERE valid
    """,
)
def m8_many(spark, sf):
    """A booster of leaf-wise trees for every series, all side by side; rows after the cut are predicted."""
    rows = _per_series(spark, sf)
    made = grown.fit_boosted_many(rows, len(_NAMES), rounds=4, depth=2, **_BOOST)
    scored = made.score(rows.where("valid"))
    return scored.select(F.col("model").alias("series"), day_text(), F.col("y").cast("double").alias("y"), rounded("prediction", "prediction"))


@query(
    "m15_importance_per_series",
    f"""
    WITH {_SERIES_SQL}, {_grown_sql(3, 2)},
    used AS ({" UNION ALL ".join(f"SELECT k, feature, gain FROM split{t}_{level}" for t in (1, 2, 3) for level in (0, 1))})
    SELECT k AS series, {_NAMES}[feature + 1] AS feature, round(sum(gain) / sum(sum(gain)) OVER (PARTITION BY k), 6) AS gain,
           round(count(*) / sum(count(*)) OVER (PARTITION BY k), 6) AS splits
    FROM used GROUP BY k, feature
    """,
)
def m15_many(spark, sf):
    made = grown.fit_boosted_many(_per_series(spark, sf).where("not valid"), len(_NAMES), rounds=3, depth=2, **_BOOST)
    shares = grown.importance(made, _NAMES)
    return shares.select(F.col("model").alias("series"), "feature", rounded("gain", "gain"), rounded("splits", "splits"))


_N_TREES = 3
_U = "CAST('0x' || substr(md5({}), 1, 8) AS BIGINT) / 4294967296.0"
_USED_SQL = f"""(k, feature) IN (SELECT k, feature FROM used)"""


@query(
    "m7_forest_per_series",
    f"""
    WITH {_ROWS_SQL},
    turns AS (SELECT series, ds, y, bins, ds >= DATE '{CUT}' AS valid, tree, series || '#' || tree AS k FROM clean, (SELECT unnest(range(1, {_N_TREES + 1})) AS tree)),
    drawn AS (SELECT *, CASE WHEN valid THEN 1 ELSE len(list_filter({list(grown._POISSON)}, lambda p: {_U.format("'rows:42:' || tree || ':' || strftime(ds, '%Y-%m-%d')")} >= p)) END AS w FROM turns),
    state0 AS (SELECT *, 0.0 AS fitted, 1.0 / {_N_TREES} AS rate, 0.0 AS penalty, 10 AS min_rows, 4 AS leaves FROM drawn WHERE w > 0),
    used AS (SELECT k, feature FROM (
      SELECT k, feature, row_number() OVER (PARTITION BY k ORDER BY {_U.format("'columns:42:' || k || ':0:' || feature")}, feature) AS place
      FROM (SELECT DISTINCT k FROM state0), (SELECT unnest(range({len(_NAMES)})) AS feature)) WHERE place <= 2),
    {_grown_sql(1, 2, f"sum(CASE WHEN NOT valid THEN y * w END) OVER (PARTITION BY k) / sum(CASE WHEN NOT valid THEN w END) OVER (PARTITION BY k) / {_N_TREES}", _USED_SQL)}
    SELECT series, strftime(ds, '%Y-%m-%d') AS ds, any_value(y) AS y, round(sum(fitted), 6) AS prediction
    FROM state1 WHERE valid GROUP BY series, ds
    """,
)
def m7_many(spark, sf):
    """A forest for every series, trees of all of them side by side, from drawn rows and drawn features."""
    rows = _per_series(spark, sf)
    made = grown.fit_forest_many(rows.where("not valid"), len(_NAMES), _N_TREES, F.col("ds"), depth=2, leaves=4, min_rows=10, columns=0.5)
    scored = made.score(rows.where("valid"))
    return scored.select(F.col("model").alias("series"), day_text(), F.col("y").cast("double").alias("y"), rounded("prediction", "prediction"))


_STOP = {"rate": 0.8, "leaves": 4, "penalty": 0.0, "min_rows": 5}
_STOP_SQL = ", ".join(f"{v} AS {k}" for k, v in _STOP.items())


@query(
    "m9_early_stopping",
    f"""
    WITH {_ROWS_SQL},
    state0 AS (SELECT *, {_START_SQL}, {_STOP_SQL} FROM (SELECT 'all' AS k, *, ds >= DATE '{CUT}' AS valid FROM clean)),
    {_grown_sql(8, 2)}, {_stopped_sql(8, 2)}
    SELECT rounds AS trees, round(rmse, 6) AS rmse FROM stopped JOIN errors USING (k) WHERE round = rounds
    """,
)
def m9_patience(spark, sf):
    """Rows before the cut train; boosting ends when two rounds have not bettered the error on the rows after it."""
    rows = _per_series(spark, sf).withColumn("model", F.lit("all"))
    made = grown.fit_boosted_many(rows, len(_NAMES), rounds=8, depth=2, patience=2, **_STOP)
    return made.stopped.select(F.col("rounds").alias("trees"), rounded("rmse", "rmse"))


@query(
    "m10_early_stopping_in_folds",
    f"""
    WITH {_ROWS_SQL}, {_blocks_sql(3)},
    state0 AS (SELECT * EXCLUDE (fold), {_START_SQL}, {_STOP_SQL} FROM (SELECT CAST(fold AS VARCHAR) AS k, * FROM spread)),
    {_grown_sql(6, 2)}, {_stopped_sql(6, 2)}
    SELECT CAST(k AS INTEGER) AS fold, rounds, n, round(rmse, 6) AS rmse FROM stopped JOIN errors USING (k) WHERE round = rounds
    """,
)
def m10_patience(spark, sf):
    """Every fold stops by its own rows, all folds in the same jobs: rounds and error per fold."""
    blocks = folds.time_folds(binned_rows(spark, sf), "ds", 3)
    spread = blocks.withColumn("fold", F.explode(F.sequence(F.greatest(F.col("block"), F.lit(1)), F.lit(3))))
    rows = spread.select(F.col("fold").cast("string").alias("model"), "bins", "y", (F.col("block") == F.col("fold")).alias("valid"))
    made = grown.fit_boosted_many(rows, len(_NAMES), rounds=6, depth=2, patience=2, **_STOP)
    sizes = made.errors.groupBy("model").agg(F.first("n").alias("n"))
    joined = made.stopped.join(sizes, "model")
    return joined.select(F.col("model").cast("int").alias("fold"), "rounds", "n", rounded("rmse", "rmse"))


#: A space small enough for SQL to try all of it.
SPACE = {"rate": ("choice", [0.1, 0.3, 0.6, 1.0]), "penalty": ("choice", [0.0, 30.0, 300.0])}


def search_space(spark, sf):
    """Three batches of three; the worse half of each ends after two rounds, the others make six."""
    blocks = folds.time_folds(binned_rows(spark, sf), "ds", 2)
    return tune.adaptive_search(spark, blocks, len(_NAMES), SPACE, batches=3, per_batch=3, rounds=6, halvings=(2,), n_splits=2, depth=1, seed=0)


@query(
    "m14_adaptive_search",
    f"""
    WITH {_ROWS_SQL}, {_blocks_sql(2)},
    grid AS (SELECT rate, penalty FROM (SELECT unnest({SPACE["rate"][1]}) AS rate), (SELECT unnest({SPACE["penalty"][1]}) AS penalty)),
    state0 AS (SELECT * EXCLUDE (fold), {_START_SQL}, 1 AS min_rows, 31 AS leaves FROM (
      SELECT rate || '/' || penalty || '/' || fold AS k, * FROM spread, grid)),
    {_grown_sql(6, 1)},
    found AS (SELECT any_value(s.rate) AS rate, any_value(s.penalty) AS penalty, e.k, any_value(e.rmse) AS rmse
              FROM errors6 e JOIN (SELECT DISTINCT k, rate, penalty FROM state0) s ON e.k = s.k GROUP BY e.k)
    SELECT CAST(rate AS DOUBLE) AS rate, CAST(penalty AS DOUBLE) AS penalty, round(avg(rmse), 6) AS mean_rmse
    FROM found GROUP BY rate, penalty ORDER BY round(avg(rmse), 9) LIMIT 1
    """,
)
def m14_adaptive(spark, sf):
    """The best of a space that the search sees only in part equals the best of all of it."""
    best = tune.best_trial(search_space(spark, sf))
    return best.select("rate", "penalty", rounded("mean_rmse", "mean_rmse"))
