"""Queries over columns of very many categories."""

from __future__ import annotations

from pyspark.sql import functions as F

from demandkit.operators import categories
from demandkit.plans.catalogue import query, rounded, table


@query(
    "r1_codes_of_many_categories",
    "SELECT c_custkey, c_name, dense_rank() OVER (ORDER BY c_name) - 1 AS code FROM customer",
)
def r1_codes(spark, sf):
    """A category per customer: one code each instead of one column each."""
    rows = table(spark, sf, "customer").select("c_custkey", "c_name")
    return categories.encode(rows, "c_name", categories.learn_codes(rows, "c_name"))


_ALPHA = 3.0


@query(
    "m4_ridge_with_category_effects",
    f"""
    WITH rows AS (SELECT o_custkey, o_totalprice / 1000 AS y, (CAST(o_orderdate AS DATE) - DATE '1998-01-01') / 365.0 AS x FROM orders),
    per AS (SELECT o_custkey, count(*) AS n, sum(x) AS sx, sum(y) AS sy FROM rows GROUP BY 1),
    gone AS (SELECT sum(n * n / (n + {_ALPHA})) AS m11, sum(n * sx / (n + {_ALPHA})) AS m12, sum(sx * sx / (n + {_ALPHA})) AS m22,
                    sum(n * sy / (n + {_ALPHA})) AS v1, sum(sx * sy / (n + {_ALPHA})) AS v2 FROM per),
    total AS (SELECT count(*) AS n, sum(x) AS sx, sum(x * x) AS sxx, sum(y) AS sy, sum(x * y) AS sxy FROM rows),
    system AS (SELECT n - m11 AS a, sx - m12 AS b, sxx + {_ALPHA} - m22 AS c, sy - v1 AS r, sxy - v2 AS s FROM total, gone),
    solved AS (SELECT (r * c - s * b) / (a * c - b * b) AS intercept, (s * a - r * b) / (a * c - b * b) AS slope FROM system)
    SELECT o_custkey, round(intercept, 6) AS intercept, round(slope, 6) AS slope,
           round((sy - n * intercept - sx * slope) / (n + {_ALPHA}), 6) AS effect
    FROM per, solved
    """,
)
def m4_categories(spark, sf):
    """An effect per customer beside a trend, without a column per customer."""
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1998-01-01")) / F.lit(365.0)
    rows = table(spark, sf, "orders").select("o_custkey", (F.col("o_totalprice") / 1000).alias("y"), days.alias("x"))
    model = categories.fit_category_ridge(rows, ["x"], "y", "o_custkey", _ALPHA)
    return model.effects.select(
        "o_custkey", F.round(F.lit(model.intercept), 6).alias("intercept"), F.round(F.lit(model.coef[0]), 6).alias("slope"), rounded("effect", "effect")
    )
