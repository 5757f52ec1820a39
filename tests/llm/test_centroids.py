"""Clustering over column blocks against plain Lloyd with Python's own numbers."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from demandkit.llm import centroids as cd, queries

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, dims=64, k=40, rounds=5):
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    means = [v for _, v in order[:k]]

    def nearest(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, m)), c) for c, m in enumerate(means))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for c in range(len(means)):
            group = [v for (_, v), o in zip(kept, own) if o == c]
            if group:
                means[c] = [sum(x) // len(group) for x in zip(*group)]
    return sorted(((i, c, d) for i, v in kept for d, c in [nearest(v)]), key=str), means


def vectors(seed, n, dims=64, groups=12):
    rnd = random.Random(seed)
    middles = [[rnd.gauss(0, 0.2) for _ in range(dims)] for _ in range(groups)]
    return [(i * 7, [m + rnd.gauss(0, 0.05) for m in rnd.choice(middles)]) for i in range(n)]


@pytest.mark.parametrize("width, bundle", [(32, 4096), (10, 7), (64, 50), (1, 33)])
def test_equals_plain(spark, width, bundle):
    rows = vectors(1, 150, 20)
    rows += [(1000 + i, rows[5][1]) for i in range(60)]
    want, means = plain(rows, 20, 9)
    made, final = cd.cluster_vectors(spark.createDataFrame(rows, SCHEMA).repartition(3), dims=20, k=9, width=width, bundle=bundle)
    assert sorted(map(tuple, made.collect()), key=str) == want
    assert [r.components for r in final.orderBy("cluster").collect()] == means


def test_query_equals_plain(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want, means = plain(rows)
    got = queries.QUERIES["op13_centroid_clustering"](spark, sf_dir).collect()
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got), key=str) == want
    assert all(r.centroid_sha256 == cd.digest(means[r.cluster]) for r in got)
    assert {r.inertia for r in got} == {sum(d for *_, d in want)}
    assert all(r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster) for r in got)


def test_odd_tables(spark):
    made, final = cd.cluster_vectors(spark.createDataFrame([], SCHEMA))
    assert made.count() == 0 and final.count() == 0
    good = [0.5] * 64
    rows = [(1, good), (None, [-0.25] * 64), (1, [0.125] * 64), (2, None), (3, [0.5] * 63), (4, [None, *good[1:]]), (5, [float("nan"), *good[1:]]), (6, [float("-inf"), *good[1:]]), (1, good)]
    odd = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("bundle", "shard", "cluster", "ids", "components", "hash")})
    made, final = cd.cluster_vectors(odd)
    want, means = plain(rows)
    assert sorted(map(tuple, made.collect()), key=str) == want and len(want) == 4
    assert final.count() == len(means) == 4
    with pytest.raises(PySparkException):
        cd.cluster_vectors(spark.createDataFrame([(1, [1e30] * 64)], SCHEMA))
