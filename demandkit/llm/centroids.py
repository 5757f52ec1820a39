"""Lloyd's algorithm over column blocks: vectors and centroids are cut by dimension, not only by row.

Vectors lie in bundles of neighbouring rows, and each bundle in blocks of ``WIDTH`` components. A task
that works on a block needs only the slice of the centroids with the same components: it gives the
exact partial distance of each vector to each centroid. The partial distances of a bundle's blocks are
added up by key, and the smallest sum names the cluster; that goes back to the blocks, and each shard
of components sums up and updates its own slice. Everything is whole numbers, so results do not depend
on the order of sums. A round starts from the stored blocks and the centroids alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from demandkit.llm.common import arrow_map, checkpointed

#: Components in a block, and vectors in a bundle.
WIDTH, BUNDLE = 32, 4096
#: Largest size of a component: squared distances of 64 such differences fit into 64 bits.
LARGEST = 1 << 27


def whole_numbers(vector: Column, dims: int, times: int) -> Column:
    """``floor(times * x)`` of each component; null for a vector of another length or with a missing or non-finite component."""
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    values = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(times))))
    large = F.exists(vector, lambda x: F.abs(x.cast("double") * F.lit(float(times))) >= F.lit(float(LARGEST)))
    checked = F.when(large, F.raise_error(F.lit(f"a component is not below {LARGEST} in size"))).otherwise(values)
    return F.when((F.size(vector) == dims) & F.coalesce(sound, F.lit(False)), checked)


def _blocks(batches: Iterator[pa.RecordBatch], dims: int, width: int, bundle: int) -> Iterator[pa.RecordBatch]:
    """Bundles of the rows of a task, cut into blocks of columns."""
    number, waiting = TaskContext.get().partitionId() << 32, []

    def cut(tables: list[pa.RecordBatch]) -> pa.RecordBatch:
        ids = pa.concat_arrays([t.column(0) for t in tables])
        flat = np.concatenate([t.column(1).flatten().to_numpy(zero_copy_only=False) for t in tables]).reshape(-1, dims)
        shards = range(0, dims, width)
        ids_at = [ids.cast(pa.int64()).to_pylist()] + [None] * (len(shards) - 1)
        data = [np.ascontiguousarray(flat[:, at : at + width], np.int32).tobytes() for at in shards]
        return pa.RecordBatch.from_arrays(
            [pa.array([number] * len(shards), pa.int64()), pa.array(range(len(shards)), pa.int32()), pa.array(ids_at, pa.list_(pa.int64())), pa.array(data, pa.binary())],
            ["bundle", "shard", "ids", "data"],
        )

    held = 0
    for batch in batches:
        while batch.num_rows:
            take = batch.slice(0, bundle - held)
            waiting.append(take)
            held += take.num_rows
            batch = batch.slice(take.num_rows)
            if held == bundle:
                yield cut(waiting)
                number, waiting, held = number + 1, [], 0
    if held:
        yield cut(waiting)


def partial_distances(block: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distance of each row to each centroid over the columns given, exact."""
    out = np.empty((len(block), len(centroids)), np.int64)
    wide = block.astype(np.int64)
    for k, one in enumerate(centroids):
        gap = wide - one
        np.einsum("ij,ij->i", gap, gap, out=out[:, k])
    return out


def _packed(distances: np.ndarray) -> tuple[bytes, bytes]:
    """The least distance of each row, and what the others are more, in 32 bits where that is enough."""
    least = distances.min(axis=1, keepdims=True)
    rest = distances - least
    return least.tobytes(), (rest.astype(np.uint32) if rest.max(initial=0) < 1 << 32 else rest).tobytes()


def _unpacked(least: bytes, rest: bytes) -> np.ndarray:
    low = np.frombuffer(least, np.int64)[:, None]
    n = len(rest) // len(low)
    # a row of k distances takes 4 * k or 8 * k bytes, and k is the same in all blocks
    return low, np.frombuffer(rest, np.uint8).reshape(len(low), n)


def _measure(batches: Iterator[pa.RecordBatch], slices: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for bundle, shard, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            own = slices[shard]
            rows.append((bundle, *_packed(partial_distances(np.frombuffer(data, np.int32).reshape(-1, own.shape[1]), own))))
        bundles, least, rest = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(bundles, pa.int64()), pa.array(least, pa.binary()), pa.array(rest, pa.binary())], ["bundle", "least", "rest"])


def _nearest(table: pa.Table, k: int) -> pa.Table:
    """Partial distances of one bundle's blocks added up; the first of the smallest sums is the cluster."""
    total = 0
    for least, rest in zip(table.column("least").to_pylist(), table.column("rest").to_pylist()):
        low, more = _unpacked(least, rest)
        total = total + low + np.ascontiguousarray(more).view(np.uint32 if more.shape[1] == 4 * k else np.int64)
    cluster = total.argmin(axis=1)
    found = total[np.arange(len(cluster)), cluster]
    return pa.table({"bundle": table.column("bundle")[:1], "clusters": pa.array([cluster.astype(np.int32).tobytes()], pa.binary()), "distances": pa.array([found.astype(np.int64).tobytes()], pa.binary())})


def assign(blocks: DataFrame, centroids: np.ndarray, width: int = WIDTH) -> DataFrame:
    """``(bundle, clusters, distances)``: the nearest centroid of each vector, packed in the order of its bundle."""
    slices = [centroids[:, at : at + width] for at in range(0, centroids.shape[1], width)]
    parts = arrow_map(blocks.select("bundle", "shard", "data"), partial(_measure, slices=slices), "bundle long, least binary, rest binary")
    k = len(centroids)
    # one row for each block of columns of a bundle, so a group is as small as a bundle
    return parts.groupBy("bundle").applyInArrow(lambda one: _nearest(one, k), "bundle long, clusters binary, distances binary")


def _sum_batches(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Sums by shard and cluster over all blocks of a task."""
    sums: dict[int, np.ndarray] = {}
    counts: dict[int, np.ndarray] = {}
    for batch in batches:
        for shard, data, clusters in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            own = np.frombuffer(clusters, np.int32)
            block = np.frombuffer(data, np.int32).reshape(len(own), -1)
            order = np.argsort(own, kind="stable")
            found, first, many = np.unique(own[order], return_index=True, return_counts=True)
            total = sums.setdefault(shard, np.zeros((k, block.shape[1]), np.int64))
            total[found] += np.add.reduceat(block[order].astype(np.int64), first)
            counts.setdefault(shard, np.zeros(k, np.int64))[found] += many
    rows = [(s, c, int(counts[s][c]), sums[s][c].tolist()) for s in sums for c in np.flatnonzero(counts[s]).tolist()]
    shards, clusters, many, totals = zip(*rows) if rows else ((),) * 4
    yield pa.RecordBatch.from_arrays(
        [pa.array(shards, pa.int32()), pa.array(clusters, pa.int32()), pa.array(many, pa.int64()), pa.array(totals, pa.list_(pa.int64()))], ["shard", "cluster", "n", "totals"]
    )


def updated(blocks: DataFrame, assigned: DataFrame, centroids: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """The centroids after one round: floor of the mean of each cluster's vectors, unchanged where it has none.

    Sums are formed task by task, then added by shard, cluster and component; what comes to the driver
    is as large as the centroids.
    """
    joined = blocks.select("bundle", "shard", "data").join(assigned.select("bundle", "clusters"), "bundle").select("shard", "data", "clusters")
    sums = arrow_map(joined, partial(_sum_batches, k=len(centroids)), "shard int, cluster int, n long, totals array<long>")
    each = sums.select("shard", "cluster", "n", F.posexplode("totals").alias("place", "total"))
    total, n = F.sum(F.col("total").cast("decimal(38,0)")), F.sum("n").cast("decimal(38,0)")
    mean = F.floor((total - F.pmod(total, n)) / n).cast("long")
    rows = each.groupBy("shard", "cluster", "place").agg(mean.alias("mean")).collect()
    new = centroids.copy()
    for shard, cluster, place, value in rows:
        new[cluster, shard * width + place] = value
    return new


def cluster_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", dims: int = 64, k: int = 40, rounds: int = 5,
    times: int = 256, seed: str = "2", width: int = WIDTH, bundle: int = BUNDLE,
) -> tuple[DataFrame, DataFrame]:
    """Clusters of the vectors with exactly ``dims`` sound components, each turned into ``floor(times * x)``.

    Returns ``(vec_id, cluster, distance)``, one row for each such row, with the squared distance to the
    cluster's centroid, and ``(cluster, components)``, the final centroids. Vectors of other lengths, with
    null, NaN or infinite components, and null vectors are left out. The first centroids are the ``k``
    vectors with the smallest SHA-256 of ``seed:vec_id``, in that order (of repeated ids the smaller
    vectors first; a null id counts as the text ``null``); with fewer vectors there are fewer centroids.
    Equally near centroids: the smaller number. Clusters without vectors keep their centroid. Components
    of ``LARGEST`` and more in size raise an error. Rows that repeat an id are vectors of their own. An
    empty table gives no rows and no centroids. Other columns are not carried.
    """
    spark = vectors.sparkSession
    kept = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), whole_numbers(F.col(vector), dims, times).alias("components")).where("components is not null")
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    first = kept.select(hashed.alias("hash"), "components").orderBy("hash", "components").limit(k).collect()
    made = "bundle long, shard int, ids array<long>, data binary"
    cut = arrow_map(kept, partial(_blocks, dims=dims, width=width, bundle=bundle), made)
    cut = checkpointed(cut)
    # blocks of the same columns lie together: a task needs few slices of the centroids
    blocks = checkpointed(cut.drop("ids").repartitionByRange("shard", "bundle"))
    centroids = np.array([r.components for r in first], np.int64).reshape(-1, dims)
    for _ in range(rounds if len(first) else 0):
        centroids = updated(blocks, assign(blocks, centroids, width), centroids, width)
    final = spark.createDataFrame([(n, c.tolist()) for n, c in enumerate(centroids)], "cluster int, components array<long>")
    if not len(first):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), final
    named = assign(blocks, centroids, width).join(cut.where("ids is not null").select("bundle", "ids"), "bundle")
    return arrow_map(named.select("ids", "clusters", "distances"), _rows, "vec_id long, cluster int, distance long"), final


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, clusters, distances in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            own = [ids.values, pa.array(np.frombuffer(clusters, np.int32)), pa.array(np.frombuffer(distances, np.int64))]
            yield pa.RecordBatch.from_arrays(own, ["vec_id", "cluster", "distance"])


def digest(components: list[int]) -> str:
    """SHA-256 of a centroid's components as decimal numbers between commas."""
    return hashlib.sha256(",".join(map(str, components)).encode()).hexdigest()
