"""What the text operators share: Arrow maps, lineage cuts, lists of marks brought to documents."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from demandkit.session import checkpointed, scratch_dir

__all__ = ["arrow_map", "bounded_batches", "checkpointed", "documents", "hash_sample", "scratch_dir", "texts", "unused", "with_marks"]

_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession, size: int = 16 << 20) -> None:
    """Let Arrow batches end by bytes, so that long texts do not pile up in a Python worker."""
    if spark.conf.get(_BATCH_BYTES, None) in (None, str((1 << 31) - 1), str((1 << 63) - 1), "-1"):
        spark.conf.set(_BATCH_BYTES, str(size))


def arrow_map(
    df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: str
) -> DataFrame:
    bounded_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)


def documents(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Only the two columns the operators work on, under fixed names whatever else the table has."""
    return df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))


def texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The column's texts as UTF-8 bytes; null is an empty text."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def hash_sample(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """At most ``n`` rows, those with the smallest hashes of ``keys``.

    Rows are counted first, and only those whose hash is small enough to come into question are
    ordered: what tasks send to the driver does not grow with their number.
    """
    hashed = F.xxhash64(F.lit(17), *keys)
    share = min(1.0, (2 * n + 100) / max(1, rows.count()))
    small = rows.where(F.shiftrightunsigned(hashed, 11) / F.lit(float(1 << 53)) < share)
    return small.orderBy(hashed, *keys).limit(n)


def unused(df: DataFrame, name: str) -> str:
    """``name``, made longer until the table has no column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_marks(docs: DataFrame, doc_id: str, text: str, marks: DataFrame) -> DataFrame:
    """Each row of ``docs`` with the list of its marks as last column, null where it has none.

    ``marks`` has rows ``(doc_id, hash, mark)``, where ``hash`` is ``xxhash64`` of the row's text, so that
    rows without an id, or with one id, have lists of their own; the list of distinct marks is bounded
    by that text. Only the lists are built into a hash table: the texts are shuffled but not sorted.
    """
    key, code, own, name = (unused(docs, n) for n in ("_marked", "_code", "_own", "_marks"))
    lists = marks.groupBy(F.col("doc_id").alias(key), F.col("hash").alias(code)).agg(F.collect_set("mark").alias(name))
    coded = docs.withColumn(own, F.xxhash64(F.col(text)))
    same = coded[doc_id].eqNullSafe(lists[key]) & (coded[own] == lists[code])
    return coded.join(lists.hint("shuffle_hash"), same, "left").drop(key, code, own)
