"""Benchmark items found inside documents, by a size-partitioned MinHash containment search.

Items are partitioned by size: class ``c`` holds items of 2**(c-1)+1 to 2**c distinct shingles. An
item is sketched by its first k shingles in one order, with k set per class so that an item contained to ``threshold`` or more cannot miss them all: at most ``n - ceil(threshold * n)`` of
its shingles are absent, so one more than that, for the largest n of the class, always meets the
document. The order is rare-first: shingles that fewer items share come first, the hash decides among
equals; a plain hash order would find the same, but make every document with a phrase common to the
benchmark a candidate for all of it. A document of any length therefore needs no sketch of its own, which would be lost in
long texts: it is asked for the sketched shingles, and what answers is verified by exact
containment over all shingles of the item. An item of fewer words than a shingle has is one shorter
shingle, and documents are asked for shingles of the few such lengths that occur. Only DataFrame operations are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from demandkit.llm.common import checkpointed, unused

SHINGLE_WORDS = 5
THRESHOLD = 0.8
#: A side of at most so many rows (of two or three longs each) is broadcast; a larger one is shuffled.
BROADCAST_ROWS = 1 << 20
_SPACE = " \t\n\x0b\x0c\r"


def word_hashes(text: str | Column) -> Column:
    """Hashes of the lower-cased words that ASCII white space leaves; null and empty texts have none."""
    trimmed = F.btrim(F.lower(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))), F.lit(_SPACE))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    return F.transform(words, lambda w: F.xxhash64(w))


def shingle_rows(df: DataFrame, row_id: str, text: str, name: str, words: int = SHINGLE_WORDS, shorter: Sequence[int] = ()) -> DataFrame:
    """``(name, h)``: one row per shingle of the text; fewer words than a shingle has are one shingle.

    Shingles of the ``shorter`` lengths come as well.
    """
    hashed = df.select(F.col(row_id).alias(name), word_hashes(text).alias("_w"))
    many = F.greatest(F.size("_w") - F.lit(words - 1), F.lit(1))
    shifted = F.arrays_zip(*[F.slice("_w", i + 1, many).alias(f"_{i}") for i in range(words)])
    found = hashed.select(name, "_w", F.inline(shifted)).select(name, F.xxhash64(*[f"_{i}" for i in range(words)]).alias("h"))
    for n in shorter:
        parts = F.arrays_zip(*[F.slice("_w", i + 1, F.size("_w") - F.lit(n - 1)).alias(f"_{i}") for i in range(n)])
        short = hashed.where(F.size("_w") >= n).select(name, F.inline(parts))
        found = found.union(short.select(name, F.xxhash64(*[f"_{i}" for i in range(n)]).alias("h")))
    return found


def _sized(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def sketches(shingles: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(item_id, h)``: the first k shingles of each item, rare ones first, k by the class of its size.

    The order takes shingles that fewer items share first, so that a phrase common to the whole
    benchmark does not make every document a candidate; ties go by hash.
    """
    shared = shingles.groupBy("h").agg(F.count(F.lit(1)).alias("_items"))
    ranked = shingles.join(shared, "h")
    item = Window.partitionBy("item_id")
    largest = F.pow(F.lit(2.0), F.ceil(F.log2(F.count(F.lit(1)).over(item).cast("double"))))
    spare = largest - F.ceil(largest * F.lit(threshold) - F.lit(1e-9)) + 1
    place = F.row_number().over(item.orderBy("_items", F.xxhash64(F.lit(1), "h"), "h"))
    return ranked.select("item_id", "h", place.alias("_place"), spare.alias("_k")).where("_place <= _k").select("item_id", "h")


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    words: int = SHINGLE_WORDS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """``(doc_id, item_id, n_shared, n_item, containment)`` of every pair at ``threshold`` or above.

    ``n_item`` counts an item's distinct shingles, ``n_shared`` those the document has. Rows that
    share an id are one document or item. An item of fewer than ``words`` words is in the documents that
    hold these words one behind the other. Items and documents without words are in no pair, and so
    are rows with a null id. An empty table on either side gives no rows; other columns are not read.
    """
    items, docs = items.where(F.col(item_id).isNotNull()), docs.where(F.col(doc_id).isNotNull())
    wanted = checkpointed(shingle_rows(items, item_id, item_text, "item_id", words).distinct())
    lengths = items.select(F.size(word_hashes(item_text)).alias("n")).where(f"n between 1 and {words - 1}").distinct()
    shorter = sorted(r.n for r in lengths.collect())
    sketch = checkpointed(sketches(wanted, threshold))
    asked = shingle_rows(docs, doc_id, text, "doc_id", words, shorter)
    met = asked.join(_sized(sketch, sketch.count()), "h").select("doc_id", "item_id").distinct()
    met = checkpointed(met)

    sizes = wanted.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_item"))
    needed = met.join(wanted, "item_id")
    key = unused(docs, "_met")
    some = met.select(F.col("doc_id").alias(key)).distinct()
    again = docs.join(_sized(some, met.count()), docs[doc_id] == F.col(key), "left_semi")
    there = shingle_rows(again, doc_id, text, "doc_id", words, shorter)
    found = needed.join(there, ["doc_id", "h"], "left_semi")
    counted = found.groupBy("doc_id", "item_id").agg(F.count(F.lit(1)).alias("n_shared")).join(sizes, "item_id")
    close = counted.where(F.col("n_shared") >= F.lit(threshold) * F.col("n_item") - F.lit(1e-9))
    return close.select("doc_id", "item_id", "n_shared", "n_item", F.round(F.col("n_shared") / F.col("n_item"), 6).alias("containment"))


def drop_contaminated(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns.

    Rows with a null id stay, and so do null and empty texts unless another row with their id contains an
    item: rows that repeat an id are one document. An empty table on either side changes nothing.
    """
    pairs = contained_items(docs, items, doc_id, text, **options)
    key = unused(docs, "_bad")
    bad = pairs.select(F.col("doc_id").alias(key)).distinct()
    return docs.join(bad, docs[doc_id] == F.col(key), "left_anti")
