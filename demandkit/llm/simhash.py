"""Near duplicates by SimHash fingerprints, found through shared blocks of bits.

With ``max_bits`` differing bits at most, a fingerprint cut into ``max_bits + 2`` blocks agrees with
its partner on at least two of them (pigeonhole), so rows are keyed by every pair of blocks. Blocks
that more than one distinct fingerprint shares are compared bit by bit; nothing is capped: a block
of very many fingerprints is cut into chunks, and every pair of chunks is compared in a task of its
own, which keeps a spanning forest of the links it finds instead of all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh64_digest

from demandkit.llm.common import arrow_map, checkpointed, documents, texts, unused
from demandkit.llm.components import components

SEED = 42
SHINGLE_WORDS = 3
MAX_BITS = 3
CHUNK = 1024
_STEP = 1 << 16


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64 majority bits of the hashes of all word shingles, repeats included.

    A-Z is lower-cased, words are what ASCII white space leaves. Fewer words than a shingle has are
    one shingle; no words at all give zero.
    """
    words = text.lower().split()
    if not words:
        return 0
    parts = [words[i:] for i in range(min(shingle_words, len(words)))]
    counts, total = np.zeros(64, np.int64), len(parts[-1])
    for at in range(0, total, _STEP):
        shingles = map(b" ".join, zip(*[p[at : at + _STEP] for p in parts]))
        digests = b"".join(map(xxh64_digest, shingles, repeat(SEED)))
        bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * counts > total).tobytes(), "big")


def _fingerprint_batches(batches: Iterator[pa.RecordBatch], shingle_words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = np.array([fingerprint(t, shingle_words) for t in texts(batch.column(1))], np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view(np.int64))], ["doc_id", "fp"])


def block_masks(max_bits: int = MAX_BITS) -> list[int]:
    """Signed 64-bit masks, one for each pair of the ``max_bits + 2`` blocks."""
    edges = np.linspace(0, 64, max_bits + 3).round().astype(int).tolist()
    blocks = [((1 << (high - low)) - 1) << low for low, high in zip(edges, edges[1:])]
    masks = [a | b for a, b in combinations(blocks, 2)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _forest(found: np.ndarray, max_bits: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links that hold together what chains of close fingerprints connect within one list."""
    left, tails, heads = np.unique(found), [], []
    while len(left):
        seed, reached, left = left[0], left[:1], left[1:]
        while len(reached) and len(left):
            near = np.zeros(len(left), bool)
            for one in reached:
                near |= np.bitwise_count(left ^ one) <= max_bits
            reached, left = left[near], left[~near]
            tails.append(np.full(len(reached), seed))
            heads.append(reached)
    return tails, heads


def _link_batches(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(0)
        flat = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        sizes = np.diff(lists.offsets.to_numpy())
        starts = np.cumsum(sizes) - sizes
        two = starts[sizes == 2]
        a, b = flat[two], flat[two + 1]
        near = (np.bitwise_count(a ^ b) <= max_bits) & (a != b)
        tails, heads = [a[near]], [b[near]]
        for at, n in zip(starts[sizes > 2], sizes[sizes > 2]):
            more = _forest(flat[at : at + n], max_bits)
            tails += more[0]
            heads += more[1]
        made = [pa.array(np.concatenate(x).view(np.int64)) for x in (tails, heads)]
        yield pa.RecordBatch.from_arrays(made, ["a", "b"])


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, chunk: int = CHUNK) -> DataFrame:
    """Links ``(a, b)`` that connect all distinct fingerprints ``fp`` within ``max_bits`` of another.

    The links form the same components as all close pairs do, without listing the pairs.
    """
    keys = F.array(*[
        F.struct(F.lit(i).alias("block"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits"))
        for i, m in enumerate(block_masks(max_bits))
    ])
    rows = fps.select("fp", F.inline(keys))
    shared = rows.groupBy("block", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / F.lit(chunk)).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    dealt = (
        rows.join(shared, ["block", "bits"])
        .withColumn("parts", parts)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    )
    lists = (
        dealt.groupBy("block", "bits", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"))
        .agg(F.collect_list("fp").alias("found"))
        .where(F.size("found") > 1)
        .select("found")
    )
    return arrow_map(lists, partial(_link_batches, max_bits=max_bits), "a long, b long").distinct()


def simhash_components(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    chunk: int = CHUNK,
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row for each row of ``docs``.

    Documents are linked when their fingerprints differ in ``max_bits`` bits at most; the component
    is named after its smallest document id. Null and empty texts have fingerprint zero and are
    linked like any other. Repeated rows keep their number; a null id stays null and never names a
    component that has another id. Other columns are not carried. An empty table gives no rows.
    """
    hashed = arrow_map(
        documents(docs, doc_id, text),
        partial(_fingerprint_batches, shingle_words=shingle_words),
        f"doc_id {docs.schema[doc_id].dataType.simpleString()}, fp long",
    )
    hashed = checkpointed(hashed)
    fps = hashed.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(fingerprint_links(fps.select("fp"), max_bits, chunk))
    linked = fps.join(roots, fps.fp == roots.node).select("fp", "least", "root")
    names = linked.groupBy("root").agg(F.min("least").alias("named"))
    named = linked.select("fp", "root").join(names, "root").select("fp", "named")
    classes = fps.join(named, "fp", "left").select("fp", F.coalesce("named", "least").alias("component_id"))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return hashed.join(classes, "fp").select("doc_id", hexed.alias("fingerprint"), "component_id")


def keep_one_per_component(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` whose document names its component, with all their columns.

    Rows that repeat a kept id all stay. Rows with a null id share that null as their id: all of
    them stay if one is in a component without any other id, else all go.
    """
    found = simhash_components(docs, doc_id, text, **options)
    kept = found.where(F.col("component_id").eqNullSafe(F.col("doc_id")))
    key = unused(docs, "_kept")
    kept = kept.select(F.col("doc_id").alias(key)).distinct()
    return docs.join(kept, docs[doc_id].eqNullSafe(F.col(key)), "left_semi")
