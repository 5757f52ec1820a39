"""Lines found in many documents are dropped, by probing a sharded minimal perfect hash.

The distinct line hashes are dealt to shards of bounded size. A shard's keys are placed by a minimal
perfect hash (bit arrays of falling size, a key taking the first bit it has to itself, the rank of
the bit being its slot), and three arrays follow the slots: a 32-bit fingerprint, the number of
documents, the last document. Documents send their line hashes, not their lines, past the arrays.
Lines that hold more than a thousandth of all occurrences, at most ``HEAVY`` of them, are known
before that and never travel. A shard that is asked more than ``PROBES`` times for its other lines is
copied, and its probes are dealt to the copies: no task answers many more than that, however many
documents there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType
from xxhash import xxh3_128_digest

from demandkit.llm.common import arrow_map, checkpointed, documents, texts, with_marks

MIN_CHARS = 40
MIN_DOCS = 5
SHARD_KEYS = 1 << 16
HEAVY = 1024
PROBES = 1 << 22
_SPACE = b" \t\n\x0b\x0c\r"
_NO_DOC = -(1 << 63)
_KEY = np.dtype([("h1", "<u8"), ("h2", "<u8")])


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """Hash of the line without outer white space, A-Z lower-cased; None if it is too short."""
    key = line.strip(_SPACE).lower()
    if len(key) < min_chars or not key.isascii() and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return xxh3_128_digest(key)


def _line_batches(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    """One row for each document and distinct line hash in it."""
    for batch in batches:
        found = [{line_key(x, min_chars) for x in t.split(b"\n")} - {None} for t in texts(batch.column(2))]
        rows = np.repeat(np.arange(len(found)), [len(x) for x in found])
        keys = np.frombuffer(b"".join(k for x in found for k in sorted(x)), _KEY)
        hashes = [pa.array(keys[h].view(np.int64)) for h in ("h1", "h2")]
        own = [batch.column(c).take(pa.array(rows)) for c in (0, 1)]
        yield pa.RecordBatch.from_arrays([*own, *hashes], ["doc_id", "hash", "h1", "h2"])


# ---- the minimal perfect hash of one shard


def _mix(h1: np.ndarray, h2: np.ndarray, level: int) -> np.ndarray:
    x = h1 ^ (h2 + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def build_hash(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of each level, and all levels' words one after the other, for distinct keys."""
    sizes, words = [], []
    while len(h1):
        n = -(-3 * len(h1) // 128)  # 64-bit words: 1.5 bits a key
        at = (_mix(h1, h2, len(sizes)) % np.uint64(64 * n)).astype(np.int64)
        alone = np.bincount(at, minlength=64 * n) == 1
        words.append(np.packbits(alone, bitorder="little").view(np.uint64))
        sizes.append(n)
        rest = ~alone[at]
        h1, h2 = h1[rest], h2[rest]
    return np.array(sizes, np.int64), np.concatenate(words) if words else np.zeros(0, np.uint64)


def slots(sizes: np.ndarray, words: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """The slot of every key; -1 where a key that was not built in meets no bit."""
    before = np.cumsum(np.bitwise_count(words).astype(np.int64)) - np.bitwise_count(words)
    found, left, start = np.full(len(h1), -1, np.int64), np.arange(len(h1)), 0
    for level, n in enumerate(sizes.tolist()):
        at = _mix(h1[left], h2[left], level) % np.uint64(64 * n)
        word, bit = start + (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        own = words[word]
        hit = (own >> bit) & np.uint64(1) == 1
        lower = own & ((np.uint64(1) << bit) - np.uint64(1))
        found[left[hit]] = (before[word] + np.bitwise_count(lower))[hit]
        left, start = left[~hit], start + n
    return found


_SHARD = "shard int, sizes binary, words binary, prints binary, counts binary, lasts binary, probes long, heavy array<binary>, heavy_lasts array<long>"


def _build_shard(rows: pa.Table, heavy_from: int, min_docs: int) -> pa.Table:
    h1, h2, n, held, last = (rows.column(c).to_numpy() for c in ("h1", "h2", "n", "held", "last"))
    h1, h2 = h1.view(np.uint64), h2.view(np.uint64)
    sizes, words = build_hash(h1, h2)
    order = slots(sizes, words, h1, h2)
    prints, counts, lasts = np.empty(len(n), np.uint32), np.empty(len(n), np.uint32), np.empty(len(n), np.int64)
    prints[order] = h2 & np.uint64(0xFFFFFFFF)
    counts[order] = np.minimum(n, 0xFFFFFFFF)
    lasts[order] = last
    many = (held > heavy_from) & (n >= min_docs)
    keys = np.empty(int(many.sum()), _KEY)
    keys["h1"], keys["h2"] = h1[many], h2[many]
    packed = [[x.tobytes()] for x in (sizes, words, prints, counts, lasts)]
    columns = [pa.array([rows.column("shard")[0].as_py()], pa.int32()), *[pa.array(x, pa.binary()) for x in packed]]
    columns.append(pa.array([int(held[~many].sum())], pa.int64()))
    columns += [pa.array([[k.tobytes() for k in keys]], pa.list_(pa.binary())), pa.array([last[many].tolist()], pa.list_(pa.int64()))]
    return pa.Table.from_arrays(columns, [c.split()[0] for c in _SHARD.split(", ")])


def build_index(lines: DataFrame, n_lines: int, min_docs: int = MIN_DOCS, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """One row of arrays per shard over all distinct hashes of ``lines(doc_id, h1, h2)``."""
    shards = max(1, -(-n_lines // shard_keys))
    # rows of one id are one document, rows without an id are one each
    by_doc = lines.groupBy("h1", "h2", "doc_id").agg(F.count(F.lit(1)).alias("held"))
    counted = by_doc.groupBy("h1", "h2").agg(
        F.sum(F.when(F.col("doc_id").isNull(), F.col("held")).otherwise(1)).alias("n"),
        F.sum("held").alias("held"),
        F.coalesce(F.max("doc_id").cast("long"), F.lit(_NO_DOC)).alias("last"),
    )
    counted = counted.withColumn("shard", F.pmod("h1", F.lit(shards)).cast("int"))
    build = partial(_build_shard, heavy_from=n_lines // HEAVY, min_docs=min_docs)
    return counted.groupBy("shard").applyInArrow(lambda rows: build(rows), _SHARD)


def _probe_batches(batches: Iterator[pa.RecordBatch], min_docs: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard and copy, its arrays first; yields the lines a document has to drop."""
    arrays = None
    for batch in batches:
        kinds = batch.column("kind").to_numpy()
        cuts = [0, *np.flatnonzero(kinds == 0).tolist(), batch.num_rows]
        for low, high in zip(cuts, cuts[1:]):
            if low < high and kinds[low] == 0:
                row = batch.slice(low, 1).to_pylist()[0]
                arrays = [np.frombuffer(row[c], t) for c, t in (("sizes", np.int64), ("words", np.uint64), ("prints", np.uint32), ("counts", np.uint32), ("lasts", np.int64))]
                low += 1
            if low >= high:
                continue
            part = batch.slice(low, high - low)
            keys = np.empty(high - low, _KEY)
            keys["h1"], keys["h2"] = (part.column(h).to_numpy().view(np.uint64) for h in ("h1", "h2"))
            doc = part.column("doc_id").cast(pa.int64())
            sizes, words, prints, counts, lasts = arrays
            at = slots(sizes, words, keys["h1"], keys["h2"])
            drop = (at >= 0) & (prints[at] == (keys["h2"] & np.uint64(0xFFFFFFFF))) & (counts[at] >= min_docs)
            drop &= (lasts[at] != doc.fill_null(0).to_numpy()) | doc.is_null().to_numpy(zero_copy_only=False)
            marks = pa.array([k.tobytes() for k in keys[drop]], pa.binary())
            own = [doc.filter(pa.array(drop)), part.column("hash").filter(pa.array(drop))]
            yield pa.RecordBatch.from_arrays([*own, marks], ["doc_id", "hash", "mark"])


def _heavy_batches(batches: Iterator[pa.RecordBatch], heavy: dict[bytes, int], wanted: bool) -> Iterator[pa.RecordBatch]:
    """The rows of heavy lines as marks (``wanted``), or the rows of all other lines."""
    known = np.array(sorted(np.frombuffer(k, _KEY)["h1"][0] for k in heavy), np.uint64)
    for batch in batches:
        h1, h2 = (batch.column(h).to_numpy().view(np.uint64) for h in ("h1", "h2"))
        maybe = np.isin(h1, known)
        keys = np.empty(int(maybe.sum()), _KEY)
        keys["h1"], keys["h2"] = h1[maybe], h2[maybe]
        keys = [k.tobytes() for k in keys]
        is_heavy = np.array([k in heavy for k in keys], bool)
        if not wanted:
            maybe[maybe] = is_heavy
            yield batch.filter(pa.array(~maybe))
            continue
        own = [batch.column(c).cast(pa.int64()).filter(pa.array(maybe)).to_pylist() for c in ("doc_id", "hash")]
        gone = [(d, x, k) for d, x, k, yes in zip(*own, keys, is_heavy) if yes and heavy[k] != d]
        columns = [pa.array([g[i] for g in gone], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.binary()))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "hash", "mark"])


def _rewrite(batches: Iterator[pa.RecordBatch], at: int, min_chars: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = []
        for text, marks in zip(texts(batch.column(at)), batch.column(batch.num_columns - 1).to_pylist()):
            lines = text.split(b"\n")
            gone = set(marks or ())
            kept = [x for x in lines if line_key(x, min_chars) not in gone] if gone else lines
            made.append((b"\n".join(kept), len(lines), len(lines) - len(kept)))
        new, total, dropped = zip(*made) if made else ((), (), ())
        columns = dict(zip(batch.schema.names[:-1], batch.columns[:-1]))
        columns[batch.schema.names[at]] = pa.array(new, pa.binary()).cast(pa.string())
        columns |= {"n_lines": pa.array(total, pa.int64()), "n_dropped": pa.array(dropped, pa.int64())}
        yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)


def dedup_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
    shard_keys: int = SHARD_KEYS,
) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``, and ``n_lines``, ``n_dropped``.

    A line's key is the line without outer white space, A-Z lower-cased. Keys of ``min_chars`` code
    points or more that ``min_docs`` documents hold lose all their lines but those of the largest id
    holding them. Rows that repeat an id are one document, and all keep a line that this id may keep.
    Every row with a null id is a document of its own, and never is the one that keeps. A null text counts as
    empty, has one line and becomes empty. Input columns named like the two counts are replaced;
    ids are integers.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    lines = checkpointed(
        arrow_map(
            documents(docs, doc_id, text).select("doc_id", F.xxhash64("text").alias("hash"), "text"),
            partial(_line_batches, min_chars=min_chars),
            f"doc_id {kind}, hash long, h1 long, h2 long",
        )
    )
    n_lines = lines.count()
    index = checkpointed(build_index(lines, n_lines, min_docs, shard_keys))
    # at most HEAVY rows: each holds more than 1/HEAVY of all occurrences
    most = index.select(F.explode(F.arrays_zip("heavy", "heavy_lasts")).alias("x")).select("x.*").collect()
    heavy = {bytes(r.heavy): r.heavy_lasts for r in most}

    shards = max(1, -(-n_lines // shard_keys))
    # shards asked more than PROBES times: one row for so many occurrences at most
    asked = index.where(F.col("probes") > PROBES).select("shard", F.ceil(F.col("probes") / PROBES).cast("int").alias("copies"))
    asked = F.broadcast(asked)
    once = F.coalesce("copies", F.lit(1))
    arrays = index.select("shard", "sizes", "words", "prints", "counts", "lasts").join(asked, "shard", "left")
    arrays = arrays.withColumn("copy", F.explode(F.sequence(F.lit(0), once - 1))).withColumn("kind", F.lit(0)).drop("copies")
    light = arrow_map(lines, partial(_heavy_batches, heavy=heavy, wanted=False), f"doc_id {kind}, hash long, h1 long, h2 long")
    probes = light.withColumn("shard", F.pmod("h1", F.lit(shards)).cast("int")).join(asked, "shard", "left")
    probes = probes.withColumn("copy", F.pmod(F.xxhash64("doc_id", "hash"), once).cast("int")).withColumn("kind", F.lit(1)).drop("copies")
    dealt = arrays.unionByName(probes, allowMissingColumns=True).repartition("shard", "copy").sortWithinPartitions("shard", "copy", "kind")
    made = "doc_id long, hash long, mark binary"
    marks = arrow_map(dealt, partial(_probe_batches, min_docs=min_docs), made)
    if heavy:
        marks = marks.union(arrow_map(lines, partial(_heavy_batches, heavy=heavy, wanted=True), made))

    out = StructType([f if f.name != text else StructField(text, StringType()) for f in docs.schema if f.name not in ("n_lines", "n_dropped")])
    out = out.add("n_lines", LongType()).add("n_dropped", LongType())
    marked = with_marks(docs, doc_id, text, marks)
    return arrow_map(marked, partial(_rewrite, at=docs.columns.index(text), min_chars=min_chars, names=out.names), out)
