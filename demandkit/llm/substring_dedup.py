"""Passages that repeat across documents, found as runs of consecutive sentences.

Every run of ``RUN`` consecutive sentences is hashed, once. The hashes are counted over the whole corpus
and joined back: a run that another document holds first is a repeated span, and the sentences it
covers go. A sentence ends at a line break, or at a full stop, exclamation or question mark before
white space. Longer ones than ``PIECE`` words are cut where the words themselves decide, at the smallest
word hash of every ``PIECE`` neighbouring words: two texts cut a passage they share at the same places,
whatever stands around it, and 4 * ``PIECE`` + 1 words always hold a whole run. Runs of fewer than
``MIN_WORDS`` words are lengthened sentence by sentence.

The hashes of a document are written down as one packed row; what comes back to its text is only
which of its runs go.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType
from xxhash import xxh3_128_digest, xxh64_intdigest

from demandkit.llm.common import arrow_map, documents, texts, unused
from demandkit.session import new_folder

RUN = 3
#: Longest piece between places that words decide: 4 * 12 + 1 words hold a whole run, 51 are asked for.
PIECE = 12
#: Runs of fewer words are no passage: short sentences repeat by chance.
MIN_WORDS = 13
_END = re.compile(rb"[.!?]+[\x20\x09-\x0D]+|\n[\x20\x09-\x0D]*")
_WORD = re.compile(rb"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*")
#: 96 bits of a run's hash, as Spark columns.
_KEY = np.dtype([("h1", "<i8"), ("h2", "<i4")])


def places(words: list[bytes], window: int = PIECE) -> list[int]:
    """Where the words say a sentence is cut: before the last smallest hash of each ``window`` words."""
    # sentences are short: a loop is faster than arrays here
    hashes = list(map(xxh64_intdigest, words))
    found, at = [], 0
    for low in range(1, len(words) - window + 1):
        high = low + window
        if at < low:
            at = min(range(high - 1, low - 1, -1), key=hashes.__getitem__)
        elif hashes[high - 1] <= hashes[at]:
            at = high - 1
        if not found or found[-1] != at:
            found.append(at)
    return found


def sentences(text: bytes, longest: int = PIECE) -> tuple[list[int], list[list[bytes]]]:
    """Where each sentence ends with what follows it, and its lower-cased words.

    White space alone belongs to the sentence before.
    """
    cuts = [0, *(m.end() for m in _END.finditer(text)), len(text)]
    ends, words = [], []
    for low, high in zip(cuts, cuts[1:]):
        part = text[low:high]
        found = part.lower().split()
        if not found:
            if part and ends:
                ends[-1] = high
            elif part:
                ends.append(high)
                words.append(found)
        elif len(found) <= longest:
            ends.append(high)
            words.append(found)
        else:
            cut = places(found, longest)
            stops = [m.end() for m in _WORD.finditer(part)]
            ends += [*(low + stops[i - 1] for i in cut), high]
            words += [found[i:j] for i, j in zip([0, *cut], [*cut, len(found)])]
    return ends, words


def spans(lengths: list[int], run: int = RUN, min_words: int = MIN_WORDS) -> list[tuple[int, int]]:
    """Where each run begins and ends, from the numbers of words of the sentences.

    A text of fewer sentences than a run has is one run. Runs with too few words get further sentences
    until they have enough; where the text ends before that, its last run gets sentences at its front
    instead. A text with too few words has no run.
    """
    n = len(lengths)
    upto = [0, *accumulate(lengths)]
    if upto[n] < min_words:
        return []
    made, high = [], 0
    for low in range(max(1, n - run + 1)):
        high = max(high, min(low + run, n))
        while high < n and upto[high] - upto[low] < min_words:
            high += 1
        if upto[high] - upto[low] < min_words:
            while upto[n] - upto[low] < min_words:
                low -= 1
            if not made or made[-1] != (low, n):
                made.append((low, n))
            break
        made.append((low, high))
    return made


def runs(words: list[list[bytes]], run: int = RUN, min_words: int = MIN_WORDS) -> list[bytes]:
    """Hash of each run, in the order of ``spans``."""
    digests = [xxh3_128_digest(b" ".join(w)) for w in words]
    return [xxh3_128_digest(b"".join(digests[low:high]))[:12] for low, high in spans(list(map(len, words)), run, min_words)]


def _packed(batches: Iterator[pa.RecordBatch], run: int, min_words: int) -> Iterator[pa.RecordBatch]:
    """One row for each text: its sentences, its distinct runs by their first place, and places of the others."""
    for batch in batches:
        made = []
        for text in texts(batch.column(2)):
            ends, words = sentences(text)
            first: dict[bytes, int] = {}
            again = [n for n, key in enumerate(runs(words, run, min_words)) if first.setdefault(key, n) != n]
            made.append((len(ends), b"".join(first), np.fromiter(first.values(), "<i4", len(first)).tobytes(), again))
        counts, keys, nths, repeats = zip(*made) if made else ((),) * 4
        columns = [pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), pa.array(nths, pa.binary()), pa.array(repeats, pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["doc_id", "hash", "n_sentences", "keys", "nths", "again"])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each text and distinct run in it."""
    for batch in batches:
        keys, nths = (batch.column(c).to_pylist() for c in (2, 3))
        rows = pa.array(np.repeat(np.arange(len(keys)), [len(n) // 4 for n in nths]))
        found = np.frombuffer(b"".join(keys), _KEY)
        columns = [pa.array(np.ascontiguousarray(found[h])) for h in ("h1", "h2")]
        nth = pa.array(np.frombuffer(b"".join(nths), "<i4"))
        yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), *columns, nth], ["doc_id", "hash", "h1", "h2", "nth"])


def without_runs(text: bytes, gone: list[int], run: int = RUN, min_words: int = MIN_WORDS) -> tuple[bytes, int]:
    """The text without the sentences in runs that are ``gone``, by number; how many sentences that are."""
    ends, words = sentences(text)
    found = spans(list(map(len, words)), run, min_words)
    lost = bytearray(len(ends))
    for n in gone:
        low, high = found[n]
        lost[low:high] = b"\x01" * (high - low)
    kept = b"".join(text[a:b] for a, b, x in zip([0, *ends], ends, lost) if not x)
    return kept, sum(lost)


def _rewrite(batches: Iterator[pa.RecordBatch], at: int, run: int, min_words: int, names: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total, marks = (batch.column(batch.num_columns - k) for k in (2, 1))
        made = [without_runs(t, m, run, min_words) if m else (t, 0) for t, m in zip(texts(batch.column(at)), marks.to_pylist())]
        new, lost = zip(*made) if made else ((), ())
        columns = dict(zip(batch.schema.names[:-2], batch.columns[:-2]))
        columns[batch.schema.names[at]] = pa.array(new, pa.binary()).cast(pa.string())
        columns |= {"n_sentences": total, "n_removed": pa.array(lost, pa.int64())}
        yield pa.RecordBatch.from_arrays([columns[n] for n in names], names)


def dedup_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", run: int = RUN, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated passages taken out of ``text``, and ``n_sentences``, ``n_removed``.

    The document with the smallest id keeps a repeated run, at its first place; everywhere else the
    sentences it covers go. Upper and lower case A-Z and the kind of white space make no difference.
    Rows that repeat an id are one document: each keeps what that id keeps. A row with a null id
    keeps a run that no row with an id holds. A null text becomes empty. Input columns named like
    the two counts are replaced. An empty table gives no rows.
    """
    spark = docs.sparkSession
    kind = docs.schema[doc_id].dataType.simpleString()
    base = documents(docs, doc_id, text).select("doc_id", F.xxhash64("text").alias("hash"), "text")
    packed = arrow_map(base, partial(_packed, run=run, min_words=min_words), f"doc_id {kind}, hash long, n_sentences long, keys binary, nths binary, again array<int>")
    folder = new_folder(spark, "runs")
    packed.write.option("compression", "zstd").parquet(folder)
    packed = spark.read.parquet(folder)
    held = arrow_map(packed.select("doc_id", "hash", "keys", "nths"), _unpacked, f"doc_id {kind}, hash long, h1 long, h2 int, nth int")
    # a third of all rows may hold one run: it is counted where it is, and its rows are dealt out by the join
    first = held.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first")).where("n > 1")
    repeated = held.join(first.drop("n"), ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("first")))
    # rows with one id and one text are one here, so that a list is no longer than its text; each text has a row
    names = {c: unused(docs, f"_{c}") for c in ("hash", "doc_id", "total", "gone")}
    marks = repeated.select("doc_id", "hash", "nth").union(packed.select("doc_id", "hash", F.explode("again")))
    rows = marks.withColumn("total", F.lit(None).cast("long")).union(packed.select("doc_id", "hash", F.lit(None), "n_sentences"))
    lists = rows.groupBy("doc_id", "hash").agg(F.max("total").alias(names["total"]), F.collect_set("nth").alias(names["gone"]))
    lists = lists.withColumnsRenamed({c: names[c] for c in ("doc_id", "hash")})
    own = docs.withColumn(unused(docs, "_own"), F.xxhash64(F.col(text)))
    same = own[doc_id].eqNullSafe(lists[names["doc_id"]]) & (own[unused(docs, "_own")] == lists[names["hash"]])
    marked = own.join(lists.hint("shuffle_hash"), same, "left").select(*[own[c] for c in docs.columns], names["total"], names["gone"])
    out = StructType([f if f.name != text else StructField(text, StringType()) for f in docs.schema if f.name not in ("n_sentences", "n_removed")])
    out = out.add("n_sentences", LongType()).add("n_removed", LongType())
    return arrow_map(marked, partial(_rewrite, at=docs.columns.index(text), run=run, min_words=min_words, names=out.names), out)
