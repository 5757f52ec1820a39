"""Tokens of two tokenizers side by side: the groups between byte offsets where tokens of both end.

A text is cut into byte ranges, and each range gives a fragment: the tokens up to its first common
end (open prefix), the groups between common ends (closed), the tokens after its last common end
(open suffix). Joining two neighbours closes one group at most, from the suffix of one and the prefix
of the other, and the order of joins does not matter; so the fragments of very long texts are made by
different tasks and joined as a tree. A range may begin and end inside a token: a token belongs to the
range it ends in.

A range is tokenised with the whole units that it touches: a unit is a space and the word behind it, at
whose edges both tokenizers end a token. A single unit that is longer than a range is not cut, because
no tokenizer can begin inside it. Many texts or ranges are aligned at once, by numpy.

Links are the pairs of tokens that share a group. Their counts come from one row of distinct pairs for
each part, a bounded stretch of texts: counts are summed over parts, and go back to a part once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field, replace
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from demandkit.llm import words
from demandkit.llm.common import arrow_map, checkpointed, documents
from demandkit.session import new_folder

#: Bytes of a range; longer texts are cut into such.
RANGE_BYTES = 1 << 15
#: Fragments joined by one task in one round.
FAN = 8
#: Bytes of text in one part, whose distinct pairs are sent together.
PART_BYTES = 8 << 20
#: Links of one group that are listed one by one; more are counted by pairs of ids.
_LISTED = 1 << 14
_LONG_PARTS = 1 << 40
#: Characters of texts aligned at once.
_TOGETHER = 1 << 16
_ROW = "kind int, part long, doc_id long, copies long, n_a long, n_b long, n_groups long, n_links long, groups binary, codes binary, times binary"
_FRAGMENT = "pre_a binary, pre_b binary, met boolean, closed binary, codes binary, times binary, n_a long, n_b long, n_groups long, n_links long, suf_a binary, suf_b binary, ok boolean"


def _summed(codes: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Each code once, in order, with the sum of its times."""
    if not codes:
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    once, at = np.unique(np.concatenate(codes), return_inverse=True)
    total = np.zeros(len(once), np.int64)
    np.add.at(total, at, np.concatenate(times))
    return once, total


def group_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all pairs of one group, each once, with how often it occurs."""
    (ids_a, times_a), (ids_b, times_b) = (np.unique(x.astype(np.uint32), return_counts=True) for x in (a, b))
    return (ids_a[:, None] << np.uint32(16) | ids_b).ravel(), (times_a[:, None] * times_b).ravel().astype(np.int64)


def group_text(a: np.ndarray, b: np.ndarray) -> bytes:
    return b"%s|%s;" % (",".join(map(str, a.tolist())).encode(), ",".join(map(str, b.tolist())).encode())


_NONE16 = np.empty(0, np.uint16)
_NONE32, _NONE64 = np.empty(0, np.uint32), np.empty(0, np.int64)


@dataclass
class Fragment:
    """What is known of one byte range; ``+`` puts the next range behind it, and is associative.

    ``met``: some tokens of both end at one place in it. If none do, all its tokens are its prefix.
    ``closed``, ``codes``, ``times`` and the counts are about closed groups only.
    """

    pre_a: np.ndarray = field(default_factory=lambda: _NONE16)
    pre_b: np.ndarray = field(default_factory=lambda: _NONE16)
    met: bool = False
    closed: bytes = b""
    codes: np.ndarray = field(default_factory=lambda: _NONE32)
    times: np.ndarray = field(default_factory=lambda: _NONE64)
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    suf_a: np.ndarray = field(default_factory=lambda: _NONE16)
    suf_b: np.ndarray = field(default_factory=lambda: _NONE16)
    ok: bool = True

    def __add__(self, other: Fragment) -> Fragment:
        ok = self.ok and other.ok
        # a fragment that begins where tokens of both end has met them, and an empty prefix
        if not self.met:
            pre = np.concatenate([self.pre_a, other.pre_a]), np.concatenate([self.pre_b, other.pre_b])
            return replace(other, pre_a=pre[0], pre_b=pre[1], ok=ok)
        a, b = np.concatenate([self.suf_a, other.pre_a]), np.concatenate([self.suf_b, other.pre_b])
        if not other.met:
            return replace(self, suf_a=a, suf_b=b, ok=ok)
        return self._closing(a, b, other, ok)

    def _closing(self, a: np.ndarray, b: np.ndarray, other: Fragment, ok: bool) -> Fragment:
        if not len(a) and not len(b):  # what comes next begins at a common end
            text, one = b"", 0
        else:
            text, one = group_text(a, b), 1
        codes, times = group_pairs(a, b)
        codes, times = _summed([self.codes, codes, other.codes], [self.times, times, other.times])
        return Fragment(
            self.pre_a, self.pre_b, True, self.closed + text + other.closed, codes, times,
            self.n_a + len(a) + other.n_a, self.n_b + len(b) + other.n_b, self.n_groups + one + other.n_groups,
            self.n_links + len(a) * len(b) + other.n_links, other.suf_a, other.suf_b, ok,
        )

    def whole(self) -> Fragment:
        """As the fragment of a whole text: its beginning closes the prefix, its end needs no suffix."""
        begun = Fragment(met=True)
        done = begun + self
        return replace(done, ok=done.ok and not len(done.suf_a) and not len(done.suf_b))

    def row(self) -> tuple:
        return (
            self.pre_a.tobytes(), self.pre_b.tobytes(), self.met, self.closed, self.codes.tobytes(), self.times.tobytes(),
            self.n_a, self.n_b, self.n_groups, self.n_links, self.suf_a.tobytes(), self.suf_b.tobytes(), self.ok,
        )

    @staticmethod
    def of(row: dict) -> Fragment:
        kinds = {"pre_a": np.uint16, "pre_b": np.uint16, "suf_a": np.uint16, "suf_b": np.uint16, "codes": np.uint32, "times": np.int64}
        return Fragment(**{k: np.frombuffer(v, kinds[k]) if k in kinds else v for k, v in row.items()})


class Aligner:
    """Both tokenizers, and the bytes of their tokens."""

    def __init__(self, byte_bpe: str = words.BYTE_BPE, piece_bpe: str = words.PIECE_BPE):
        self.a = words.PlainBytes(byte_bpe)
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_bpe)
        letters = words.byte_alphabet()
        self.bytes_a = [b""] * (max(self.a.vocabulary.values()) + 1)
        for token, i in self.a.vocabulary.items():
            # added tokens are no byte-level strings; they are never met, as their strings are plain text
            self.bytes_a[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.bytes_b = [self._piece(i) for i in range(self.b.vocab_size())]
        self.length_a, self.length_b = (np.array([len(t) for t in x], np.int64) for x in (self.bytes_a, self.bytes_b))
        # how an id is written before another of its side, and as the last one
        self.written = [b"%d%s" % (i, mark) for x, marks in ((self.bytes_a, b",|"), (self.bytes_b, b",;")) for mark in (marks[:1], marks[1:]) for i in range(len(x))]
        self.written_length = np.array([len(w) for w in self.written], np.int64)

    def _piece(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:5], 16)])
        return self.b.id_to_piece(i).replace("▁", " ").encode()

    def tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids of a space and each text on both sides; nothing where the tokens' bytes are others."""
        made = []
        for text, ids_b in zip(texts, self.b.encode(texts, num_threads=1) if texts else []):
            ids_a, real = np.array(self.a.encode(" " + text), np.uint16), b" " + text.encode()
            # a byte-level vocabulary has every byte: its tokens can but be as long as the text
            spelt = self.length_a[ids_a].sum() == len(real) and b"".join(map(self.bytes_b.__getitem__, ids_b)) == real
            made.append((ids_a, np.array(ids_b, np.uint16)) if spelt else None)
        return made

    def fragments(self, jobs: list[tuple[str, int, int]]) -> list[Fragment]:
        """For each text, the tokens of a space and it that end after ``skip`` bytes and not after ``upto``; all at once."""
        found = self.tokens([t for t, *_ in jobs])
        fine = [n for n, x in enumerate(found) if x is not None]
        out = [Fragment(met=True, ok=False)] * len(jobs)
        if not fine:
            return out
        sides = []
        for k, lengths in enumerate((self.length_a, self.length_b)):
            ids = np.concatenate([found[n][k] for n in fine]).astype(np.int64)
            sides.append((ids, np.cumsum(lengths[ids])))
        # both sides cover the same bytes, text by text
        sizes = np.array([len(jobs[n][0].encode()) + 1 for n in fine], np.int64)
        base = np.cumsum(sizes) - sizes
        low, high = (base + np.array([jobs[n][k] for n in fine], np.int64) for k in (1, 2))
        kept = []
        for ids, ends in sides:
            job = np.searchsorted(base + sizes, ends, "left")
            inside = (ends > low[job]) & (ends <= high[job])
            kept += [ids[inside], ends[inside]]
        ids_a, ends_a, ids_b, ends_b = kept
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        # a range also ends what is open at its end
        edges = np.union1d(common, high)
        group_a, group_b = np.searchsorted(edges, ends_a), np.searchsorted(edges, ends_b)
        many_a, many_b = np.bincount(group_a, minlength=len(edges)), np.bincount(group_b, minlength=len(edges))
        upto_a, upto_b = np.cumsum(many_a), np.cumsum(many_b)
        # ids as written: those of one side, then those of the other, group by group
        nth_a, nth_b = np.arange(len(ids_a)), np.arange(len(ids_b))
        order = np.empty(len(ids_a) + len(ids_b), np.int64)
        order[nth_a + (upto_b - many_b)[group_a]] = ids_a + len(self.bytes_a) * (nth_a == upto_a[group_a] - 1)
        order[nth_b + upto_a[group_b]] = 2 * len(self.bytes_a) + ids_b + len(self.bytes_b) * (nth_b == upto_b[group_b] - 1)
        text = b"".join(map(self.written.__getitem__, order.tolist()))
        text_ends = np.concatenate([[0], np.cumsum(self.written_length[order])])[upto_a + upto_b]
        # pairs one by one, but for groups with very many
        links = many_a * many_b
        listed = np.where(links > _LISTED, 0, many_b)[group_a]
        place = np.repeat(np.cumsum(listed) - listed, listed)
        partner = np.arange(len(place)) - place + np.repeat((upto_b - many_b)[group_a], listed)
        codes = np.repeat(ids_a.astype(np.uint32), listed) << np.uint32(16) | ids_b[partner].astype(np.uint32)
        code_ends, link_ends = np.cumsum(np.where(links > _LISTED, 0, links)), np.cumsum(links)

        def upto(ends: np.ndarray, g: int) -> int:
            return int(ends[g - 1]) if g else 0

        first_group, after = np.searchsorted(edges, low, "right"), np.searchsorted(edges, high, "right")
        met_end = np.isin(high, common)
        for n, first, last, ended in zip(fine, first_group.tolist(), after.tolist(), met_end.tolist()):
            begun = jobs[n][1] == 0  # a text begins where tokens of both sides do
            a, b = first + (not begun), last - (not ended)
            pre = slice(upto(upto_a, first), upto(upto_a, a)), slice(upto(upto_b, first), upto(upto_b, a))
            if not begun and a == last and not ended:
                out[n] = Fragment(ids_a[pre[0]].astype(np.uint16), ids_b[pre[1]].astype(np.uint16))
                continue
            suf = slice(upto(upto_a, b), upto(upto_a, last)), slice(upto(upto_b, b), upto(upto_b, last))
            once, times = np.unique(codes[upto(code_ends, a) : upto(code_ends, b)], return_counts=True)
            large = [g for g in range(a, b) if links[g] > _LISTED] if upto(code_ends, b) - upto(code_ends, a) < upto(link_ends, b) - upto(link_ends, a) else []
            if large:
                more = [group_pairs(ids_a[upto(upto_a, g) : upto_a[g]], ids_b[upto(upto_b, g) : upto_b[g]]) for g in large]
                once, times = _summed([once, *(c for c, _ in more)], [times, *(t for _, t in more)])
            out[n] = Fragment(
                ids_a[pre[0]].astype(np.uint16), ids_b[pre[1]].astype(np.uint16), True,
                text[upto(text_ends, a) : upto(text_ends, b)], once, times.astype(np.int64),
                upto(upto_a, b) - upto(upto_a, a), upto(upto_b, b) - upto(upto_b, a), b - a, upto(link_ends, b) - upto(link_ends, a),
                ids_a[suf[0]].astype(np.uint16), ids_b[suf[1]].astype(np.uint16),
            )
        return out

    def documents(self, texts: list[str]) -> list[Fragment]:
        """Whole texts; empty ones stand for nothing."""
        made = iter(self.fragments([(t, 0, len(t.encode()) + 1) for t in texts if t]))
        return [next(made) if t else Fragment(ok=False) for t in texts]


def ranges(text: str, size: int = RANGE_BYTES) -> list[tuple[str, int, int]]:
    """A space and ``text`` cut into byte ranges, each with the units it touches: text, skipped bytes, last byte."""
    own = words.units(text)
    lengths = np.array([len(u.encode()) + 1 for u in own], np.int64)
    ends = np.cumsum(lengths)
    cuts = np.arange(size, ends[-1], size)
    at = np.searchsorted(ends, cuts, "left")
    # a unit longer than a range stays whole: cuts inside it move to its end
    cuts = np.unique(np.where((lengths[at] > size) & (cuts < ends[at]), ends[at], cuts))
    edges = [0, *cuts[cuts < ends[-1]].tolist(), int(ends[-1])]
    made = []
    for low, high in zip(edges, edges[1:]):
        a, b = np.searchsorted(ends, low, "right"), np.searchsorted(ends, high, "left") + 1
        begin = int(ends[a] - lengths[a])
        made.append((" ".join(own[a:b]), low - begin, high - begin))
    return made


class _Parts:
    """Rows of documents, and one row of distinct pairs behind each part of them."""

    def __init__(self, first: int, groups: bool):
        self.part, self.groups = first, groups
        self.rows, self.codes, self.copies, self.held = [], [], [], 0

    def add(self, doc_id: int | None, copies: int, found: Fragment, size: int) -> None:
        if not found.ok or not found.n_groups:
            self.rows.append((0, self.part, doc_id, copies, 0, 0, 0, 0, b"", b"", b""))
        else:
            text = found.closed[:-1]
            shown = text if self.groups else hashlib.sha256(text).hexdigest().encode()
            self.rows.append((0, self.part, doc_id, copies, found.n_a, found.n_b, found.n_groups, found.n_links, shown, found.codes.tobytes(), found.times.astype("<u4").tobytes() if found.n_links < 1 << 32 else found.times.astype("<i8").tobytes()))
            self.codes.append(found.codes)
            self.copies.append(np.full(len(found.codes), copies, np.int64))
        self.held += size

    def take(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        return _batch(rows, _ROW)

    def finish(self) -> pa.RecordBatch:
        codes, docs = _summed(self.codes, self.copies)
        self.rows.append((1, self.part, None, 0, 0, 0, 0, 0, b"", codes.tobytes(), docs.tobytes()))
        self.codes, self.copies, self.held = [], [], 0
        self.part += 1
        return self.take()


_ARROW = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "string": pa.string(), "double": pa.float64()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(c.split() for c in schema.split(", ")))
    columns = zip(*rows) if rows else ((),) * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[k]) for c, k in zip(columns, kinds)], list(names))


def _rows_of(found: Iterable[tuple[int | None, int, Fragment, int]], first: int, part_bytes: int, groups: bool) -> Iterator[pa.RecordBatch]:
    parts = _Parts(first + (TaskContext.get().partitionId() << 20), groups)
    for one in found:
        parts.add(*one)
        if parts.held >= part_bytes:
            yield parts.finish()
        elif len(parts.rows) >= 2000:
            yield parts.take()
    if parts.codes or parts.rows or parts.held:
        yield parts.finish()


def _short(batches: Iterator[pa.RecordBatch], paths: tuple[str, str], part_bytes: int, groups: bool) -> Iterator[pa.RecordBatch]:
    aligner = Aligner(*paths)

    def found():
        for batch in batches:
            ids, texts, low = batch.column(0).to_pylist(), batch.column(1).to_pylist(), 0
            while low < len(ids):
                high, size = low, 0
                while high < len(ids) and size < _TOGETHER:
                    size, high = size + len(texts[high]), high + 1
                for doc_id, text, one in zip(ids[low:high], texts[low:high], aligner.documents(texts[low:high])):
                    yield doc_id, 1, one, len(text) + 1
                low = high

    yield from _rows_of(found(), 0, part_bytes, groups)


def _cut_long(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            rows = [(key, n, t, skip, upto) for n, (t, skip, upto) in enumerate(ranges(text, size))]
            for at in range(0, len(rows), 64):
                yield _batch(rows[at : at + 64], "key binary, seq long, text string, skip long, upto long")


def _fragments(batches: Iterator[pa.RecordBatch], paths: tuple[str, str]) -> Iterator[pa.RecordBatch]:
    aligner = Aligner(*paths)
    for batch in batches:
        rows = batch.to_pylist()
        for at in range(0, len(rows), 8):
            some = rows[at : at + 8]
            made = aligner.fragments([(r["text"], r["skip"], r["upto"]) for r in some])
            yield _batch([(r["key"], r["seq"], *f.row()) for r, f in zip(some, made)], f"key binary, seq long, {_FRAGMENT}")


def _joined(key: tuple, table: pa.Table) -> pa.Table:
    """The fragments of one stretch in their order, as one."""
    rows = sorted(table.select(["seq", *(c.split()[0] for c in _FRAGMENT.split(", "))]).to_pylist(), key=lambda r: r.pop("seq"))
    made = reduce(Fragment.__add__, map(Fragment.of, rows))
    return pa.Table.from_batches([_batch([(key[0].as_py(), key[1].as_py(), *made.row())], f"key binary, seq long, {_FRAGMENT}")])


def _finished(batches: Iterator[pa.RecordBatch], part_bytes: int, groups: bool) -> Iterator[pa.RecordBatch]:
    def found():
        for batch in batches:
            for row in batch.to_pylist():
                ids = row.pop("doc_id"), row.pop("copies")
                size = row.pop("size")
                yield *ids, Fragment.of({k: v for k, v in row.items() if k not in ("key", "seq")}).whole(), size

    yield from _rows_of(found(), _LONG_PARTS, part_bytes, groups)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, codes, docs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            own, n = np.frombuffer(codes, np.uint32).astype(np.int64), np.frombuffer(docs, np.int64)
            for at in range(0, len(own), 1 << 16):
                cut = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own[cut]), part)), pa.array(own[cut]), pa.array(n[cut])], ["part", "code", "docs"])


_RESULT = "doc_id long, copies long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups binary"


def _counted(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """The documents of one part with the counts of their pairs."""
    codes, order = (lambda c: (c, np.argsort(c)))(pairs.column("code").to_numpy())
    codes, counts, best = codes[order], pairs.column("n").to_numpy()[order], pairs.column("best").to_numpy()[order]
    rows = []
    for r in docs.to_pylist():
        own = np.searchsorted(codes, np.frombuffer(r["codes"], np.uint32).astype(np.int64))
        times = np.frombuffer(r["times"], "<u4" if 4 * len(own) == len(r["times"]) else "<i8").astype(np.int64)
        rows.append((*(r[c] for c in ("doc_id", "copies", "n_a", "n_b", "n_groups", "n_links")), int((times * best[own]).sum()), int((times * counts[own]).sum()), r["groups"]))
    return pa.Table.from_batches([_batch(rows, _RESULT)])


def align_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", byte_bpe: str = words.BYTE_BPE, piece_bpe: str = words.PIECE_BPE,
    range_bytes: int = RANGE_BYTES, fan: int = FAN, part_bytes: int = PART_BYTES, digest: bool = False,
) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)``, one row for each row of ``docs``.

    ``groups`` is ``a1,a2|b1;a3|b2,b3``: ids of both sides by group, or with ``digest`` the SHA-256 of
    that. ``n_best`` counts the links whose pair is held by as many documents as any pair of that first
    id, ``count_sum`` adds up for all links how many documents hold the pair. Texts that are null, empty
    or not what their tokens spell have zeros and empty ``groups``. Every row is a document, also one
    that repeats an id or has none. Other columns are not carried. An empty table gives no rows.
    """
    spark = docs.sparkSession
    paths = byte_bpe, piece_bpe
    base = documents(docs, doc_id, text).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    is_long = F.octet_length("text") > range_bytes
    short = arrow_map(base.where(~is_long), partial(_short, paths=paths, part_bytes=part_bytes, groups=not digest), _ROW)
    # of long texts each is cut once, also if rows repeat it
    key = F.unhex(F.sha2(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "text"), 256))
    long = base.where(is_long).groupBy(key.alias("key")).agg(
        F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"), F.first(F.octet_length("text")).cast("long").alias("size")
    )
    long = checkpointed(long)
    most = long.agg(F.max("size")).first()[0] or 0
    pieces = arrow_map(long.select("key", "text"), partial(_cut_long, size=range_bytes), "key binary, seq long, text string, skip long, upto long")
    # the ranges of one text go to different tasks
    found = arrow_map(pieces.repartition("key", "seq"), partial(_fragments, paths=paths), f"key binary, seq long, {_FRAGMENT}")
    spread = most // range_bytes + 1
    while spread:
        found = found.groupBy("key", F.floor(F.col("seq") / fan).alias("at")).applyInArrow(_joined, f"key binary, seq long, {_FRAGMENT}")
        spread //= fan
    found = found.join(long.drop("text"), "key")
    made = arrow_map(found, partial(_finished, part_bytes=part_bytes, groups=not digest), _ROW)
    rows = new_folder(spark, "aligned")
    short.union(made).write.option("compression", "zstd").parquet(rows)
    rows = spark.read.parquet(rows)

    pairs = arrow_map(rows.where("kind = 1").select("part", "codes", "times"), _pairs, "part long, code long, docs long")
    counts = pairs.groupBy("code").agg(F.sum("docs").alias("n"))
    first = F.shiftright("code", 16)
    counts = checkpointed(counts.withColumn("first", first))
    highest = counts.groupBy("first").agg(F.max("n").alias("highest"))
    counts = counts.join(highest, "first").select("code", "n", (F.col("n") == F.col("highest")).alias("best"))
    counted = pairs.select("part", "code").join(counts, "code")
    own = rows.where("kind = 0").drop("kind")
    result = own.groupBy("part").cogroup(counted.groupBy("part")).applyInArrow(_counted, _RESULT)
    again = F.explode(F.expr("array_repeat(0, cast(copies as int))")).alias("_again")
    result = result.select("*", again).drop("_again", "copies")
    return result.withColumn("groups", F.col("groups").cast("string"))
