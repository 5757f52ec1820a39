"""Token ids in files: blocks coded by adaptive context mixing, written and read by Spark tasks.

A file holds the ids of consecutive documents. It is a header, blocks, and a footer with the places of
the blocks:

- header: ``DKIDS1``, two zero bytes, ids in a block and end id as 32-bit numbers;
- block: ``BLK1``, number of ids, of document pieces, of payload bytes, CRC-32 of these and what follows; one
  entry for each piece of a document in it (id of the document, number of ids, flags: 1 it begins
  here, 2 it ends here, 4 its id is null), then the payload of ``mixing.encode_blocks``;
- footer: the offset of each block, their number, numbers of ids and documents, CRC-32, ``DKEND1``.

All numbers are little-endian. Any block can be decoded alone and is checked before that. Tasks write
under a name of their own and rename the finished file, so that a task that runs again replaces it by
the same content; files go to any file system that Arrow can open.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from demandkit.llm import mixing, words
from demandkit.llm.common import arrow_map, checkpointed, documents
from demandkit.session import new_folder

END_ID = 2
#: Ids in a block, and blocks coded side by side.
BLOCK, LANES = 4096, 2048
_HEAD, _BLOCK, _FOOT = "<8sII", "<4sIIII", "<QQQI8s"
_HEAD_SIZE, _BLOCK_SIZE, _FOOT_SIZE = map(struct.calcsize, (_HEAD, _BLOCK, _FOOT))
_PIECE = np.dtype([("doc", "<i8"), ("ids", "<u4"), ("flags", "u1")])
_BEGINS, _ENDS, _NULL = 1, 2, 4
#: Bytes of ids in one batch that goes back to Spark.
_BATCH = 8 << 20


class CorruptFile(ValueError):
    """A file that is cut short or whose checksums do not hold."""


def _open(path: str) -> tuple[fs.FileSystem, str]:
    # Hadoop writes file:/x where others write file:///x
    return fs.FileSystem.from_uri("file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path)


def _crc(n: int, many: int, length: int, body: bytes) -> int:
    return zlib.crc32(body, zlib.crc32(struct.pack("<III", n, many, length)))


def pack_blocks(pieces: np.ndarray, ids: np.ndarray, block: int = BLOCK) -> Iterable[bytes]:
    """Blocks of ``block`` ids, the last one shorter; ``pieces`` are the documents that ``ids`` come from."""
    begins = np.cumsum(pieces["ids"], dtype=np.int64) - pieces["ids"]
    cuts = range(0, len(ids), block)
    coded = mixing.encode_blocks([ids[c : c + block] for c in cuts])
    for low, payload in zip(cuts, coded):
        high = min(low + block, len(ids))
        a, b = np.searchsorted(begins, low, "right") - 1, np.searchsorted(begins, high, "left")
        own = pieces[a:b].copy()
        lows, highs = begins[a:b], begins[a:b] + pieces["ids"][a:b]
        own["flags"] &= np.where(lows < low, 255 - _BEGINS, 255).astype(np.uint8)
        own["flags"] &= np.where(highs > high, 255 - _ENDS, 255).astype(np.uint8)
        own["ids"] = np.minimum(highs, high) - np.maximum(lows, low)
        body = own.tobytes() + payload
        yield struct.pack(_BLOCK, b"BLK1", high - low, len(own), len(payload), _crc(high - low, len(own), len(payload), body)) + body


def unpack_blocks(blocks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Pieces and ids of blocks, in their order."""
    pieces, payloads, sizes = [], [], []
    for data in blocks:
        if len(data) < _BLOCK_SIZE:
            raise CorruptFile("block is cut short")
        mark, n, many, length, crc = struct.unpack_from(_BLOCK, data)
        body = data[_BLOCK_SIZE :]
        if mark != b"BLK1" or len(body) != many * _PIECE.itemsize + length or _crc(n, many, length, body) != crc:
            raise CorruptFile("block does not match its checksum")
        pieces.append(np.frombuffer(body, _PIECE, many))
        payloads.append(body[many * _PIECE.itemsize :])
        sizes.append(n)
    ids = mixing.decode_blocks(payloads, sizes)
    empty = np.empty(0, np.uint16)
    return np.concatenate([np.empty(0, _PIECE), *pieces]), np.concatenate([empty, *ids])


class Writer:
    """One file; documents are added in order."""

    def __init__(self, out, block: int = BLOCK, lanes: int = LANES, end_id: int = END_ID):
        self.out, self.block, self.full = out, block, block * lanes
        self.docs, self.parts, self.waiting = [], [], 0
        self.offsets, self.n_ids, self.n_docs = [], 0, 0
        self.at = out.write(struct.pack(_HEAD, b"DKIDS1\0\0", block, end_id))
        self.end = struct.pack("<H", end_id)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """``ids`` without the end id, which is put behind them."""
        own = ids + self.end
        self.docs.append((doc_id or 0, len(own) // 2, _BEGINS | _ENDS | _NULL * (doc_id is None)))
        self.parts.append(own)
        self.waiting += len(own) // 2
        if self.waiting >= self.full:
            self._write(self.waiting // self.block * self.block)

    def _write(self, upto: int) -> None:
        pieces, ids = np.array(self.docs, _PIECE), np.frombuffer(b"".join(self.parts), "<u2")
        self.docs, self.parts, self.waiting = [], [], 0
        low = np.cumsum(pieces["ids"], dtype=np.int64)
        n = int(np.searchsorted(low, upto))
        whole = pieces[: n + 1].copy()
        rest = int(low[n]) - upto if len(low) else 0
        if rest:  # the last document goes on in the next block
            whole["ids"][n] -= rest
            whole["flags"][n] &= 255 - _ENDS
            self.docs.append((int(pieces["doc"][n]), rest, int(pieces["flags"][n]) & (255 - _BEGINS)))
        self.docs += pieces[n + 1 :].tolist()
        if upto < len(ids):
            self.parts.append(ids[upto:].tobytes())
            self.waiting = len(ids) - upto
        for data in pack_blocks(whole, ids[:upto], self.block):
            self.offsets.append(self.at)
            self.at += self.out.write(data)
        self.n_ids += upto
        self.n_docs += int((whole["flags"] & _ENDS > 0).sum())

    def close(self) -> None:
        if self.waiting:
            self._write(self.waiting)
        places = np.array(self.offsets, "<u8").tobytes()
        crc = zlib.crc32(places + struct.pack("<QQQ", len(self.offsets), self.n_ids, self.n_docs))
        self.at += self.out.write(places + struct.pack(_FOOT, len(self.offsets), self.n_ids, self.n_docs, crc, b"DKEND1\0\0"))
        self.out.close()


def read_file(source, size: int, lanes: int = LANES) -> Iterator[tuple[int | None, np.ndarray]]:
    """Each document of a file with its ids, the end id included; holds ``lanes`` blocks at a time."""
    def piece(low: int, high: int) -> bytes:
        source.seek(low)
        return source.read(high - low)

    if size < _HEAD_SIZE + _FOOT_SIZE or piece(0, _HEAD_SIZE)[:6] != b"DKIDS1":
        raise CorruptFile("no file of ids")
    n, n_ids, n_docs, crc, mark = struct.unpack(_FOOT, piece(size - _FOOT_SIZE, size))
    bottom = size - _FOOT_SIZE - 8 * n
    places = piece(bottom, size - _FOOT_SIZE) if mark == b"DKEND1\0\0" and bottom >= _HEAD_SIZE else b""
    if not mark.startswith(b"DKEND1") or zlib.crc32(places + struct.pack("<QQQ", n, n_ids, n_docs)) != crc:
        raise CorruptFile("footer does not match its checksum")
    edges = [*np.frombuffer(places, "<u8").tolist(), bottom]
    open_parts: list[np.ndarray] = []
    for first in range(0, n, lanes):
        upto = min(first + lanes, n)
        data = piece(edges[first], edges[upto])
        blocks = [data[a - edges[first] : b - edges[first]] for a, b in zip(edges[first:upto], edges[first + 1 :])]
        pieces, ids = unpack_blocks(blocks)
        low = 0
        for doc, many, flags in pieces.tolist():
            open_parts.append(ids[low : low + many])
            low += many
            if flags & _ENDS:
                yield (None if flags & _NULL else doc), np.concatenate(open_parts)
                open_parts = []


def _write_part(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, block: int, lanes: int) -> Iterator[pa.RecordBatch]:
    encode = words.byte_words(tokenizer).encode_all
    context = TaskContext.get()
    writer = None
    store, root = _open(folder)
    name = f"{root}/part-{context.partitionId():06d}"
    for batch in batches:
        if batch.num_rows and writer is None:
            store.create_dir(root, recursive=True)
            writer = Writer(store.open_output_stream(f"{name}.{context.taskAttemptId()}.tmp"), block, lanes)
        for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1))):
            writer.add(doc_id, ids)
    if writer is not None:
        writer.close()
        store.move(f"{name}.{context.taskAttemptId()}.tmp", f"{name}.ids")
        row = {"part": context.partitionId(), "path": f"{folder}/part-{context.partitionId():06d}.ids", "n_docs": writer.n_docs, "n_ids": writer.n_ids, "n_blocks": len(writer.offsets), "n_bytes": writer.at}
        yield pa.RecordBatch.from_pylist([row], pa.schema([("part", pa.int32()), ("path", pa.string()), *((c, pa.int64()) for c in ("n_docs", "n_ids", "n_blocks", "n_bytes"))]))


def write_ids(
    docs: DataFrame, folder: str | None = None, doc_id: str = "doc_id", text: str = "text",
    tokenizer: str = words.BYTE_BPE, block: int = BLOCK, lanes: int = LANES,
) -> DataFrame:
    """Write the ids of all documents in order of ``doc_id``; one row ``(part, path, n_docs, n_ids, n_blocks, n_bytes)`` per file.

    Every document ends with ``END_ID``; a null text is an empty one. Null ids come first; rows that
    repeat an id are documents of their own, in order of their texts. Strings of special tokens in a
    text become these tokens, as is the library's habit. Files go to ``folder``, or to a new one in
    the shared scratch folder. An empty table gives no file. Other columns are not carried.
    """
    folder = (folder or new_folder(docs.sparkSession, "ids")).rstrip("/")
    base = documents(docs, doc_id, text).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # many rows with one id are spread by their texts
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text").asc_nulls_first()]
    ordered = base.repartitionByRange(*keys[:2]).sortWithinPartitions(*keys)
    made = partial(_write_part, folder=folder, tokenizer=tokenizer, block=block, lanes=lanes)
    return checkpointed(arrow_map(ordered, made, "part int, path string, n_docs long, n_ids long, n_blocks long, n_bytes long"))


def _read_parts(batches: Iterator[pa.RecordBatch], lanes: int) -> Iterator[pa.RecordBatch]:
    names, kinds = ["doc_id", "start", "n_tokens", "ids"], [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    for batch in batches:
        for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            store, at = _open(path)
            rows, held = [], 0
            with store.open_input_file(at) as source:
                for doc_id, ids in read_file(source, source.size(), lanes):
                    rows.append((doc_id, start, len(ids), ids.astype("<u4").tobytes()))
                    start += len(ids)
                    held += 4 * len(ids)
                    if held >= _BATCH:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
                        rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def read_ids(files: DataFrame, lanes: int = LANES) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` for every document in ``files(part, path, n_ids)``.

    ``start`` counts the ids of all documents before it, over all files in order of ``part``; ``ids``
    are its ids as little-endian 32-bit numbers. Each file is read by one task.
    """
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # one row per file: few enough for one task
    placed = files.select("path", (F.sum("n_ids").over(upto) - F.col("n_ids")).alias("start"))
    dealt = placed.repartition(max(1, files.count()))
    return arrow_map(dealt, partial(_read_parts, lanes=lanes), "doc_id long, start long, n_tokens long, ids binary")
