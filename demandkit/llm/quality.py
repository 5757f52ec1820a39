"""Quality rules: word and line counts, and bands of zstandard compression ratios.

Text that repeats itself compresses too well, text without language in it (keys, encoded binary)
compresses too little. What is usual depends on the length, as a short text has nothing to refer
back to; so every length class has a lowest and a highest ratio of its own. The ratio of the whole
text must lie in its band, and so must those of nearly all fixed chunks, which finds a repetitive
or incompressible part inside a long text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from demandkit.llm.common import arrow_map, documents, texts

#: (UTF-8 bytes from which the band holds, lowest ratio, highest ratio)
BANDS = ((0, 0.0, 3.0), (128, 0.9, 3.0), (512, 1.2, 3.0), (2048, 1.4, 3.5), (16384, 1.5, 5.0))
CHUNK_BYTES = 4096
#: The part of a text, by bytes, that may lie in chunks outside their bands.
MAX_OUTSIDE = 0.2
LEVEL = 3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_NOT_COUNTED = _SPACE + bytes(range(0x80, 0xC0))  # white space, and all but the first byte of a code point
_WIDE = 1 << 21


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    if len(words) < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    pairs, size = ids[:-1] * len(known) + ids[1:], len(known)
    if size >= _WIDE:  # three numbers no longer fit into one
        pairs = np.unique(pairs, return_inverse=True)[1].reshape(-1)
    _, at, counts = np.unique(pairs[:-1] * size + ids[2:], return_inverse=True, return_counts=True)
    twice = counts[at.reshape(-1)] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(twice)] |= twice
    return int(covered.sum())


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` of one text."""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip(_SPACE)]
    symbols = len(text) - len(text.translate(None, _SYMBOLS))
    return len(words), len(text.translate(None, _NOT_COUNTED)), symbols, len(lines) - len(set(lines)), repeated_words(words)


def in_band(size: int, ratio: float, bands: tuple = BANDS) -> bool:
    _, low, high = [b for b in bands if b[0] <= size][-1]
    return low <= ratio <= high


def compression(text: bytes, packer: zstandard.ZstdCompressor, bands: tuple, chunk: int) -> tuple[float, float]:
    """Ratio of the whole text, and the part of its bytes in chunks that lie outside their bands."""
    if not text:
        return 0.0, 0.0
    outside = 0
    for at in range(0, len(text), chunk):
        part = text[at : at + chunk]
        outside += 0 if in_band(len(part), len(part) / len(packer.compress(part)), bands) else len(part)
    return len(text) / len(packer.compress(text)), outside / len(text)


_COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, ratio double, outside double, kept boolean"
)


def _judge(
    batches: Iterator[pa.RecordBatch], bands: tuple, chunk: int, max_outside: float, level: int
) -> Iterator[pa.RecordBatch]:
    packer = zstandard.ZstdCompressor(level=level, write_checksum=False, write_content_size=False)
    names = ["doc_id", *[c.split()[0] for c in _COLUMNS.split(", ")]]
    for batch in batches:
        rows = []
        for text in texts(batch.column(1)):
            counts = base_counts(text)
            failed = counts[0] < MIN_WORDS or 100 * counts[4] > MAX_REPEAT_PERCENT * counts[0]
            ratio, outside = compression(text, packer, bands, chunk)
            good = in_band(len(text), ratio, bands) and outside <= max_outside
            rows.append((*counts, failed, ratio, outside, good and not failed))
        made = [list(c) for c in zip(*rows)] if rows else [[]] * (len(names) - 1)
        kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]
        arrays = [pa.array(c, k) for c, k in zip(made, kinds)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names)


def judge_quality(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    bands: tuple = BANDS,
    chunk: int = CHUNK_BYTES,
    max_outside: float = MAX_OUTSIDE,
    level: int = LEVEL,
) -> DataFrame:
    """``doc_id``, the counts, the compression figures and ``kept``, one row for each row of ``docs``.

    ``base_failed``: fewer than 50 words, or more than half of them in repeated windows. ``kept``:
    not ``base_failed``, the whole ratio in its band, and at most ``max_outside`` of the bytes in
    chunks outside theirs. A null text counts as empty, has ratio 0 and fails; null ids and repeated
    rows are judged like others; other columns are not carried. A text is held whole by one task,
    with nothing larger than its own list of words.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    judge = partial(_judge, bands=bands, chunk=chunk, max_outside=max_outside, level=level)
    return arrow_map(documents(docs, doc_id, text), judge, f"doc_id {kind}, {_COLUMNS}")
