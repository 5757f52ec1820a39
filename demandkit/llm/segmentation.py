"""SentencePiece encoding by sampling without replacement, and decoding, as Spark jobs."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from xxhash import xxh64_intdigest

from demandkit.llm.common import arrow_map, documents
from demandkit.llm.lattice import Vocabulary, segment

#: Where the vocabulary files of public tokenizers are, by default.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
SEED = 13
_BATCH_CHARS = 1_000_000
_NAMES = ["doc_id", "nth", "ids", "n_ids", "log_prob", "perturbed", "log_inclusion", "round_trip"]


def row_seed(key: object, seed: int) -> int:
    return xxh64_intdigest(f"{seed}:{key}".encode(), seed=seed)


def _encode_batches(batches: Iterator[pa.RecordBatch], v: Vocabulary, k: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
        low = 0
        while low < len(texts):
            high, chars = low, 0
            while high < len(texts) and (chars == 0 or chars + len(texts[high]) <= _BATCH_CHARS):
                chars, high = chars + len(texts[high]), high + 1
            found = segment(v, texts[low:high], [row_seed(x, seed) for x in keys[low:high]], k)
            rows = [(i, n, s) for i, x in enumerate(found, low) for n, s in enumerate(x)]
            sizes = np.array([len(s.ids) for *_, s in rows], np.int32)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            flat = np.concatenate([s.ids for *_, s in rows]).astype(np.int32)
            same = [v.decode(s.ids.tolist()) == texts[i] for i, _, s in rows]
            columns = [
                batch.column(0).take(pa.array([i for i, *_ in rows])),
                pa.array([n for _, n, _ in rows], pa.int32()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                pa.array(sizes),
                *[pa.array([getattr(s, x) for *_, s in rows], pa.float64()) for x in ("log_p", "perturbed", "log_inclusion")],
                pa.array(same),
            ]
            yield pa.RecordBatch.from_arrays(columns, _NAMES)
            low = high


def sample_segmentations(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: str = MODEL, samples: int = SAMPLES, seed: int = SEED
) -> DataFrame:
    """``(doc_id, nth, ids, n_ids, log_prob, perturbed, log_inclusion, round_trip)``: a row per sample.

    Up to ``samples`` distinct segmentations of every text, drawn without replacement in proportion
    to the product of their pieces' probabilities, in the order of their perturbed log probability;
    a text with fewer segmentations gives all of them. ``log_inclusion`` is the log probability that
    a segmentation of this probability is among the samples, given the first value outside them.
    ``round_trip`` says that the pieces decode to the text. The draws depend on ``seed`` and the id
    alone, so that rows of one id and text have the same samples. A null or empty text has one
    sample without pieces. A text is segmented whole, which takes some 60 bytes a code point.

    ``model`` is read on the driver; its pieces, some tens of thousands, go to the tasks.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, nth int, ids array<int>, n_ids int, log_prob double, perturbed double, log_inclusion double, round_trip boolean"
    v = Vocabulary.load(model)
    return arrow_map(documents(docs, doc_id, text), partial(_encode_batches, v=v, k=samples, seed=seed), schema)


def _decode_batches(batches: Iterator[pa.RecordBatch], at: int, v: Vocabulary) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [None if ids is None else v.decode(ids) for ids in batch.column(at).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], [*batch.schema.names, "decoded"])


def decode_segmentations(rows: DataFrame, ids: str = "ids", model: str = MODEL) -> DataFrame:
    """``rows`` with the text of each list of pieces as ``decoded``; a null list gives null.

    An input column named ``decoded`` is replaced.
    """
    kept = rows.drop(*[c for c in rows.columns if c.lower() == "decoded"])
    schema = kept.select("*", F.lit("").alias("decoded")).schema
    return arrow_map(kept, partial(_decode_batches, at=kept.columns.index(ids), v=Vocabulary.load(model)), schema)
