"""Toxicity of documents: a recurrent network scores all overlapping windows of words.

A label says that a document is toxic, not where. Training therefore goes in rounds: the windows of
the sampled documents are scored, each toxic document gives its worst window as an example, each
clean one its worst windows and a drawn one as counterexamples. A document's score is the calibrated
score of its worst window.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from demandkit.llm import gru
from demandkit.llm.common import arrow_map, checkpointed, documents, hash_sample

WINDOW = 32
STRIDE = 16
#: Labelled documents the model is fitted on, at most, of each class.
TRAIN_TOXIC = 1500
TRAIN_CLEAN = 3000
ROUNDS = 3
EPOCHS = 3
THRESHOLD = 0.7
SEED = 11
#: Characters of the sample, shared between the classes as their documents are.
TRAIN_CHARS = 48_000_000
STEPS = 90  # per round, at least
#: Part of the words whose own vector is hidden in a step.
HIDE_WORDS = 0.3
_WORD = re.compile(r"\w+")
_BATCH_CHARS = 1 << 19
_STEP_WINDOWS = 2048
_PIECE_WORDS = 1 << 17


@dataclass
class ToxicityModel:
    params: gru.Params
    vocabulary: dict[str, int]
    scale: float = 1.0
    shift: float = 0.0


@dataclass
class Windows:
    """Windows of several documents; ``doc`` is the document of each window."""

    known: np.ndarray
    buckets: np.ndarray
    starts: np.ndarray
    ids: np.ndarray
    mask: np.ndarray
    doc: np.ndarray


def held_out(doc_id: Column) -> Column:
    """Rows whose labels training never sees; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def cut(texts: Sequence[str], vocabulary: dict[str, int], window: int = WINDOW, stride: int = STRIDE) -> Windows:
    """All windows of all texts: one every ``stride`` words until the last word is covered; no words, no window."""
    own: dict[str, int] = {}
    flat: list[int] = []
    sizes = np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        words = _WORD.findall(text.lower())
        sizes[i] = len(words)
        flat += [own.setdefault(w, len(own)) for w in words]
    tokens = np.array(flat + [0], np.int32)
    counts = np.where(sizes > 0, 1 + np.maximum(0, -(-(sizes - window) // stride)), 0)
    doc = np.repeat(np.arange(len(texts)), counts)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = (nth * stride)[:, None] + np.arange(window)
    inside = at < sizes[doc][:, None]
    begins = np.cumsum(sizes) - sizes
    ids = tokens[np.where(inside, begins[doc][:, None] + at, len(flat))]
    words = list(own)
    buckets, starts = gru.ngram_buckets(words) if words else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    known = np.array([vocabulary.get(w, 0) for w in words], np.int64)
    return Windows(known, buckets, starts, ids, inside.astype(np.float32), doc)


def window_logits(p: gru.Params, w: Windows) -> np.ndarray:
    if not len(w.ids):
        return np.zeros(0, np.float32)
    rows = gru.inputs(p, w.known, w.buckets, w.starts)
    parts = [slice(i, i + _STEP_WINDOWS) for i in range(0, len(w.ids), _STEP_WINDOWS)]
    return np.concatenate([gru.forward(p, rows, w.ids[s], w.mask[s])[0] for s in parts])


def _worst(logits: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """The largest logit of each document; -inf where it has no window."""
    worst = np.full(docs, -np.inf)
    np.maximum.at(worst, doc, logits)
    return worst


def _log_odds(present: np.ndarray, toxic: int, clean: int) -> np.ndarray:
    """Smoothed log odds of a feature in toxic against clean documents; ``present`` has the two counts."""
    odds = np.log((present[0] + 0.5) / (toxic + 1)) - np.log((present[1] + 0.5) / (clean + 1))
    return np.clip(odds, -4, 4)


def _first_vectors(p: gru.Params, w: Windows, doc_y: np.ndarray) -> None:
    """Start each word and n-gram vector at how much more often toxic documents have it."""
    parts = np.array_split(np.arange(len(w.doc)), 16)  # windows of one document may lie in two parts
    pairs = [np.unique((w.doc[x, None] * len(w.known) + w.ids[x])[w.mask[x] > 0]) for x in parts]
    pairs = np.unique(np.concatenate(pairs))
    doc, word = pairs // len(w.known), pairs % len(w.known)
    counts = [(doc_y == y).sum() for y in (1, 0)]
    present = np.stack([np.bincount(word[doc_y[doc] == y], minlength=len(w.known)) for y in (1, 0)])
    odds = _log_odds(present, *counts)
    seen = w.known > 0
    p["words"][w.known[seen], 0] = 0.5 * odds[seen]
    p["words"][0] = 0
    sizes = np.diff(np.append(w.starts, len(w.buckets)))
    of = np.repeat(np.arange(len(w.known)), sizes)
    # documents with an n-gram: at most the sum over its words, which is close for rare ones
    grams = np.stack([np.bincount(w.buckets, present[i][of], gru.CHAR_BUCKETS) for i in (0, 1)])
    p["chars"][:, 0] = 0.5 * _log_odds(np.minimum(grams, np.array(counts)[:, None]), *counts)


def _fit(texts: Sequence[str], y: np.ndarray, rounds: int, epochs: int, rng: np.random.Generator) -> tuple[gru.Params, dict[str, int], np.ndarray]:
    """A network, its vocabulary, and the worst logit of every document."""
    held: dict[str, int] = {}
    for text in texts:
        for word in set(_WORD.findall(text.lower())):
            held[word] = held.get(word, 0) + 1
    vocabulary = {w: i for i, w in enumerate(sorted(w for w, n in held.items() if n >= 5), 1)}
    p = gru.new_params(rng, len(vocabulary) + 1)
    w = cut(texts, vocabulary)
    if not {0, 1} <= set(y.tolist()):
        return p, vocabulary, np.full(len(texts), -np.inf)
    _first_vectors(p, w, y)
    rows = gru.inputs(p, w.known, w.buckets, w.starts)
    # before the first round a window is as bad as its worst word
    logits = np.where(w.mask > 0, (rows[:, 0] + rows[:, gru.WORD_DIM])[w.ids], np.float32(-9)).max(axis=1)
    del rows
    adam = gru.Adam(p, 0.01)
    for _ in range(rounds):
        order = np.lexsort((-logits, w.doc))
        place = np.arange(len(order)) - np.searchsorted(w.doc[order], w.doc[order])
        drawn = rng.random(len(order)) < len(texts) / max(1, len(order))
        clean = y[w.doc[order]] == 0
        chosen = order[(place == 0) | clean & ((place < 3) | drawn)]
        target = y[w.doc[chosen]].astype(np.float32)
        weight = np.where(target > 0, 0.5 / max(1, target.sum()), 0.5 / max(1, (1 - target).sum())).astype(np.float32)
        weight *= len(target)
        for _ in range(max(epochs, -(-STEPS * 256 // len(chosen)))):
            mixed = rng.permutation(len(chosen))
            for low in range(0, len(mixed), 256):
                part = mixed[low : low + 256]
                some = chosen[part]
                used, ids = np.unique(w.ids[some], return_inverse=True)
                sizes = np.diff(np.append(w.starts, len(w.buckets)))[used]
                begins = np.cumsum(sizes) - sizes
                flat = np.repeat(w.starts[used] - begins, sizes) + np.arange(sizes.sum())
                known = np.where(rng.random(len(used)) < HIDE_WORDS, 0, w.known[used])
                _, g = gru.gradients(
                    p, known, w.buckets[flat], begins, ids.reshape(len(some), -1), w.mask[some], target[part], weight[part]
                )
                adam.step(p, g)
        logits = window_logits(p, w)
    return p, vocabulary, _worst(logits, w.doc, len(texts))


def train(texts: Sequence[str], labels: Sequence[int], rounds: int = ROUNDS, epochs: int = EPOCHS, seed: int = SEED) -> ToxicityModel:
    """Fit on whole texts with labels 0 and 1.

    The network learns from all of them, and what its logits mean is calibrated on the same documents.
    With one class only nothing is learned.
    """
    y = np.asarray(labels, np.int64)
    params, vocabulary, worst = _fit(texts, y, rounds, epochs, np.random.default_rng(seed))
    model = ToxicityModel(params, vocabulary)
    some = np.isfinite(worst)
    if {0, 1} <= set(y.tolist()) and some.any():
        model.scale, model.shift = calibrate(worst[some], y[some])
    return model


def calibrate(x: np.ndarray, y: np.ndarray, steps: int = 200) -> tuple[float, float]:
    """A logistic curve from worst window logits to document labels, by Newton steps with a small penalty."""
    beta = np.array([1.0, 0.0])
    a = np.stack([x, np.ones_like(x)], axis=1).astype(float)
    prior = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + 0.5 * np.eye(2)
        move = np.linalg.solve(h, a.T @ (y - p) - 0.5 * (beta - prior))
        beta = beta + np.clip(move, -1, 1)
        if np.abs(move).max() < 1e-6:
            break
    return float(beta[0]), float(beta[1])


def _pieces(text: str, words: int, window: int = WINDOW, stride: int = STRIDE) -> Iterator[str]:
    """A long text in parts that together have the windows of the whole; ``words`` is a multiple of ``stride``."""
    found, shared = (m[0] for m in _WORD.finditer(text.lower())), []
    while True:
        part = [*shared, *islice(found, words + window - stride - len(shared))]
        if len(part) <= len(shared):
            return
        yield " ".join(part)
        shared = part[words:]


def scores(model: ToxicityModel, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Score of each text and its number of windows; a text without words scores as clean as can be."""
    worst, windows = np.full(len(texts), -np.inf), np.zeros(len(texts), np.int64)

    def judge(rows: list[int], parts: list[str]) -> None:
        w = cut(parts, model.vocabulary)
        found = _worst(window_logits(model.params, w), w.doc, len(parts))
        np.maximum.at(worst, rows, found)
        np.add.at(windows, rows, np.bincount(w.doc, minlength=len(parts)))

    rows, parts, chars = [], [], 0
    for i, text in enumerate(texts):
        if len(text) > _BATCH_CHARS:
            for piece in _pieces(text, _PIECE_WORDS):
                judge([i], [piece])
            continue
        if chars + len(text) > _BATCH_CHARS:
            judge(rows, parts)
            rows, parts, chars = [], [], 0
        rows.append(i)
        parts.append(text)
        chars += len(text)
    if rows:
        judge(rows, parts)
    some = np.isfinite(worst)
    odds = np.where(some, model.scale * np.where(some, worst, 0) + model.shift, -30)
    return 1 / (1 + np.exp(-np.clip(odds, -30, 30))), windows


def _score_batches(batches: Iterator[pa.RecordBatch], model: ToxicityModel) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found, windows = scores(model, [t or "" for t in batch.column(1).to_pylist()])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found), pa.array(windows)], ["doc_id", "score", "n_windows"])


def training_rows(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
    toxic: int = TRAIN_TOXIC, clean: int = TRAIN_CLEAN, chars: int = TRAIN_CHARS,
) -> list[tuple[int, str, int]]:
    """``(id, text, label)`` of the sample, in order of ids.

    Ids that are not held out are taken by smallest hash, ``toxic`` and ``clean`` of them at most, and a
    text that would take its class beyond its part of ``chars`` is left out. Of rows with one id the
    smallest text counts, of several labels the largest; null ids, labels and texts count for nothing.
    Only these ids go to the documents, and only their lengths are looked at before the choice.
    """
    ids = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_y")).dropna().where(~held_out(F.col("_id")))
    ids = ids.groupBy("_id").agg(F.max("_y").alias("_y"))
    parts = [hash_sample(ids.where(F.col("_y") == y), ["_id"], n) for y, n in ((1, toxic), (0, clean))]
    chosen = parts[0].union(parts[1])
    # one row for each of some thousand ids
    some = documents(docs, doc_id, text).dropna().join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))
    some = checkpointed(some.groupBy("_id", "_y").agg(F.min("text").alias("text")))
    left = {1: chars * toxic // max(1, toxic + clean), 0: chars * clean // max(1, toxic + clean)}
    fits = []
    for r in some.select("_id", "_y", F.length("text").alias("n")).orderBy(F.xxhash64(F.lit(17), "_id"), "_id").collect():
        if r.n <= left[r._y]:
            left[r._y] -= r.n
            fits.append(r._id)
    return sorted((r._id, r.text, r._y) for r in some.where(F.col("_id").isin(fits)).collect()) if fits else []


def train_on(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", **bounds: int) -> ToxicityModel:
    """Fit on the driver, on ``training_rows``; without both classes every text scores as clean.

    An empty table, on either side, gives such a model too.
    """
    rows = training_rows(docs, labels, doc_id, text, label, **bounds)
    return train([t for _, t, _ in rows], [y for _, _, y in rows])


def score_documents(docs: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, score, n_windows)``, one row for each row of ``docs``.

    Null and empty texts, and texts without a word, have no window and a score of nearly 0. Null ids
    and repeated rows are scored like others; other columns are not carried. Whole texts are scored,
    a bounded number of characters or one text at a time.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    return arrow_map(documents(docs, doc_id, text), partial(_score_batches, model=model), f"doc_id {kind}, score double, n_windows long")


def drop_toxic(docs: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores below ``threshold``, with all their columns.

    Null and empty texts score as clean and stay. Rows that repeat an id, or have none, are judged each
    by its own text. An empty table stays empty.
    """
    at = docs.columns.index(text)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, _ = scores(model, [t or "" for t in batch.column(at).to_pylist()])
            yield batch.filter(pa.array(found < threshold))

    return arrow_map(docs, judge, docs.schema)
