from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandkit.llm import gru, toxicity

SCHEMA = "doc_id long, text string"


def test_gradients_equal_finite_differences():
    rng = np.random.default_rng(14)
    p = gru.new_params(rng, 6, np.float64)
    p["chars"] *= 10
    words = ["a", "bcd", "naïve", "words", "x", "longer"]
    buckets, starts = gru.ngram_buckets(words)
    known = np.array([0, 1, 2, 3, 0, 5])
    ids = rng.integers(0, 6, (4, 7))
    mask = (np.arange(7) < np.array([[7], [1], [4], [6]])).astype(float)
    y, weight = np.array([1.0, 0, 1, 0]), np.array([1.0, 2, 0.5, 1])
    _, g = gru.gradients(p, known, buckets, starts, ids, mask, y, weight)
    for name, values in p.items():
        flat = values.reshape(-1)
        spots = np.flatnonzero(np.abs(g[name].reshape(-1)) > 1e-9)
        assert len(spots)
        for at in rng.choice(spots, min(6, len(spots)), replace=False):
            kept, change = flat[at], 1e-6
            flat[at] = kept + change
            up = gru.gradients(p, known, buckets, starts, ids, mask, y, weight)[0]
            flat[at] = kept - change
            down = gru.gradients(p, known, buckets, starts, ids, mask, y, weight)[0]
            flat[at] = kept
            assert abs((up - down) / (2 * change) - g[name].reshape(-1)[at]) < 1e-6, name


def test_padding_and_company_change_nothing():
    rng = np.random.default_rng(15)
    p = gru.new_params(rng, 1, np.float64)
    texts = [" ".join(f"w{rng.integers(30)}" for _ in range(n)) for n in (1, 5, 32, 33, 100)]
    together = toxicity.cut(texts, {})
    logits = toxicity.window_logits(p, together)
    assert np.bincount(together.doc).tolist() == [1, 1, 1, 2, 6]
    for i, text in enumerate(texts):
        alone = toxicity.window_logits(p, toxicity.cut([text], {}))
        assert np.allclose(alone, logits[together.doc == i])


def test_buckets_of_words_do_not_depend_on_neighbours():
    words = ["abc", "", "é", "abcabcabc", "日本語"]
    buckets, starts = gru.ngram_buckets(words)
    parts = np.split(buckets, starts[1:])
    for word, part in zip(words, parts):
        if word:
            assert sorted(gru.ngram_buckets([word])[0]) == sorted(part)


@pytest.fixture(scope="module")
def model():
    rnd = random.Random(16)
    texts, labels = made_texts(rnd, 600)
    return toxicity.train(texts, labels)


def made_texts(rnd, n):
    word = lambda: "".join(rnd.choice("abcdefghijkl") for _ in range(rnd.randint(1, 7)))
    texts, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rnd.choice([5, 40, 300]))]
        if i % 3 == 0:
            for _ in range(3):
                words.insert(rnd.randint(0, len(words)), rnd.choice(["Idiot", "zzqu" + word()]) + rnd.choice([",", "", "!"]))
        texts.append(" ".join(words))
        labels.append(int(i % 3 == 0))
    return texts, labels


def test_held_out_accuracy_by_words_and_by_spelling(model):
    texts, labels = made_texts(random.Random(17), 300)
    found, _ = toxicity.scores(model, texts)
    assert ((found >= 0.7) == np.array(labels)).mean() > 0.95


def test_long_text_in_pieces_has_the_same_windows(model, monkeypatch):
    texts = [t for t, _ in zip(made_texts(random.Random(18), 60)[0], range(60))]
    whole = toxicity.scores(model, texts)
    monkeypatch.setattr(toxicity, "_BATCH_CHARS", 50)
    monkeypatch.setattr(toxicity, "_PIECE_WORDS", 32)
    pieces = toxicity.scores(model, texts)
    assert np.allclose(whole[0], pieces[0], atol=1e-5) and whole[1].tolist() == pieces[1].tolist()


def test_training_never_sees_held_out_labels(spark):
    texts, labels = made_texts(random.Random(19), 90)
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    rows = [(i, y if zlib.crc32(str(i).encode()) % 3 != 1 else 1 - y) for i, y in enumerate(labels)]
    flipped = spark.createDataFrame(rows, "doc_id long, toxic int")
    honest = spark.createDataFrame(list(enumerate(labels)), "doc_id long, toxic int")
    a, b = (toxicity.train_on(docs, x) for x in (flipped, honest))
    assert all(np.array_equal(a.params[k], b.params[k]) for k in a.params) and (a.scale, a.shift) == (b.scale, b.shift)


def test_the_sample_has_one_row_per_id_and_is_bounded_by_characters(spark):
    texts, labels = made_texts(random.Random(20), 90)
    rows = list(enumerate(texts)) + [(3, f"repeated {n}") for n in range(10_000)] + [(6, "x" * 100_000), (9, None), (None, "y")]
    docs = spark.createDataFrame(rows, SCHEMA)
    marked = spark.createDataFrame([*enumerate(labels), (3, 0), (None, 1)], "doc_id long, toxic int")
    found = toxicity.training_rows(docs, marked)
    allowed = [i for i in range(90) if zlib.crc32(str(i).encode()) % 3 != 1]
    assert [i for i, *_ in found] == allowed
    assert {i: t for i, t, _ in found}[allowed[0]] == texts[allowed[0]]
    few = toxicity.training_rows(docs, marked, toxic=20, clean=40, chars=9000)
    for label, most in ((1, 20), (0, 40)):
        own = [t for _, t, y in few if y == label]
        assert 0 < len(own) <= most and sum(map(len, own)) <= 9000 * most / 60


def test_odd_tables(spark, model):
    rows = [(None, None), (1, ""), (1, ""), (2, " ... "), (3, "x" * 300_000)]
    odd = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("score", "toxic", "lang", "_id")})
    got = {str(r.doc_id): r for r in toxicity.score_documents(odd, model).collect()}
    assert all(0 <= r.score <= 1 for r in got.values())
    assert [got[k].n_windows for k in ("None", "1", "2", "3")] == [0, 0, 0, 1] and got["None"].score < 0.01
    assert toxicity.score_documents(odd.limit(0), model).count() == 0
    kept = toxicity.drop_toxic(odd, model)
    assert kept.columns == odd.columns and kept.count() >= 4
    no_labels = spark.createDataFrame([], "doc_id long, toxic int")
    untrained = toxicity.train_on(odd, no_labels)
    assert toxicity.score_documents(odd, untrained).count() == 5
