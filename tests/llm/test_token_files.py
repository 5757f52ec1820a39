"""Token files: coder, file format and query against the library itself."""

from __future__ import annotations

import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models, pre_tokenizers

from demandkit.llm import mixing, queries, token_files as tf, words

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(words.BYTE_BPE)


def plain(library, rows):
    out, start = [], 0
    for doc_id, text in sorted(rows):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 65535), max_size=40), max_size=6), st.integers(0, 3))
def test_blocks_come_back(blocks, few):
    own = [np.array([i % 3 if few else i for i in b], np.uint16) for b in blocks]
    coded = mixing.encode_blocks(own)
    assert [b.tolist() for b in mixing.decode_blocks(coded, [len(b) for b in own])] == [b.tolist() for b in own]


@pytest.mark.parametrize("kind", ["same", "uniform", "pairs", "rare", "high"])
def test_long_blocks_come_back_and_regular_ones_shrink(kind):
    rnd = np.random.default_rng(5)
    n = 6000
    made = {
        "same": np.full(n, 50256), "uniform": rnd.integers(0, 65536, n), "pairs": np.tile(rnd.integers(0, 50000, 50), n // 50),
        "rare": np.where(rnd.random(n) < 0.999, 7, rnd.integers(0, 65536, n)), "high": 65535 - rnd.geometric(0.01, n) % 65535,
    }[kind].astype(np.uint16)
    blocks = [made, made[:1], made[:4097], made[: n // 2]]
    coded = mixing.encode_blocks(blocks)
    assert all((a == b).all() for a, b in zip(mixing.decode_blocks(coded, [len(b) for b in blocks]), blocks))
    assert coded[3] == mixing.encode_blocks([blocks[3]])[0]  # a block does not depend on its neighbours
    bits = 8 * len(coded[0]) / n
    assert bits < {"same": 0.2, "uniform": 17.5, "pairs": 1.5, "rare": 0.6, "high": 12}[kind]


def test_carries_reach_back():
    """Some of many random blocks carry into words that are all ones."""
    rnd = np.random.default_rng(6)
    blocks = [rnd.integers(0, 65536, 150).astype(np.uint16) for _ in range(3000)]
    back = mixing.decode_blocks(mixing.encode_blocks(blocks), [150] * 3000)
    assert all((a == b).all() for a, b in zip(blocks, back))


def test_words_equal_the_library(library):
    rnd = random.Random(7)
    bits = ["a", "Bee", "don't", "'s", " ", " ", " ", "  ", "   ", "\n", "\r\n", "\t", " ", "　", "᠎", "\x1c", "\x85", "é", "語", "12", "!?", "<|endoftext|>", "<|", "\x00", "▁", "🙂"]
    ours, plain_ones = words.ByteWords(words.BYTE_BPE), words.ByteWords(words.BYTE_BPE, True)
    other = Tokenizer.from_file(words.BYTE_BPE)
    other.encode_special_tokens = True
    for _ in range(3000):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 14)))
        assert np.frombuffer(ours.encode(text), "<u2").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
        assert np.frombuffer(plain_ones.encode(text), "<u2").tolist() == other.encode(text, add_special_tokens=False).ids, repr(text)


def test_words_are_learned_many_at_a_time(library, monkeypatch):
    """Texts at once equal the library, with few calls of it, also where what was learned is forgotten."""
    rnd = random.Random(8)
    bits = ["a", "Bee", "don't", "'s", " ", " ", " ", "  ", "\n", " \n", "\t", "\u3000", "\x1c", "\x85", "é", "ɏ", "ɐ", "語", "12", "²", "!?", "<|endoftext|>", "\x00", "🙂"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 14))) for _ in range(3000)]
    texts += [None, "", " ", *(" ".join("".join(rnd.choices("aeinrstu.,", k=9)) for _ in range(200)) for _ in range(100))]
    other = Tokenizer.from_file(words.BYTE_BPE)
    other.encode_special_tokens = True
    for plain_specials, own in ((False, library), (True, other)):
        ours, calls = words.ByteWords(words.BYTE_BPE, plain_specials), []
        asked = ours._library
        ours._library = lambda texts, by=None: calls.append(len(texts)) or asked(texts, by)
        right = [own.encode(t or "", add_special_tokens=False).ids for t in texts]
        got = ours.encode_all(pa.array(texts))
        assert [np.frombuffer(ids, "<u2").tolist() for ids in got] == right
        assert len(calls) <= 3 and len(ours.words) > 15000  # first words of texts, new pieces, words that are not Latin
        monkeypatch.setattr(words, "_AT_ONCE", 5000)
        monkeypatch.setattr(words, "MAX_WORDS", 1000)
        monkeypatch.setattr(words, "MAX_PIECES", 700)
        assert [np.frombuffer(ids, "<u2").tolist() for ids in ours.encode_all(pa.array(texts))] == right
        assert len(ours.words) < 15000
        monkeypatch.undo()
    assert words.byte_words(words.BYTE_BPE) is words.byte_words(words.BYTE_BPE)


def test_words_of_a_vocabulary_without_all_bytes(tmp_path):
    """Its missing bytes give no ids."""
    own = Tokenizer(models.BPE({"Ġ": 0, "a": 1, "b": 2, "Ġa": 3}, [("Ġ", "a")]))
    own.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    own.save(path := str(tmp_path / "few.json"))
    texts = ["a ab xa. abba", "x", " é b a", "bxb xxx ba"]
    got = words.ByteWords(path).encode_all(pa.array(texts))
    assert [np.frombuffer(ids, "<u2").tolist() for ids in got] == [own.encode(t, add_special_tokens=False).ids for t in texts]


def written(docs, block, lanes):
    out = io.BytesIO()
    out.close_ = out.close
    out.close = lambda: None
    writer = tf.Writer(out, block, lanes)
    for doc_id, ids in docs:
        writer.add(doc_id, np.array(ids, "<u2").tobytes())
    writer.close()
    return out.getvalue()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.none() | st.integers(-5, 1 << 40), st.lists(st.integers(0, 50000), max_size=30)), max_size=12), st.integers(1, 9), st.integers(1, 3))
def test_files_come_back(docs, block, lanes):
    data = written(docs, block, lanes)
    got = [(d, ids.tolist()) for d, ids in tf.read_file(io.BytesIO(data), len(data), lanes + 1)]
    assert got == [(d, [*ids, 2]) for d, ids in docs]


def test_damage_is_seen():
    data = bytearray(written([(i, range(50)) for i in range(20)], 64, 4))
    for at in range(8, len(data) - 8, 7):
        if 8 <= at < 16:
            continue  # what the header says of block size and end id is for the reader of the file
        bad = bytearray(data)
        bad[at] ^= 4
        with pytest.raises(tf.CorruptFile):
            list(tf.read_file(io.BytesIO(bytes(bad)), len(bad)))
    with pytest.raises(tf.CorruptFile):
        list(tf.read_file(io.BytesIO(bytes(data[:-9])), len(data) - 9))


def test_query_equals_the_library(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = sorted(map(tuple, queries.QUERIES["op11_token_files"](spark, sf_dir).collect()))
    assert got == plain(library, [(r.doc_id, r.text) for r in docs.collect()])


def test_odd_tables(spark, library):
    assert tf.read_ids(tf.write_ids(spark.createDataFrame([], SCHEMA))).count() == 0
    long = "many words " * 40000
    rows = [(None, "x"), (5, None), (3, ""), (5, "repeated"), (5, "repeated"), (-2, long), (9, "a <|endoftext|> b")]
    odd = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("ids", "part", "path", "start", "n_ids")})
    got = tf.read_ids(tf.write_ids(odd.repartition(3), block=64, lanes=8)).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, -2, 3, 5, 5, 5, 9]
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:n]) for n in range(len(got))]
    texts = {tuple(np.frombuffer(r.ids, "<u4").tolist()) for r in got}
    assert texts == {(*library.encode(t or "", add_special_tokens=False).ids, 2) for _, t in rows}
