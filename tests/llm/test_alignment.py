"""Alignment of two tokenizers against a version that takes every text whole."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict
from functools import reduce

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from demandkit.llm import alignment as al, queries, words

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(words.BYTE_BPE)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=words.PIECE_BPE)


@pytest.fixture(scope="module")
def aligner():
    return al.Aligner()


def plain_groups(tokenizers, text):
    """Groups of ids on both sides, or nothing."""
    if not text:
        return []
    a, b = tokenizers
    letters = words.byte_alphabet()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
    pieces = [b.id_to_piece(i) for i in ids_b]
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, pieces)]
    if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
        return []
    groups, at_a, at_b, x, y = [([], [])], 0, 0, 0, 0
    while x < len(ids_a) or y < len(ids_b):
        if at_a <= at_b:
            groups[-1][0].append(ids_a[x])
            at_a += len(bytes_a[x])
            x += 1
        else:
            groups[-1][1].append(ids_b[y])
            at_b += len(bytes_b[y])
            y += 1
        if at_a == at_b:
            groups.append(([], []))
    return groups[:-1]


def plain(tokenizers, rows):
    found = [(i, plain_groups(tokenizers, t)) for i, t in rows]
    holds = Counter()
    for _, groups in found:
        holds.update({(a, b) for x, y in groups for a in x for b in y})
    highest = defaultdict(int)
    for (a, _), n in holds.items():
        highest[a] = max(highest[a], n)
    out = []
    for i, groups in found:
        links = [(a, b) for x, y in groups for a in x for b in y]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((
            i, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
            sum(holds[p] == highest[p[0]] for p in links), sum(holds[p] for p in links),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return out


BITS = ["a", "Bee", "don't", " ", " ", " ", "  ", "   ", "\n", "\r\n", ";\r", "\t", " ", "　", "\x1c", "é", "語言", "12345", "!?", "<|endoftext|>", "<s>", "\x00", "🙂", "internationalisation"]


def texts(seed, n, most=20):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(BITS) for _ in range(rnd.randint(1, most))) for _ in range(n)]


def written(groups):
    return "".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) + ";" for x, y in groups).encode()


def test_documents_equal_whole_texts(tokenizers, aligner):
    rows = [*texts(1, 3000), "a▁b", "", " ", "\n", "  ", "x ", " x"]
    for text, made in zip(rows, aligner.documents(rows)):
        assert (made.closed if made.ok else b"") == written(plain_groups(tokenizers, text)), repr(text)


def test_fragments_are_a_monoid(tokenizers, aligner):
    """Any byte ranges, joined in any order of neighbours, give the whole text."""
    rnd = random.Random(2)
    met = 0
    for text in texts(3, 400, 60):
        cut = al.ranges(text, rnd.choice([1, 2, 5, 9, 30]))
        made = aligner.fragments(cut)
        met += sum(f.met for f in made)
        want = written(plain_groups(tokenizers, text))
        left = reduce(al.Fragment.__add__, made).whole()
        while len(made) > 1:
            at = rnd.randrange(len(made) - 1)
            made[at : at + 2] = [made[at] + made[at + 1]]
        tree = made[0].whole()
        assert tree.ok and tree.closed == left.closed == want, repr(text)
        assert (tree.codes == left.codes).all() and (tree.times == left.times).all()
        direct = aligner.documents([text])[0]
        assert (direct.codes == tree.codes).all() and (direct.times == tree.times).all()
        assert (tree.n_a, tree.n_b, tree.n_groups, tree.n_links) == (direct.n_a, direct.n_b, direct.n_groups, direct.n_links)
    assert met > 500


def test_ranges_inside_one_unit(tokenizers, aligner):
    rnd = random.Random(8)
    open_ones = 0
    for _ in range(300):
        unit = "".join(rnd.choice(["internation", "alisat", "ion", "12345", "!?", "語言", "\n", "don't", "é🙂"]) for _ in range(rnd.randint(1, 5)))
        size = len(unit.encode()) + 1
        cuts = sorted(rnd.sample(range(1, size), min(size - 1, rnd.randint(1, 8))))
        made = aligner.fragments([(unit, low, high) for low, high in zip([0, *cuts], [*cuts, size])])
        open_ones += sum(not f.met and len(f.pre_a) + len(f.pre_b) > 0 for f in made)
        right = reduce(lambda x, y: y + x, reversed(made)).whole()
        assert right.ok and right.closed == reduce(al.Fragment.__add__, made).whole().closed == written(plain_groups(tokenizers, unit))
    assert open_ones > 50


def test_rows_of_fragments_come_back(aligner):
    (made,) = aligner.fragments([("internationalisation and more", 3, 24)])
    names = [c.split()[0] for c in al._FRAGMENT.split(", ")]
    back = al.Fragment.of(dict(zip(names, made.row())))
    assert back.row() == made.row()


def test_groups_with_very_many_links(aligner, monkeypatch):
    text = " ".join(texts(4, 50))
    (whole,) = aligner.documents([text])
    monkeypatch.setattr(al, "_LISTED", 1)
    (counted,) = aligner.documents([text])
    assert (counted.codes == whole.codes).all() and (counted.times == whole.times).all() and counted.n_links == whole.n_links


def test_query_equals_plain(spark, sf_dir, tokenizers):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    made = queries.QUERIES["op12_token_alignment"](spark, sf_dir)
    assert made.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, made.collect())) == sorted(plain(tokenizers, [tuple(r) for r in docs.collect()]))


def test_small_ranges_and_parts(spark, tokenizers):
    rows = [(i, t) for i, t in enumerate([*texts(5, 60, 200), "one " * 500, "unbroken" * 300])]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    made = al.align_documents(docs, range_bytes=50, fan=2, part_bytes=700, digest=True)
    assert sorted(map(tuple, made.collect())) == sorted(plain(tokenizers, rows))


def test_odd_tables(spark, tokenizers):
    assert al.align_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    long = "a longer text of some words " * 20
    rows = [(None, "one two"), (4, None), (4, ""), (4, "a▁b"), (7, "one two"), (7, "one two"), (8, long), (8, long), (None, long)]
    odd = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("part", "codes", "key", "seq", "n", "groups")})
    got = al.align_documents(odd, range_bytes=100).collect()
    assert sorted((str(r[0]), *r[1:7]) for r in got) == sorted((str(r[0]), *r[1:7]) for r in plain(tokenizers, rows))
    assert all(r.groups == written(plain_groups(tokenizers, "one two")).decode()[:-1] for r in got if r.n_a and r.n_a < 10)
    assert np.sum([r.groups == "" for r in got]) == 3
