from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from demandkit.llm import simhash
from demandkit.llm.components import components

SCHEMA = "doc_id long, text string"


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    n = len(words)
    parts = [b" ".join(words[i : i + 3]) for i in range(max(1, n - 2))] if n else []
    hashes = [xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, bits=3):
    prints = [plain_fingerprint(t) for _, t in rows]
    names = [i for i, _ in rows]
    changed = True
    while changed:
        changed = False
        for x in range(len(rows)):
            for y in range(len(rows)):
                if (prints[x] ^ prints[y]).bit_count() <= bits and names[y] < names[x]:
                    names[x], changed = names[y], True
    return sorted((i, f"{p:016x}", c) for (i, _), p, c in zip(rows, prints, names))


def near_copies(seed, groups, copies, words):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    rows = []
    for _ in range(groups):
        base = [rnd.choice(vocabulary) for _ in range(words)]
        for _ in range(copies):
            own = list(base)
            own[rnd.randrange(words)] = rnd.choice(vocabulary)
            rows.append((len(rows), rnd.choice([" ", "\n", "\t "]).join(own).title()))
    return rows


@pytest.mark.parametrize("chunk", [1024, 3])
def test_equals_brute_force(spark, chunk):
    rows = near_copies(1, 6, 20, 150) + [(1000, None), (1001, ""), (1002, " \n"), (1003, "One"), (1004, "one two"), (1005, "ONE TWO")]
    rows += [(1006, "one\x0btwo"), (1007, "Äpfel äpfel x"), (1008, "äpfel äpfel X")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = simhash.simhash_components(docs, chunk=chunk)
    assert sorted(map(tuple, got.collect())) == plain_components(rows)


def test_whole_table_equals_brute_force_on_links(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = simhash.simhash_components(docs)
    assert sorted(map(tuple, got.collect())) == plain_components(rows)


def test_every_close_pair_shares_two_blocks():
    masks = [m % (1 << 64) for m in simhash.block_masks()]
    rnd = random.Random(2)
    for _ in range(500):
        flips = sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 3)))
        assert any(flips & m == 0 for m in masks)


def test_long_text_in_steps(monkeypatch):
    text = " ".join(f"w{i * i % 97}" for i in range(2000))
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "_STEP", 64)
    assert simhash.fingerprint(text.encode()) == whole == plain_fingerprint(text)


def test_odd_tables(spark):
    assert simhash.simhash_components(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (None, "nothing else like this")]
    odd = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("fp", "fingerprint", "component_id", "root")})
    got = [(r.doc_id, r.component_id) for r in simhash.simhash_components(odd).collect()]
    assert sorted(got, key=str) == sorted([(None, 5), (5, 5), (5, 5), (None, None)], key=str)
    kept = simhash.keep_one_per_component(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id is None, r.text) for r in kept.collect()) == [
        (False, "a b c d"), (False, "a b c d"), (True, "a b c d"), (True, "nothing else like this")
    ]


def test_components_of_chains_stars_and_loops(spark):
    rnd = np.random.default_rng(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(1, 1), (2, 3), (3, 2), (2, 3)]
    edges += [tuple(map(int, e)) for e in rnd.integers(1000, 1060, (40, 2))]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {n: n for e in edges for n in e}
    for _ in want:
        for a, b in edges:
            want[a] = want[b] = min(want[a], want[b])
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert got == {n: r for n, r in want.items() if n in linked}
