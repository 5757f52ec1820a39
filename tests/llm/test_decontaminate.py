from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from demandkit.llm import decontaminate

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def shingles(text, lengths=()):
    words = (text or "").lower().split()
    own = {tuple(words[i : i + n]) for n in lengths for i in range(len(words) - n + 1)}
    return own | {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain(docs, items, threshold=0.8):
    have, want = {}, {}
    lengths = {len((t or "").split()) for _, t in items} - {0}
    lengths = {n for n in lengths if n < 5}
    for d, t in docs:
        have.setdefault(d, set()).update(shingles(t, lengths))
    for i, t in items:
        want.setdefault(i, set()).update(shingles(t))
    out = []
    for i, w in want.items():
        for d, h in have.items():
            if w and None not in (i, d) and len(w & h) >= threshold * len(w) - 1e-9:
                out.append((d, i, len(w & h), len(w), round(len(w & h) / len(w), 6)))
    return sorted(out)


@pytest.mark.parametrize("broadcast", [1 << 20, 0])
def test_equals_brute_force(spark, monkeypatch, broadcast):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", broadcast)
    rnd = random.Random(7)
    word = lambda: f"w{rnd.randrange(300)}"
    stem = [word() for _ in range(12)]  # a phrase that all items share
    items = [(i, " ".join(stem[: rnd.choice([0, 12])] + [word() for _ in range(rnd.randint(1, 60))])) for i in range(30)]
    items += [(30, None), (31, ""), (32, "one"), (33, "one two three"), (34, " ".join(stem)), (None, "one two"), (3, "two texts under one id")]
    docs = []
    for i in range(120):
        own = [word() for _ in range(rnd.choice([0, 3, 50, 2000]))]
        taken = (rnd.choice(items)[1] or "").split()
        for _ in range(rnd.choice([0, 0, 1, 2, 4])):  # a changed word takes five shingles away
            if taken:
                taken[rnd.randrange(len(taken))] = "changed"
        at = rnd.randint(0, len(own))
        docs.append((rnd.choice([i, i, i, None, 5]), rnd.choice([" ", "\n ", "\t"]).join([*own[:at], *taken, *own[at:]]).upper()))
    docs += [(200, None), (201, ""), (202, "One"), (203, "one  two\x0bthree"), (204, "one two three four"), (205, "x " * 5000)]
    made = decontaminate.contained_items(spark.createDataFrame(docs, DOCS).repartition(4), spark.createDataFrame(items, ITEMS))
    want = plain(docs, items)
    assert len(want) > 30
    assert sorted(map(tuple, made.collect())) == want


def test_short_items_inside_longer_documents(spark):
    docs = [(1, "one two alpha beta gamma three four five six"), (2, "alpha beta"), (3, "beta gamma"), (4, "gamma alpha beta")]
    items = [(1, "alpha beta gamma"), (2, "Six"), (3, "alpha beta"), (4, "four five six seven")]
    made = decontaminate.contained_items(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    assert sorted(map(tuple, made.collect())) == [(1, 1, 1, 1, 1.0), (1, 2, 1, 1, 1.0), (1, 3, 1, 1, 1.0), (2, 3, 1, 1, 1.0), (4, 3, 1, 1, 1.0)]


def test_sketch_cannot_be_missed():
    """For every size, an item that keeps the threshold has more shingles than can be absent."""
    for n in range(1, 3000):
        largest = 1 << (n - 1).bit_length()
        assert min(n, largest - -(-8 * largest // 10) + 1) > n - -(-8 * n // 10)


def test_odd_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "else")], DOCS)
    items = spark.createDataFrame([(9, "a b c d e f")], ITEMS)
    odd = docs.withColumns({c: F.lit(1) for c in ("item_id", "h", "_w", "_met", "n_item", "_items")})
    odd_items = items.withColumns({c: F.lit(1) for c in ("doc_id", "h", "_k", "_place", "n_item")})
    assert [tuple(r) for r in decontaminate.contained_items(odd, odd_items).collect()] == [(1, 9, 2, 2, 1.0)]
    kept = decontaminate.drop_contaminated(odd, odd_items)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "None"]
    assert decontaminate.contained_items(docs, items.limit(0)).count() == 0
    assert decontaminate.contained_items(docs.limit(0), items).count() == 0
