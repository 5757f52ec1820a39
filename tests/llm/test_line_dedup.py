from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandkit.llm import common, line_dedup

SCHEMA = "doc_id long, text string"
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain(rows, min_chars, min_docs):
    def key(x):
        k = x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
        return k if len(k) >= min_chars else None

    holders = defaultdict(list)
    for i, (d, t) in enumerate(rows):
        for k in {key(x) for x in (t or "").split("\n")} - {None}:
            holders[k].append((i, d))
    out = []
    for d, t in rows:
        lines, kept = (t or "").split("\n"), []
        for x in lines:
            had = holders.get(key(x), [])
            last = max((y for _, y in had if y is not None), default=object())
            n = len({y for _, y in had if y is not None}) + sum(y is None for _, y in had)
            if n < min_docs or d == last:
                kept.append(x)
        out.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("shard_keys", [1 << 16, 7])
@pytest.mark.parametrize("heavy, probes", [(1024, 1 << 22), (20, 9), (1, 25)])
def test_equals_brute_force(spark, monkeypatch, shard_keys, heavy, probes):
    monkeypatch.setattr(line_dedup, "HEAVY", heavy)
    monkeypatch.setattr(line_dedup, "PROBES", probes)
    rnd = random.Random(4)
    pool = [f"Line {i} " + "x" * rnd.choice([2, 20, 40]) for i in range(60)] + ["Äö" * 20, "Äö" * 19, "COMMON " * 9]
    rows = []
    for i in range(150):
        lines = [rnd.choice([str, str.upper, lambda x: f"\t {x}\x0b\r"])(rnd.choice(pool)) for _ in range(rnd.randint(0, 12))]
        rows.append((rnd.choice([None, i, i, i, 7]), "\n".join([*lines, pool[-1]] if i % 3 else lines)))
    rows += [(900, None), (901, ""), (902, "\n\n"), (903, "\n".join(pool * 50))]
    made = line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA).repartition(4), min_chars=20, min_docs=5, shard_keys=shard_keys)
    assert sorted(map(tuple, made.collect()), key=str) == plain(rows, 20, 5)


def test_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(5)
    h1, h2 = rng.integers(0, 1 << 63, (2, 20_000)).astype(np.uint64)
    h1[:100] = h1[100]  # equal first halves
    sizes, words = line_dedup.build_hash(h1, h2)
    assert sorted(line_dedup.slots(sizes, words, h1, h2)) == list(range(20_000))
    assert len(words) * 64 < 5 * 20_000
    empty = line_dedup.build_hash(h1[:0], h2[:0])
    assert line_dedup.slots(*empty, h1[:3], h2[:3]).tolist() == [-1, -1, -1]


def test_rows_of_one_id_are_one_document(spark):
    line = "a line that four rows of one document and a row of another hold"
    rows = [(1, f"{line}\nown {n}") for n in range(4)] + [(2, line)]
    made = line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA))
    assert all(r.n_dropped == 0 for r in made.collect())


def test_lists_of_rows_without_an_id_are_their_own(spark):
    """A third of all rows have no id; each gets the marks of its own text only, once."""
    lines = [f"long line number {n} that is in very many of the documents" for n in range(60)]
    rows = [(None if i % 3 == 0 else i, "\n".join([f"own {i}", lines[i % 60], lines[(i * 7) % 60]])) for i in range(600)]
    made = line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert sorted(map(tuple, made.collect()), key=str) == plain(rows, 40, 5)
    marks = spark.createDataFrame([(None, 1, b"x"), (None, 1, b"x"), (None, 2, b"y")], "doc_id long, hash long, mark binary")
    docs = spark.createDataFrame([(None, "t")], SCHEMA)
    assert common.with_marks(docs, "doc_id", "text", marks).collect()[0][-1] is None
    own = docs.select(F.lit(None).cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"), F.lit(b"m").alias("mark"))
    assert common.with_marks(docs, "doc_id", "text", own.union(own)).collect()[0][-1] == [b"m"]


def test_a_line_just_below_heavy_is_dealt_to_copies(spark, monkeypatch):
    """A line with a 1,500th of all occurrences is answered by several tasks, none of many more than PROBES."""
    monkeypatch.setattr(line_dedup, "PROBES", 100)
    asked = []
    inner = line_dedup.arrow_map

    def spy(df, fn, schema):
        if getattr(fn, "func", None) is line_dedup._probe_batches:
            asked.extend(r["n"] for r in df.where("kind = 1").groupBy("shard", "copy").agg(F.count(F.lit(1)).alias("n")).collect())
        return inner(df, fn, schema)

    monkeypatch.setattr(line_dedup, "arrow_map", spy)
    common_line = "a line that a fifteen hundredth of all occurrences hold, more or less"
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(1499)), lambda n: F.concat(F.lit("a line of its own in this document, as most are "), F.col("id").cast("string"), F.lit("-"), n.cast("string"))), "\n"), F.lit("\n" + common_line)).alias("text"))
    made = line_dedup.dedup_lines(docs, shard_keys=300).select("doc_id", "n_dropped").collect()
    assert sorted((r.doc_id, r.n_dropped) for r in made) == [(i, int(i != 399)) for i in range(400)]
    assert max(asked) < 250, max(asked)


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert line_dedup.dedup_lines(empty).count() == 0
    rows = [(i, "the same long line, again and again, in all of them\nown") for i in range(6)]
    odd = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("mark", "h1", "n_lines", "shard")})
    made = line_dedup.dedup_lines(odd)
    assert made.columns == ["doc_id", "text", "mark", "h1", "shard", "n_lines", "n_dropped"]
    assert sorted((r.doc_id, r.text, r.n_dropped) for r in made.collect()) == [
        *[(i, "own", 1) for i in range(5)], (5, rows[5][1], 0)
    ]
