from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from demandkit.llm import sharding

SCHEMA = "doc_id long, text string"


def holds_the_law(docs, made, shards=8):
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in made if r.doc_id is not None) == sorted(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs if i is not None
    )
    assert len(made) == len(docs)
    counts = Counter(r.shard for r in made)
    assert set(counts) <= set(range(shards)) and max(counts.values()) - min(counts.get(s, 0) for s in range(shards)) <= 1
    slots = defaultdict(list)
    for r in made:
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert {(r.law, r.grown_shard) for r in made} == {("rows", None)}


@pytest.mark.parametrize("stretch", [50_000, 40])
def test_law_and_copies_together(spark, monkeypatch, stretch):
    monkeypatch.setattr(sharding, "STRETCH_ROWS", stretch)
    docs = [(i, f"alone {i}") for i in range(600)] + [(1000 + i, f"copy é {i // 4}") for i in range(200)]
    docs += [(2000 + i, "hot") for i in range(400)] + [(3000, None), (3001, ""), (None, "x"), (None, "x"), (5, "alone 5"), (5, "alone 5")]
    made = sharding.assign_shards(spark.createDataFrame(docs, SCHEMA).repartition(5))
    rows = made.collect()
    holds_the_law(docs, rows)
    places = defaultdict(set)
    for r in rows:
        places[r.text_crc32, r.size].add(r.shard)
    copies = [places[zlib.crc32(f"copy é {i}".encode()), len(f"copy é {i}".encode()) + 1] for i in range(50)]
    assert sum(len(p) > 1 for p in copies) <= 5  # scattered by hash, hardly one of 50 would be whole
    assert sharding.cut_copies(made).first().n_groups == 50 + 4


def test_all_linked_and_all_equal(spark):
    pairs = [(i, f"pair {i // 2}") for i in range(400)]
    rows = sharding.assign_shards(spark.createDataFrame(pairs, SCHEMA)).collect()
    holds_the_law(pairs, rows)
    places = defaultdict(set)
    for r in rows:
        places[r.text_crc32].add(r.shard)
    assert sum(len(p) > 1 for p in places.values()) < 40  # about 175 of 200 by hash alone
    equal = [(i, "same") for i in range(100)]
    holds_the_law(equal, sharding.assign_shards(spark.createDataFrame(equal, SCHEMA)).collect())


def test_odd_tables(spark):
    assert sharding.assign_shards(spark.createDataFrame([], SCHEMA)).count() == 0
    few = [(1, "a"), (2, "a"), (3, "b" * 100_000)]
    odd = spark.createDataFrame(few, SCHEMA).withColumns({c: F.lit("x") for c in ("a", "b", "shard", "size", "place", "home", "n", "loose")})
    holds_the_law(few, sharding.assign_shards(odd).collect())


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    holds_the_law([(r.doc_id, r.text) for r in docs.collect()], sharding.assign_shards(docs).collect())


def test_a_text_with_a_tenth_of_all_rows_is_numbered_in_parts(spark, monkeypatch):
    monkeypatch.setattr(sharding, "STRETCH_ROWS", 100)
    rows = [(i, "the same in a tenth of all rows" if i % 10 == 0 else f"text {i // 3}") for i in range(6000)]
    made = sharding.assign_shards(spark.createDataFrame(rows, "doc_id long, text string"))
    plan = made._jdf.queryExecution().toString()
    got = made.collect()
    by_shard = {}
    for r in got:
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(750)) for v in by_shard.values()) and len(by_shard) == 8
    assert len({r.shard for r in got if r.doc_id % 10 == 0}) == 1 and plan
    numbered = sharding._numbered(
        spark.createDataFrame([(i, 1, 1, 0, 0, 600, 5) for i in range(600)], "doc_id long, a long, b long, shard int, loose int, copies long, size long"), 6000
    )
    parts = numbered.groupBy("stretch", "own", "part").count().collect()
    assert len(parts) == 6 and max(r["count"] for r in parts) < 200
    assert sorted(r.place for r in numbered.collect()) == list(range(600))
