from __future__ import annotations

import itertools
import math
import os
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from demandkit.llm import lattice, segmentation

SCHEMA = "doc_id long, text string"
PIECES = ["a", "b", "c", "ab", "bc", "abc", "▁", "▁a", "▁ab", "ca"]


@pytest.fixture(scope="module")
def small():
    log_p = [math.log(w) for w in (5, 4, 3, 6, 2, 1, 2, 3, 4, 2)]
    return lattice.Vocabulary.of(PIECES + [""] * 256, log_p + [0.0] * 256, list(range(10, 266)), ranked=False)


def every_path(v, text):
    """All segmentations and their probabilities, by going through all cuts."""
    text = "▁" + text.replace(" ", "▁") if text else ""
    found = {}
    for cuts in itertools.product([0, 1], repeat=max(0, len(text) - 1)):
        ends = [i + 1 for i, c in enumerate(cuts) if c] + [len(text)]
        parts = [text[a:b] for a, b in zip([0, *ends], ends)]
        if all(p in PIECES for p in parts):
            ids = tuple(PIECES.index(p) for p in parts)
            found[ids] = math.exp(sum(v.log_p[i] for i in ids))
    total = sum(found.values())
    return {k: x / total for k, x in found.items()}


def drawn(v, text, k, n):
    return lattice.segment(v, [text] * n, [segmentation.row_seed(i, 1) for i in range(n)], k)


def test_log_probabilities_are_exact(small):
    exact = every_path(small, "abcab ca")
    seen = set()
    for row in drawn(small, "abcab ca", 4, 300):
        for s in row:
            assert abs(s.log_p - math.log(exact[tuple(s.ids.tolist())])) < 1e-4
            seen.add(tuple(s.ids.tolist()))
        assert len({tuple(s.ids.tolist()) for s in row}) == 4
        values = [s.perturbed for s in row]
        assert values == sorted(values, reverse=True)
    assert len(seen) > 20


def test_draws_follow_sampling_without_replacement(small):
    text, n = "abc a", 30_000
    exact = every_path(small, text)
    rows = [[tuple(s.ids.tolist()) for s in row] for row in drawn(small, text, 3, n)]
    want = Counter()
    for x, y, z in itertools.permutations(exact, 3):
        want[x, y, z] = exact[x] * exact[y] / (1 - exact[x]) * exact[z] / (1 - exact[x] - exact[y])
    got = Counter(map(tuple, rows))
    assert set(got) <= set(want) and abs(sum(want.values()) - 1) < 1e-9
    likely = [k for k in want if want[k] * n > 20]
    chi = sum((got[k] - want[k] * n) ** 2 / (want[k] * n) for k in likely)
    assert chi < len(likely) + 5 * math.sqrt(2 * len(likely))


def test_inclusion_scores_make_unbiased_sums(small):
    """Weighting each sample by one over its inclusion probability estimates the number of paths."""
    exact = every_path(small, "abc ab")
    sums = [sum(math.exp(-s.log_inclusion) for s in row) for row in drawn(small, "abc ab", 5, 4000)]
    assert abs(np.mean(sums) - len(exact)) < 5 * np.std(sums) / math.sqrt(len(sums))


def test_few_segmentations_give_all(small):
    for text in ("a", "ab", "", "b b"):
        exact = every_path(small, text)
        for row in drawn(small, text, 40, 20):
            assert {tuple(s.ids.tolist()) for s in row} == set(exact) or text == ""
            assert len(row) == max(1, len(exact)) and all(s.log_inclusion > -1e-9 for s in row)


def test_company_changes_nothing(small):
    texts = ["abc ab", "a", "", "cab\ncab é▁ 日", " a  b "]
    together = lattice.segment(small, texts, [1, 2, 3, 4, 5], 3)
    for i, text in enumerate(texts):
        alone = lattice.segment(small, [text], [i + 1], 3)[0]
        assert [(s.ids.tolist(), s.perturbed) for s in alone] == [(s.ids.tolist(), s.perturbed) for s in together[i]]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=4), st.integers(1, 3))
def test_any_text_comes_back(small, texts, k):
    for text, row in zip(texts, lattice.segment(small, texts, range(len(texts)), k)):
        assert all(small.decode(s.ids.tolist()) == text for s in row)
        assert len({tuple(s.ids.tolist()) for s in row}) == len(row) >= 1


@pytest.mark.skipif(not os.path.exists(segmentation.MODEL), reason="no vocabulary files")
def test_whole_table_and_odd_rows(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    more = spark.createDataFrame([(None, None), (-1, ""), (-1, ""), (-2, " \n▁▁é😀 " + "long" * 5000), (-3, "a"), (-3, "a")], SCHEMA)
    rows = docs.union(more).withColumns({c: F.lit("x") for c in ("ids", "nth", "decoded")})
    made = segmentation.sample_segmentations(rows).collect()
    assert all(r.round_trip and r.n_ids == len(r.ids) for r in made)
    per = Counter(r.doc_id for r in made)
    assert per[None] == 1 and per[-1] == 2 and per[-2] == 2 and per[-3] == 4
    assert {i for i, n in per.items() if n == 2} >= {r.doc_id for r in docs.where("length(text) > 20").collect()}
    first = {tuple(r.ids) for r in made if r.doc_id == -3 and r.nth == 0}
    assert len(first) == 1
    decoded = segmentation.decode_segmentations(spark.createDataFrame(made)).where("doc_id >= 0")
    wrong = decoded.join(docs, "doc_id").where("decoded <> text")
    assert wrong.count() == 0
    assert segmentation.sample_segmentations(more.limit(0)).count() == 0
