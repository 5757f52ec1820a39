from __future__ import annotations

import base64
import random
import re

import pytest
from pyspark.sql import functions as F

from demandkit.llm import quality

SCHEMA = "doc_id long, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def some_texts():
    rnd = random.Random(8)
    alphabet = ["a", "b", "É", "日本", "x#", "|", "<>", "😀"]
    for _ in range(150):
        yield "".join(rnd.choice(alphabet) + rnd.choice([" ", "  ", "\n", "\t", "\x0b", "\xa0", "\x1c"]) for _ in range(rnd.randint(0, 60)))
    yield from (None, "", " ", "\n\n", "one", "a b c a b c", "a b c d a b c", "x\nx\nx", " x\nx ")


@pytest.mark.parametrize("wide", [1 << 21, 2])
def test_counts_equal_brute_force(spark, monkeypatch, wide):
    rows = list(enumerate(some_texts()))
    if wide == 2:
        monkeypatch.setattr(quality, "_WIDE", wide)
        assert [quality.base_counts((t or "").encode()) for _, t in rows] == [plain(t) for _, t in rows]
        return
    made = quality.judge_quality(spark.createDataFrame(rows, SCHEMA).repartition(3))
    got = {r.doc_id: r for r in made.collect()}
    for i, t in rows:
        want = plain(t)
        assert tuple(got[i][1:6]) == want
        assert got[i].base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (got[i].kept and got[i].base_failed)


def prose(rnd, n):
    vocabulary = ["".join(rnd.choice("aeioulmnrst") for _ in range(rnd.randint(1, 9))) for _ in range(3000)]
    return " ".join(rnd.choice(vocabulary) for _ in range(n))


def test_bands(spark):
    rnd = random.Random(9)
    noise = base64.b64encode(rnd.randbytes(9000)).decode()
    noise = " ".join(noise[i : i + 60] for i in range(0, len(noise), 60))
    rows = {
        "prose": (prose(rnd, 400), True),
        "long prose": (prose(rnd, 30_000), True),
        "repetitive": (" ".join(f"the number {i % 50} of fifty and so on" for i in range(400)), False),
        "incompressible": (noise, False),
        "half noise": (prose(rnd, 2000) + " " + noise, False),
        "some noise": (prose(rnd, 20_000) + " " + noise, True),
    }
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows.values())], SCHEMA)
    got = {r.doc_id: r.kept for r in quality.judge_quality(docs).collect()}
    assert {k: got[i] for i, k in enumerate(rows)} == {k: want for k, (_, want) in rows.items()}


def test_clean_documents_of_the_table_are_kept(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    made = quality.judge_quality(docs).join(labels, "doc_id").where("quality = 1 AND NOT base_failed")
    assert made.where("NOT kept").count() == 0 and made.count() > 20


def test_odd_tables(spark):
    assert quality.judge_quality(spark.createDataFrame([], SCHEMA)).count() == 0
    odd = spark.createDataFrame([(None, None), (1, "a"), (1, "a")], SCHEMA).withColumns({c: F.lit("x") for c in ("kept", "ratio")})
    assert [r.kept for r in quality.judge_quality(odd).collect()] == [False] * 3
