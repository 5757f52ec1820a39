"""Substring dedup, as the query runs it, against a version that looks at every run of every text."""

from __future__ import annotations

import random
import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from demandkit.llm import queries, substring_dedup as sd

SCHEMA = "doc_id long, text string"


def plain_sentences(text):
    """For texts whose sentences end in one or two spaces or a line break."""
    out = []
    for part in re.split(r"(?<=\n)(?![ \t-\r])|(?<=[.!?][ \t-\r])(?![ \t-\r])|(?<=[.!?][ \t-\r]{2})(?![ \t-\r])", text):
        words = re.findall(r"[^ \t-\r]+[ \t-\r]*", part)
        hashes = [xxh64_intdigest(w.strip(" \t\n\x0b\x0c\r").encode().lower()) for w in words]
        cuts = {min(range(i + 11, i - 1, -1), key=lambda j: hashes[j]) for i in range(1, len(words) - 11)}
        edges = [0, *sorted(cuts), len(words)]
        out += ["".join(words[a:b]) for a, b in zip(edges, edges[1:]) if a < b]
    return out


def plain_runs(s):
    """Begin and end of each run of three sentences, lengthened to 13 words."""
    size = [len(x.split()) for x in s]
    if sum(size) < 13:
        return []
    made = []
    for i in range(max(1, len(s) - 2)):
        j = min(i + 3, len(s))
        while sum(size[i:j]) < 13 and j < len(s):
            j += 1
        while sum(size[i:j]) < 13:
            i -= 1
        if (i, j) not in made:
            made.append((i, j))
    return made


def plain(rows):
    runs, own = {}, [plain_sentences(t or "") for _, t in rows]
    for n, (d, _) in enumerate(rows):
        for i, j in plain_runs(own[n]):
            runs.setdefault(tuple(" ".join(x.lower().split()) for x in own[n][i:j]), []).append((d, i, j, n))
    lost = {}
    for found in runs.values():
        first = min(d for d, *_ in found)
        for d, i, j, n in found:
            if d != first or i != min(x[1] for x in found if x[3] == n):
                lost.setdefault(n, set()).update(range(i, j))
    return sorted((d, "".join(x for i, x in enumerate(own[n]) if i not in lost.get(n, ())), len(own[n]), len(lost.get(n, ()))) for n, (d, _) in enumerate(rows))


def passage(rnd, n):
    return [f"w{rnd.randrange(3000)}" for _ in range(n)]


def op4(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    return {r.doc_id: r for r in queries.QUERIES["op4_substring_dedup"](spark, str(folder)).collect()}


def test_equals_brute_force(spark):
    rnd = random.Random(10)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 3)))
    sentence = lambda: " ".join(word() for _ in range(rnd.choice([1, 2, 5, 9, 45]))) + rnd.choice([".", "!", "?"])
    pool = [[sentence() for _ in range(rnd.randint(1, 6))] for _ in range(15)]
    rows = []
    for i in range(150):
        parts = [rnd.choice([[sentence()], rnd.choice(pool), [s.upper() for s in rnd.choice(pool)]]) for _ in range(rnd.randint(0, 6))]
        rows.append((i, "".join(s + rnd.choice([" ", "  ", "\n"]) for p in parts for s in p)))
    rows += [(200, rows[50][1]), (7, rows[7][1]), (7, rows[9][1]), (201, None)]
    made = sd.dedup_passages(spark.createDataFrame(rows, SCHEMA).repartition(4))
    want = plain(rows)
    assert sorted((r.doc_id, r.text, r.n_sentences, r.n_removed) for r in made.collect()) == want
    assert sum(n for *_, n in want) > 200 and sum(n > 0 for *_, n in want) > 40


def test_query_equals_brute_force_on_the_table(spark, sf_dir):
    """The given texts have sentences of other forms too; those that the plain version reads alike are compared."""
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    made = {r.doc_id: r for r in queries.QUERIES["op4_substring_dedup"](spark, sf_dir).collect()}
    assert len(made) == len(docs)
    want = {d: (t, n, m) for d, t, n, m in plain(docs)}
    alike = [d for d, t in docs if len(sd.sentences((t or "").encode())[0]) == want[d][1] and "".join(plain_sentences(t or "")) == t]
    assert len(alike) > 0.9 * len(docs)
    differ = [d for d in alike if (made[d].text, made[d].n_removed) != (want[d][0], want[d][2])]
    assert not differ
    assert sum(made[d].n_removed > 0 for d in alike) > 10


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab.!? \n\té", max_size=200))
def test_sentences_put_together_give_the_text(text):
    ends, words = sd.sentences(text.encode(), 3)
    assert ends == sorted(set(ends)) and (ends[-1] if ends else 0) == len(text.encode())
    assert [w for s in words for w in s] == text.encode().lower().split()
    assert all(len(w) <= 3 for w in words)


def test_any_passage_of_sixty_words_is_found(spark):
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefghijklm") for _ in range(7))
    shared = " ".join(word() + rnd.choice(["", "", ".", ""]) for _ in range(61)) + "."
    rows = [(i, f"{word()} {word()}.\n{shared} {word()} {word()} own {i}") for i in range(5)]
    made = {r.doc_id: r for r in sd.dedup_passages(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert made[0].text == rows[0][1] and made[0].n_removed == 0
    assert all(shared[60:300] not in made[i].text and f"own {i}" in made[i].text for i in range(1, 5))


def test_unpunctuated_passages_at_other_offsets(spark, tmp_path):
    rnd = random.Random(12)
    rows = []
    for offset in range(40):
        shared = passage(rnd, 51)
        for before in (0, offset):
            own = [f"d{len(rows)}x{i}" for i in range(before + 7)]
            rows.append((len(rows), " ".join(own[:before] + shared + own[before:])))
    made = op4(spark, tmp_path, rows)
    assert all(made[i].n_removed == 0 for i in range(0, 80, 2))
    assert all(made[i].n_removed >= 3 for i in range(1, 80, 2))


def test_every_passage_shares_a_run_whatever_stands_around_it():
    rnd = random.Random(13)
    for _ in range(2000):
        few = rnd.choice([2, 5, 3000])
        shared = [f"w{rnd.randrange(few)}" + rnd.choice(["", "", "", rnd.choice(["", "."])]) for _ in range(51)]
        found = []
        for side in "ab":
            around = [[f"{side}{rnd.randrange(3000)}" for _ in range(rnd.randint(0, 30))] for _ in range(2)]
            found.append(set(sd.runs(sd.sentences(" ".join(around[0] + shared + around[1]).encode())[1])))
        assert found[0] & found[1]


def test_copies_of_short_sentences_lose_all(spark, tmp_path):
    rnd = random.Random(15)
    listed = "".join(f"{w.upper()}!! " for w in passage(rnd, 60))
    pairs = " ".join(f"{a} {b}." for a, b in zip(passage(rnd, 31), passage(rnd, 31)))
    tail = "One two three four five six seven eight nine. Ten. Eleven. Twelve. Last."
    rows = [(i + 10 * n, t) for n, t in enumerate([listed, pairs, tail]) for i in (1, 2)]
    rows += [(40, "Ten. Eleven. Twelve."), (41, "Ten. Eleven. Twelve."), (50, "of. " * 50)]
    made = op4(spark, tmp_path, rows)
    assert all(made[i].text == t for i, t in rows if i in (1, 11, 21, 40, 41))
    assert all(made[i].text == "" and made[i].n_removed == made[i].n_sentences for i in (2, 12, 22))
    assert made[50].text != rows[-1][1]


def test_marks_of_rows_without_an_id_stay_with_their_text(spark):
    """A third of all rows may have no id: what goes from one of them is found by its own text."""
    rnd = random.Random(16)
    shared = [" ".join(passage(rnd, 20)) + "." for _ in range(30)]
    rows = [(None, f"own {n} begins here. {s} {shared[(n + 7) % 30]}") for n, s in enumerate(shared) for _ in range(3)]
    rows += [(n, s) for n, s in enumerate(shared)]
    made = sd.dedup_passages(spark.createDataFrame(rows, SCHEMA).repartition(3))
    got = [r for r in made.collect() if r.doc_id is None]
    assert len(got) == 90 and all(r.n_removed < r.n_sentences and r.text.startswith("own ") for r in got)


def test_odd_tables(spark):
    assert sd.dedup_passages(spark.createDataFrame([], SCHEMA)).count() == 0
    text = "One two three four. Five six seven eight. Nine ten eleven twelve and so on."
    rows = [(None, text), (4, text), (3, text.upper()), (None, None), (9, ""), (3, text.upper()), (8, "short. short.")]
    clash = ("mark", "h1", "n_removed", "_hash", "_doc_id", "_own", "hash", "nth")
    odd = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in clash})
    made = sd.dedup_passages(odd)
    assert made.columns == ["doc_id", "text", *(c for c in clash if c != "n_removed"), "n_sentences", "n_removed"]
    got = sorted([(str(r.doc_id), r.text, r.n_removed) for r in made.collect()])
    assert got == sorted([("None", "", 3), ("4", "", 3), ("3", text.upper(), 0), ("3", text.upper(), 0), ("None", "", 0), ("9", "", 0), ("8", "short. short.", 0)])
