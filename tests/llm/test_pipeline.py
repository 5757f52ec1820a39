"""The pipeline, stage by stage, against a plain version without Spark."""

from __future__ import annotations

import zlib

import pytest
from test_decontaminate import plain as plain_contained
from test_line_dedup import plain as plain_lines
from test_simhash import plain_components

import corpus_pipeline
from demandkit.llm import lattice, segmentation, toxicity


def train_rows(docs, labels):
    rows = [(i, t, labels[i]) for i, t in docs if i in labels and zlib.crc32(str(i).encode()) % 3 != 1]
    return sorted(rows)


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """What each stage returns, written and read again."""
    made = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = str(tmp_path_factory.mktemp("stage") / str(n))
        stage(spark, made[-1], sf_dir).write.parquet(out)
        made.append(spark.read.parquet(out))
    return made


def rows(df):
    return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_all_but_the_last_return_documents(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line dedup", "simhash near dedup", "benchmark decontamination", "sentencepiece encoding"
    ]
    assert all(s.schema.simpleString() == stages[0].schema.simpleString() for s in stages[1:-1])


def test_toxicity(spark, sf_dir, stages):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    docs = rows(stages[0])
    sample = train_rows(docs, labels)  # the table is smaller than the bounds of the sample
    model = toxicity.train([t for _, t, _ in sample], [y for *_, y in sample])
    found, _ = toxicity.scores(model, [t for _, t in docs])
    assert rows(stages[1]) == [d for d, s in zip(docs, found) if s < 0.7]
    clean = [i for i, _ in docs if labels.get(i) == 0]
    assert len({i for i, _ in rows(stages[1])} & set(clean)) >= 0.95 * len(clean)


def test_line_dedup(stages):
    assert rows(stages[2]) == sorted((i, t) for i, t, *_ in plain_lines(rows(stages[1]), 40, 5))
    assert all(r.n_chars == len(r.text) for r in stages[2].collect())


def test_near_duplicates(stages):
    keep = {i for i, _, c in plain_components(rows(stages[2])) if i == c}
    assert rows(stages[3]) == [d for d in rows(stages[2]) if d[0] in keep]


def test_decontamination(spark, sf_dir, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    bad = {d for d, *_ in plain_contained(rows(stages[3]), items)}
    assert rows(stages[4]) == [d for d in rows(stages[3]) if d[0] not in bad]


def test_encoding(stages):
    v = lattice.Vocabulary.load(segmentation.MODEL)
    got = {(r.doc_id, r.nth): r.ids for r in stages[5].collect()}
    want = {}
    for i, text in rows(stages[4]):
        for n, s in enumerate(lattice.segment(v, [text], [segmentation.row_seed(i, segmentation.SEED)], segmentation.SAMPLES)[0]):
            want[i, n] = s.ids.tolist()
            assert v.decode(want[i, n]) == text
    assert got == want


def test_run_equals_the_stages(spark, sf_dir, stages):
    made = corpus_pipeline.run(spark, sf_dir)
    assert sorted((r.doc_id, r.nth, r.ids) for r in made.collect()) == sorted((r.doc_id, r.nth, r.ids) for r in stages[5].collect())
