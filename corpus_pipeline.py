"""A corpus cleaned and encoded in stages: each works on what the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from demandkit.llm import decontaminate, line_dedup, segmentation, simhash, toxicity
from demandkit.plans.catalogue import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go; the model is fitted on labelled rows that are not held out."""
    model = toxicity.train_on(docs, table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, model)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long lines of many documents stay in one of them; all documents stay, ``n_chars`` follows the text."""
    made = line_dedup.dedup_lines(docs)
    return made.withColumn("n_chars", F.char_length("text").cast("long")).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of close fingerprints stays, the one with the smallest id: three-word shingles, three bits at most."""
    return simhash.keep_one_per_component(docs)


def drop_benchmark_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's sampled segmentations into pieces."""
    return segmentation.sample_segmentations(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic_documents),
    ("line dedup", drop_repeated_lines),
    ("simhash near dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_documents),
    ("sentencepiece encoding", encode_documents),
]
#: Neither the network nor the sampling can be said in SQL; the tests compare with a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
