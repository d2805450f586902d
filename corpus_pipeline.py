"""The corpus pipeline: quality, exact dedup, near dedup, decontamination, packing, each over all that the last kept.

Every stage takes (spark, docs, sf_dir) and its result is written as Parquet and read again as the next stage's docs. Rows
are judged row by row, whatever their doc_id: null and repeated ids lose no text, link or hit. Further columns, with any
names, pass through. An empty table passes every stage as an empty table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from folioscope.llm import decontamination, exact_dedup, near_dedup, packing, quality
from folioscope.llm.common import discard, documents, scoped, stored
from folioscope.llm.queries import tokenizer_path

#: Similarity of word shingles from which two documents are near copies, in percent.
NEAR_PERCENT = 80


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the line-label field scores at least 0.5. Null text counts as empty and is scored like any text; repeated
    rows get one score; without labels of both classes the only class decides."""
    return quality.drop_rejected(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the smallest doc_id. Null text counts as empty. Rows that
    repeat it in doc_id and text stay with it; null doc_ids stay only where the whole group has none."""
    return exact_dedup.drop_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id. Texts without words are linked with
    nothing and stay, as do rows with null doc_id; rows that repeat a kept one stay."""
    return near_dedup.drop_near_copies(docs, NEAR_PERCENT)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose own text holds no benchmark window. Null text holds none."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens, one row a piece; null text is the end id alone and repeated rows are packed as
    often as they come. The workers hold what earlier stages left, so they remember fewer words."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"), 0, 2048, with_ids=False, words=150_000)


STAGES = [
    ("quality", keep_quality),
    ("exact_dedup", drop_exact),
    ("near_dedup", drop_near),
    ("decontamination", drop_leaked),
    ("packing", pack),
]

#: Neither the classifier nor the packing can be put in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages. What a stage stored goes as soon as its result is stored, and that result after the next one."""
    docs, name, last = documents(spark, sf_dir), f"run-{uuid.uuid4().hex}", None
    for number, (_, stage) in enumerate(STAGES[:-1]):
        with scoped(f"{name}/work"):
            kept = stage(spark, docs, sf_dir)
        with scoped(f"{name}/{number}"):
            docs = stored(kept, "kept")
        for done in (f"{name}/work", last):
            if done:
                discard(spark, done)
        last = f"{name}/{number}"
    with scoped(f"{name}/packing"):
        return STAGES[-1][1](spark, docs, sf_dir)
