"""From raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame. Its result
is written as Parquet and read again as the next stage's ``docs``, so a stage
never recomputes an earlier one and a lost executor costs one stage's tasks at
most. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, packing, registry, simhash, substring_dedup, toxicity
from tidemark.llm.common import prepare, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go. It learns from this
    stage's input and ``labels``, the held-out fold aside."""
    prepare(spark)
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), ~toxicity.held_out(F.col("doc_id")))
    return toxicity.drop_toxic(docs, model)


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    prepare(spark)
    return simhash.keep_one(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a smaller document already has are cut out of the text."""
    prepare(spark)
    return substring_dedup.strip_repeats(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    prepare(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of every document, packed into sequences."""
    prepare(spark)
    return packing.pack_documents(docs, registry.tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", keep_one_copy),
    ("substring_dedup", drop_repeated_passages),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack),
]

#: SQL cannot express the toxicity model, XXH64 fingerprints or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
