"""The corpus pipeline: stages over ``documents``, each written and read again by the next.

1. ``language_id``: documents that have no letter, or fit no learned language, go.
2. ``exact_dedup``: of equal texts the row with the smallest id stays.
3. ``near_dedup``: of each group of near copies (SimHash fingerprints of three-word shingles
   that differ in three bits or fewer, linked transitively) the document with the smallest id
   stays.
4. ``decontaminate``: documents with ten consecutive words of a benchmark item go, and those
   of whose words at least half (``SHORT_SHARE``) are in items of fewer words.
5. ``bpe``: the rest is encoded, and decoded again.

Defined cases are those of the operators. A stage keeps all columns of its input; only the
last gives others.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm import bpe, decontaminate, exact_dedup, language_id, simhash
from meterlake.llm.common import shared_dir, short_batches, written

# Share of a document that benchmark items of fewer than ten words must make up to drop it.
SHORT_SHARE = 0.5


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs, language_id.learn(docs))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicate(docs, simhash.OP6)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.decontaminate(docs, items, short_share=SHORT_SHARE)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    encoded = bpe.encode(docs.select("doc_id", "text"), path, decoded="decoded")
    columns = "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded"
    # Written here, as the size of a batch between executors and workers is one of the session.
    with short_batches(spark):
        return written(encoded.select(*columns), "bpe")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("decontaminate", benchmark_stage),
    ("bpe", bpe_stage),
]

# Kernels, fingerprints and the tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written to the shared folder."""
    root = f"{shared_dir(spark)}/pipeline-{uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
