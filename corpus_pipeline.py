"""The corpus pipeline: documents through five operator stages.

1. language ID (operator 9): documents whose language cannot be told go;
2. n-gram Jaccard join (3): one document of each group of near copies stays;
3. benchmark decontamination (5): documents in which an item occurs go;
4. mixing to target weights (8): documents are drawn by calibrated
   probabilities, those of cells to be scaled up as often as that takes;
5. sharding (4): what is left is dealt to shards.

A stage is ``function(spark, docs, sf_dir) -> DataFrame``. All but the last
return the columns of ``docs``. ``run`` writes each stage's result to the
shared folder and reads it again as the next one's input.

Whole results cannot be had from SQL (stages 1, 2, 3 and 5 are not SQL
expressions), so ``ORACLE_SQL`` is None and ``tests/llm/test_pipeline.py``
holds each stage against a brute-force version on its own input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyflow.llm import decontamination, jaccard_join, language_id, mixing, sharding
from tallyflow.llm.common import read, staged


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.accepted(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_per_component(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, read(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeated(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(docs)


STAGES = [
    ("language_id", languages),
    ("jaccard_join", near_copies),
    ("decontamination", benchmark),
    ("mixing", mixture),
    ("sharding", shards),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
