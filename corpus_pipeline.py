"""The corpus pipeline: toxicity, near duplicates, benchmark passages, source mixing, sharding."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from driftwarden.common import shared_folder
from driftwarden.llm.common import read
from driftwarden.llm.decontamination import without_benchmark
from driftwarden.llm.mixing import mix
from driftwarden.llm.near import distinct_documents
from driftwarden.llm.sharding import shard_documents
from driftwarden.llm.toxicity import without_toxic

SHARDS = 40


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents called toxic go; all others stay, NULL and empty texts among them."""
    return without_toxic(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by a shingle similarity of 0.8 or more, the document with the smallest id stays."""
    return distinct_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold half a test item or more go."""
    return without_benchmark(docs, read(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: copies are rows of their own."""
    return mix(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A shard and a slot for every row that is left."""
    return shard_documents(docs, SHARDS)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: Several stages are iterative or learnt; tests compare them with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written below the shared folder and read again by the next."""
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    name, stage = STAGES[-1]
    return stage(spark, docs, sf_dir)
