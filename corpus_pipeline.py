"""The corpus pipeline: from documents to shards, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it works on all
that its predecessor kept, and all but the last return the columns of
documents. ``run`` writes each stage's rows to the shared folder and reads
them again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quern.llm.common import written
from quern.llm.decontaminate import decontaminated
from quern.llm.mixing import mixed
from quern.llm.quality import accepted
from quern.llm.sharding import sharded
from quern.llm.simhash import near_deduplicated

SHARDS = 24


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model of trusted text accepts."""
    return accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_deduplicated(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a word in 20 is the benchmark's."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of sources takes them."""
    return mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and their slot in it."""
    return sharded(docs, shards=SHARDS)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mix), ("shard", shard)]

#: SQL can express neither the language model nor the fingerprints.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the table documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{name}")
    return docs
