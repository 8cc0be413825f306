"""Corpus pipeline: quality, near copies, benchmark leaks, source mix, shards.

Each stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept, and returns a DataFrame;
all but the last return the columns of ``documents``.  Results are written as Parquet in the shared folder
(spark.checkpoint.dir) and read again as the next stage's documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from trolley.llm.decontam import clean_documents
from trolley.llm.jaccard_join import one_of_each_group
from trolley.llm.mixing import mixed_documents
from trolley.llm.quality import accepted
from trolley.llm.sharding import shard
from trolley.session import work_dir

SHARDS = 40


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier accepts (score >= 0.3)."""
    return accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more): the smallest doc_id."""
    return one_of_each_group(docs, k=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the source mix: file after file, row after row."""
    return mixed_documents(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of each document, sizes near equal, equal texts together; slots follow the mixed order."""
    return shard(docs, shards=SHARDS, as_stored=True)


STAGES = [("quality classifier", quality), ("n-gram Jaccard join", near_copies), ("benchmark decontamination", decontaminate),
          ("mixing sources to target weights", mix_sources), ("sharding", assign_shards)]

#: Compression, BM25 retrieval and similarity joins over shingles are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = f"{work_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex[:12]}"
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{root}/{k}")
        docs = spark.read.schema(out.schema).parquet(f"{root}/{k}")
    return docs
