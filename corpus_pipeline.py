"""Corpus pipeline: documents -> language ID -> near-dedup -> decontamination -> mix -> shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents. What a stage drops: texts without a language (null, no letter, or a
score below the operator's bound); all but one document of each group of near copies;
documents that contain a benchmark window. The mix then repeats or leaves out documents to
meet the sources' targets, and the last stage adds the shard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gatewatch.llm import decontaminate, language_id, mixing, sharding, simhash
from gatewatch.llm.common import materialize, read


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.known_language(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each_group(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs, read(spark, sf_dir, "labels"))


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard(docs)


STAGES = [
    ("language_id", keep_known_language),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

#: The classifier and the hash of shingles have no SQL form; tests hold the stages against
#: brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; each one's rows are written and read back by the next."""
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"pipeline_{name}")
    return docs
