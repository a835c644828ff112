"""The corpus pipeline: five training-data operators in a row.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's rows to the shared folder and reads them again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from syntenia.llm import common, decision_list, decontaminate, jaccard_join, mixing, shards


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned decision list keeps."""
    return decision_list.quality_filter(docs, common.table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return jaccard_join.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontaminate.clean_documents(docs, common.table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as it was taken."""
    return mixing.mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document of the mix stands in the committed shards."""
    return shards.sharded(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing_stage),
    ("sharding", sharding),
]

#: SQL can't express the learned rules, the latent search and the shard names; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = common.Scratch(spark)
    docs = common.table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        docs = scratch.write(out, name)
    return docs
