"""A training-corpus pipeline of five stages over the table ``documents``.

Each stage takes what its predecessor kept, written as Parquet in the shared checkpoint folder,
so a lost executor costs one stage's tasks at most and no stage repeats another's work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from haulmetrics.llm import decontamination, language_id, mixing, sharding, simhash
from haulmetrics.llm.queries import LEVELS, domain, target_weights
from haulmetrics.llm.shared import documents, written

# Epochs that the mixture may take of one source.
MAX_EPOCHS = 4
SHARDS = 64


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a predicted language, by a model learnt from the labelled ones; null, blank or letterless ones go.

    Long texts are read whole, repeated rows share their fate; of an empty or unlabelled table nothing is left.
    """
    return language_id.keep_identified(docs, language_id.train(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every group of near copies: fingerprints of three-word shingles, at most three bits apart.

    Texts without a word are one group; rows without an id stay; an empty table stays empty.
    """
    return simhash.keep_one_per_component(docs, words=3, radius=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark; null, empty and blank texts stay, equal texts share their fate."""
    return decontamination.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as there are, shared by the target weights; scarce sources repeat, rich ones are cut.

    A null language or source is one of its own; texts without a token follow their place in their leaf's order.
    """
    tree = docs.withColumn("domain", domain())
    return mixing.draw(tree, LEVELS, target_weights(), max_epochs=MAX_EPOCHS).drop("domain")


def place_on_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture with the shard of every document and its order there; null texts are empty, copies of a row stay together."""
    return sharding.assign_shards(docs, SHARDS)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", place_on_shards),
]

# Naive Bayes and SimHash components have no SQL form; a brute-force version is in tests/llm.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
