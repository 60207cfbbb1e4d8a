"""A corpus pipeline of five stages over ``documents``, each by one of the corpus operators.

A stage takes ``(spark, docs, sf_dir)``, works on all its predecessor kept, and returns the columns of documents; the
last adds where each document goes. ``run`` writes every stage as Parquet to the shared folder and reads it again, so
a lost executor costs a stage's tasks, not the run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starmart.llm import decontam, mixing, quality, sharding, simhash
from starmart.llm.common import DOC_COLUMNS, read
from starmart.session import stage


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier does not reject; a row without text is scored like an empty one."""
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.score(docs, model).filter("predicted = 1").select(*DOC_COLUMNS)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, with the smallest id, of each group whose fingerprints of three words link at three bits."""
    return simhash.one_of_each(docs, shingle=3, max_bits=3).select(*DOC_COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontam.clean(docs, read(spark, sf_dir, "benchmark")).select(*DOC_COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the target weights of sources, languages and topics."""
    return mixing.mix(docs).filter("kept").select(*DOC_COLUMNS)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its shard."""
    return sharding.place(docs).select(*DOC_COLUMNS, "slot", "shard_no", "shard")


STAGES = [
    ("quality classifier", good_quality),
    ("simhash near-dedup", without_near_copies),
    ("benchmark decontamination", decontaminated),
    ("mixing to target weights", mixed),
    ("sharding", sharded),
]

#: The classifier is a trained model, which SQL cannot express; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
