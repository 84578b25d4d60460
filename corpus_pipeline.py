"""A training-data pipeline: five operators in a row over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next one's docs.  All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cladeworks.llm import decontam, jaccard, mixing, quality, sharding
from cladeworks.llm.queries import MIX, labelled_domains
from cladeworks.llm.workspace import Workspace, small_batches

#: The near-duplicate stage and the quality classifier are not SQL.
ORACLE_SQL = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects."""
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves one document of each group of near duplicates (five words a shingle, a likeness of 0.8)."""
    small_batches(spark)
    return jaccard.keep_one(docs, jaccard.Likeness(words=5, percent=80))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold too much of the benchmark."""
    return decontam.clean(docs, _table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or drops documents so that the languages' tokens match their target shares."""
    return mixing.mix(docs, labelled_domains(docs, _table(spark, sf_dir, "labels")), MIX)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts the documents into eight shards."""
    return sharding.shard_documents(docs, sharding.Topology.balanced(2, 2, 2))


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_one_of_each),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents, each written to the shared folder and read again."""
    ws = Workspace(spark, "pipeline")
    docs = _table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = ws.table(stage(spark, docs, sf_dir))
    return docs
