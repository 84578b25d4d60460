"""The registered queries of the operators in this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, jaccard, license_scan, line_dedup, merkle, mixing, quality, sharding, simhash, target_encoding, token_counts, toxicity, url_rules
from .workspace import small_batches

URL_RULES: list[url_rules.Rule] = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_hash_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_read(spark, sf_dir, "documents"), sharding.Topology.balanced(2, 2, 2))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.fingerprints(_read(spark, sf_dir, "documents"))


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(_read(spark, sf_dir, "pages"), url_rules.rules_frame(spark, URL_RULES))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_components(_read(spark, sf_dir, "documents"), jaccard.Likeness(words=3, percent=90))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


#: Where the public vocabulary files are; only the driver reads them.
TOKENIZERS = "/opt/tokenizers"


def op7_token_counts(spark: SparkSession, sf_dir: str, vocabulary: str = f"{TOKENIZERS}/byte_bpe_50k.tiktoken") -> DataFrame:
    docs = token_counts.sample_edits(_read(spark, sf_dir, "documents"))
    return token_counts.count_tokens(docs, token_counts.read_ranks(vocabulary))


#: Shares of tokens that the mix should have, by language.
MIX = {"en": 0.5, "fr": 0.2, "de": 0.15, "es": 0.15}


def labelled_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The labelled table of the mix: the language of each document that has a row in ``labels``."""
    return docs.select("doc_id", docs["lang"].alias("domain")).join(labels.select("doc_id"), "doc_id", "left_semi")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return mixing.report(docs, labelled_domains(docs, _read(spark, sf_dir, "labels")), MIX)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, lines, deleted lines, the longest shared run's power of two, and the SHA-256 of the text that is left."""
    out = line_dedup.dedup_lines(_read(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_deleted").alias("n_deleted"), F.col("__shared").alias("shared_run"),
        F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"),
    )


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = merkle.manifest(merkle.document_leaves(_read(spark, sf_dir, "documents"))).rows
    return rows.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")


def op12_target_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target_encoding.encode_sales(*[_read(spark, sf_dir, t) for t in ("sale_lines", "sales", "items", "vendors", "clients")])


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.report(_read(spark, sf_dir, "documents"))


_ALL = (
    op1_hash_tree_sharding, op2_simhash, op3_url_rules, op4_quality, op5_ngram_jaccard, op6_decontamination,
    op7_token_counts, op8_mixing, op9_toxicity, op10_line_dedup, op11_merkle,
    op12_target_encoding, op13_license_scan,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return {f.__name__: f for f in _ALL} | {"pipeline": corpus_pipeline.run}
