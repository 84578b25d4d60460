"""The driver's star schema seen as taxonomies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The same text runs in Spark SQL and in the oracle.
TX = """tx AS (
  SELECT 'life' AS uid, CAST(NULL AS VARCHAR(9)) AS par_id, 'life' AS name, 'no rank' AS rank
  UNION ALL SELECT concat('r', CAST(r_regionkey AS VARCHAR(20))), 'life', r_name, 'kingdom' FROM region
  UNION ALL SELECT concat('n', CAST(n_nationkey AS VARCHAR(20))), concat('r', CAST(n_regionkey AS VARCHAR(20))), n_name, 'phylum' FROM nation
  UNION ALL SELECT concat('c', CAST(c_custkey AS VARCHAR(20))), concat('n', CAST(c_nationkey AS VARCHAR(20))), c_name, 'genus' FROM customer
  UNION ALL SELECT concat('o', CAST(o_orderkey AS VARCHAR(20))), concat('c', CAST(o_custkey AS VARCHAR(20))), concat('Order#', CAST(o_orderkey AS VARCHAR(20))), 'species' FROM orders)"""
SY = """sy AS (
  SELECT DISTINCT concat('o', CAST(l_orderkey AS VARCHAR(20))) AS uid, p_name AS name,
    CASE l_returnflag WHEN 'A' THEN 'synonym' WHEN 'R' THEN 'misspelling' ELSE 'authority' END AS syn_type
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""
# a later release: orders dropped, moved, renamed and added
TX2 = """n_cust AS (SELECT count(*) AS n FROM customer),
tx2 AS (
  SELECT * FROM tx WHERE rank <> 'species'
  UNION ALL SELECT concat('o', CAST(o_orderkey AS VARCHAR(20))),
    concat('c', CAST(CASE WHEN o_orderkey % 89 = 0 THEN o_custkey % n + 1 ELSE o_custkey END AS VARCHAR(20))),
    concat('Order#', CAST(o_orderkey AS VARCHAR(20)), CASE WHEN o_orderkey % 83 = 0 THEN ' novus' ELSE '' END), 'species'
  FROM orders, n_cust WHERE o_orderkey % 97 <> 0
  UNION ALL SELECT concat('o', CAST(o_orderkey + 1000000000 AS VARCHAR(20))), concat('c', CAST(o_custkey AS VARCHAR(20))),
    concat('Order#', CAST(o_orderkey + 1000000000 AS VARCHAR(20))), 'species' FROM orders WHERE o_orderkey % 101 = 0)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _view(spark: SparkSession, sf_dir: str, text: str, name: str, tables: tuple[str, ...]) -> DataFrame:
    frames = {t: table(spark, sf_dir, t) for t in tables}
    for t in tables:  # names of our own, so that a caller's views stay as they are
        text = text.replace(f" {t} ", f" {{{t}}} ").replace(f" {t}\n", f" {{{t}}}\n").replace(f" {t})", f" {{{t}}})").replace(f" {t},", f" {{{t}}},")
    return spark.sql(f"WITH {text} SELECT * FROM {name}", **frames)


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, TX, "tx", ("region", "nation", "customer", "orders"))


def tx2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, f"{TX}, {TX2}", "tx2", ("region", "nation", "customer", "orders"))


def sy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, SY, "sy", ("lineitem", "part"))


def region_roots(taxa: DataFrame) -> DataFrame:
    """The kingdoms as clade roots, and the phyla of the first kingdom cut out of it."""
    named = F.when(F.col("rank") == "kingdom", F.col("name")).otherwise(F.concat(F.lit("AFRICA/"), F.col("name")))
    return taxa.filter((F.col("rank") == "kingdom") | ((F.col("rank") == "phylum") & (F.col("par_id") == "r0"))).select("uid", named.alias("fragment"))
