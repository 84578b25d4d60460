"""From an unpacked resource to taxa, synonyms and forwards: one call for every format.

Each normaliser takes (spark, path) and returns a ``Normalized``; path is what
the archive was unpacked to, a folder or a file as the format has it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import model
from . import readers


@dataclass(frozen=True)
class Normalized:
    """taxa (uid, par_id, name, rank, ...), synonyms (uid, name, syn_type, syn_id), forwards (old_id, new_id)."""

    taxa: DataFrame
    synonyms: DataFrame
    forwards: DataFrame


Normalizer = Callable[[SparkSession, str], Normalized]


def _whole(spark: SparkSession, taxa: DataFrame, synonyms: DataFrame | None = None, forwards: DataFrame | None = None) -> Normalized:
    if synonyms is None:
        synonyms = spark.createDataFrame([], model.SYNONYMS)
    have = [F.col(c).cast("string").alias(c) if c in synonyms.columns else F.lit(None).cast("string").alias(c) for c in ("uid", "name", "syn_type", "syn_id")]
    return Normalized(taxa, synonyms.select(*have), spark.createDataFrame([], model.FORWARDS) if forwards is None else forwards)


def _interim(spark: SparkSession, path: str) -> Normalized:
    forwards = f"{path}/forwards.tsv"
    told = spark.read.option("sep", "\t").option("header", True).csv(forwards) if readers.there(spark, forwards) else None
    if told is not None:
        told = told.toDF("old_id", "new_id")
    return _whole(spark, readers.taxonomy(spark, f"{path}/taxonomy.tsv"), readers.synonyms(spark, f"{path}/synonyms.tsv"), told)


def _ncbi(spark: SparkSession, path: str) -> Normalized:
    taxa, syn, forwards = readers.ncbi(spark, path)
    return _whole(spark, *readers.ncbi_clean(taxa, syn), forwards)


def _darwin_core(spark: SparkSession, path: str) -> Normalized:
    manifest = spark.read.text(f"{path}/meta.xml", wholetext=True).first()["value"]  # one small file
    return _whole(spark, *readers.darwin_core(spark, path, manifest))


def _wikidata(spark: SparkSession, path: str) -> Normalized:
    return _whole(spark, readers.wikidata_dump_taxa(spark, path))


BY_SCHEMA: dict[str, Normalizer] = {
    "interim": _interim,
    "ncbi": _ncbi,
    "darwin core": _darwin_core,
    "irmng": lambda spark, path: _whole(spark, *readers.irmng(spark, path)),
    "silva taxmap": lambda spark, path: _whole(spark, readers.silva(spark, path)),
    "plant list": lambda spark, path: _whole(spark, readers.plant_list(spark, path)[0]),
    "newick": lambda spark, path: _whole(spark, readers.newick(spark, path)),
    "col": lambda spark, path: _whole(spark, *readers.col_rows(spark, path)),
    "wikidata": _wikidata,
}

#: Sources with a format of their own, by the id at the base of a resource's chain; all others go by their schema.
BY_SOURCE = {"ncbi": "ncbi", "gbif": "darwin core", "irmng": "irmng", "silva": "silva taxmap", "plantlist": "plant list", "col": "col", "wikidata": "wikidata", "ott": "interim"}


def schema_of(base_id: str, schema: str | None) -> str:
    """The format of a resource: its source's own if that has one, else what its record says; an unknown one raises."""
    found = BY_SOURCE.get(base_id, schema)
    if found not in BY_SCHEMA:
        raise ValueError(f"no normaliser for source {base_id}, schema {schema}")
    return found


def normalize(spark: SparkSession, schema: str, path: str) -> Normalized:
    if schema not in BY_SCHEMA:
        raise ValueError(f"no normaliser for schema {schema}")
    return BY_SCHEMA[schema](spark, path.rstrip("/"))
