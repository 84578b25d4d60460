"""Canonical schemas, the rank table and scalar expressions over taxa."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TAXA = "uid string, par_id string, name string, rank string, flags array<string>, src array<struct<src:string,id:string>>, uniqname string"
SYNONYMS = "uid string, name string, syn_type string, syn_id string"
FORWARDS = "old_id string, new_id string"

# Rank -> sorting number.
RANKS = {
    "superkingdom": 280, "kingdom": 270, "subkingdom": 260, "superphylum": 250, "phylum": 240, "subphylum": 230,
    "superclass": 220, "class": 210, "subclass": 200, "infraclass": 190, "cohort": 180, "superorder": 170, "order": 160,
    "suborder": 150, "infraorder": 140, "parvorder": 130, "superfamily": 120, "family": 110, "subfamily": 100, "tribe": 90,
    "subtribe": 80, "genus": 70, "subgenus": 60, "species group": 50, "species subgroup": 40, "species": 30, "subspecies": 20,
    "infraspecies": 15, "varietas": 10, "forma": 0,
}
GENUS, SPECIES = RANKS["genus"], RANKS["species"]

# The closed set of synonym types, and the two sets that readers may leave out.
SYNONYM_TYPES = (
    "acronym", "ambiguous synonym", "authority", "basionym", "blast name", "common name", "equivalent name", "genbank common name",
    "genbank synonym", "homotypic synonym", "heterotypic synonym", "includes", "misapplied name", "invalid", "misnomer",
    "misspelling", "orthographia", "proparte synonym", "synonym", "type material", "unavailable",
)
IGNORED_SYNONYM_TYPES = ("acronym", "authority", "blast name", "common name", "genbank common name", "genbank synonym", "type material")
COMMON_NAME_TYPES = ("common name", "genbank common name")

# Source prefixes that do not count as stable, ranks that never separate, ranks based on specimens.
UNSTABLE_SOURCES = ("h2007", "study713", "https", "http")
NON_SEPARATING_RANKS = ("forma", "no rank - terminal", "species", "species group", "species subgroup", "varietas", "variety")
SPECIMEN_RANKS = ("species", "subspecies", "infraspecies")


def uid_number(uid: Column) -> Column:
    """The id as a number, null where it is not one."""
    return uid.try_cast("bigint")


def parse_sources(raw: Column) -> Column:
    """``a:1,b:2`` -> array of (src, id); an element without exactly one colon raises."""
    parts = F.filter(F.transform(F.split(raw, ","), lambda x: F.trim(x)), lambda x: x != "")
    bad = F.exists(parts, lambda x: F.size(F.split(x, ":")) != 2)
    good = F.transform(parts, lambda x: F.struct(F.split_part(x, F.lit(":"), F.lit(1)).alias("src"), F.split_part(x, F.lit(":"), F.lit(2)).alias("id")))
    return F.when(bad, F.raise_error(F.concat(F.lit("malformed source: "), raw)).cast("array<struct<src:string,id:string>>")).otherwise(good)


def format_sources(src: Column) -> Column:
    """array of (src, id) -> the sorted ``src:id`` list, repeats left out."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(src, lambda x: F.concat_ws(":", x["src"], x["id"])))), ",")


def stable_sources(src: Column) -> Column:
    keys = F.array_distinct(F.transform(src, lambda x: x["src"]))
    return F.array_sort(F.filter(keys, lambda k: ~k.startswith("additions") & ~k.isin(*UNSTABLE_SOURCES)))


def parse_flags(raw: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(F.split(F.coalesce(raw, F.lit("")), ","), lambda x: x != "")))


def add_flag(flags: Column, flag: str) -> Column:
    return F.array_sort(F.array_union(F.coalesce(flags, F.array().cast("array<string>")), F.array(F.lit(flag))))


def format_flags(flags: Column) -> Column:
    return F.array_join(F.array_sort(flags), ",")


def display_name(name: Column, uniqname: Column) -> Column:
    return F.coalesce(F.nullif(uniqname, F.lit("")), name)


def rank_number(rank: Column) -> Column:
    """Sorting number of a rank; null for no rank and for ranks outside the table."""
    out = F.lit(None).cast("int")
    pairs = F.create_map(*[F.lit(x) for kv in RANKS.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, rank), out)


def escape_odd(s: Column) -> Column:
    return F.regexp_replace(s, "[^-a-zA-Z0-9._]", "_")


def is_specimen_based(rank: Column) -> Column:
    return rank.isin(*SPECIMEN_RANKS)


def iso_time(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss")


def terse(uid: Column, name: Column, rank: Column) -> Column:
    return F.format_string("%s %s (%s)", rank, name, uid)


def taxon_json(df: DataFrame) -> DataFrame:
    """uid and the sparse JSON of each row: nulls, empty strings and empty arrays are left out."""
    def sparse(name: str, kind: str) -> Column:
        c = F.col(name)
        if kind.startswith("array"):
            return F.when(F.size(c) > 0, c).alias(name)
        return F.nullif(c, F.lit("")).alias(name) if kind == "string" else c.alias(name)

    return df.select("uid", F.to_json(F.struct(*[sparse(n, k) for n, k in df.dtypes])).alias("json"))


def rank_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(RANKS.items()), "rank string, rank_num int")
