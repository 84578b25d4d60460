"""A typed graph of scientific names: one table a node class, as rows (class, id, context, name)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import authority, parsed, semanticizable
from ..model import SPECIES, is_specimen_based, rank_number
from .hierarchy import absorb

# Flags that a concept may claim.
KNOWN_FLAGS = ("extinct", "hybrid", "incertae_sedis", "undescribed", "unclassified", "major_rank_conflict", "barren")


def concepts(taxa: DataFrame, resource: str = "res") -> DataFrame:
    """uid, id, rank, name parts of the taxa that enter the graph; what lies below a skipped taxon is skipped."""
    flags = F.col("flags") if "flags" in taxa.columns else F.array().cast("array<string>")
    bad = taxa.filter(~semanticizable(F.col("name"), flags)).select("uid")
    kept = taxa.join(absorb(taxa, bad).filter("stop is null").select("uid"), "uid", "left_semi")
    p = parsed(F.col("name"))
    return kept.select("uid", F.concat_ws(":", F.lit(resource), F.lit("tc"), "uid").alias("id"), "rank", "name", p.alias("p"))


def minted(nodes: DataFrame) -> DataFrame:
    """``nodes`` (base, uid, ...) with ``id``: the base, and ``:vN`` for the second and later by uid."""
    n = F.row_number().over(Window.partitionBy("base").orderBy("uid"))
    return nodes.withColumn("n", n).withColumn("id", F.when(F.col("n") == 1, F.col("base")).otherwise(F.concat("base", F.lit(":v"), F.col("n").cast("string")))).drop("n")


def name_nodes(found: DataFrame) -> DataFrame:
    """class, context, name: the distinct genus, species and infraspecies group and higher names; epithets within their genus."""
    node = lambda kind, context, name: F.struct(F.lit(kind).alias("class"), context.alias("context"), name.alias("name"))
    none, p = F.lit(None).cast("string"), F.col("p")
    rows = F.array(
        node("genus_group", none, p["genus"]), node("species_group", p["genus"], p["sp_epithet"]),
        node("infraspecies_group", F.concat_ws(" ", p["genus"], p["sp_epithet"]), p["infra_epithet"]),
        node("higher_group", none, p["higher_group_name"]), node("combination", none, p["combination"]),
        node("specimen_code", p["genus"], p["specimen_code"]), node("verbatim", none, F.col("name")),
    )
    return found.select(F.explode(rows).alias("x")).select("x.*").filter("name is not null").distinct()


def edges(found: DataFrame, predicates: tuple[str, ...] | None = None) -> DataFrame:
    """subject, predicate, object (sparse): the parts of each concept; with ``predicates`` these only, so that names are not parsed for parts that nobody asks for."""
    p = F.col("p")
    parts = [(k, p[k].cast("string")) for k in ("genus", "subgenus", "sp_epithet", "infra_epithet", "higher_group_name", "specimen_code", "combination")]
    pairs = [(k, v) for k, v in [*parts, ("rank", F.col("rank")), ("verbatim", F.col("name"))] if predicates is None or k in predicates]
    rows = F.array(*[F.struct(F.lit(k).alias("predicate"), v.alias("object")) for k, v in pairs])
    return found.select(F.col("id").alias("subject"), F.explode(rows).alias("x")).select("subject", "x.*").filter("object is not null")


def synonym_kinds(taxa: DataFrame, syn: DataFrame) -> DataFrame:
    """uid, name, syn_id, kind: what each synonym becomes, by the taxon's rank and the synonym's apparent rank."""
    num = taxa.select("uid", rank_number(F.col("rank")).alias("num"))
    rows = syn.join(num, "uid").withColumn("p", parsed(F.col("name")))
    seen = F.col("p.apparent_rank")
    low, high = F.col("num") <= SPECIES, F.col("num") > SPECIES
    kind = (
        F.when(F.col("syn_type") == "type material", "type_material")
        .when(F.col("syn_type") == "authority", "authority")
        .when(F.col("p.hybrid"), "hybrid")
        .when(high & (seen == "clade"), "uninomial")
        .when(low & (seen == "species") & (F.col("num") == SPECIES), "binomial")
        .when(low & (seen == "infraspecies") & (F.col("num") < SPECIES), "trinomial")
        .when(low & (seen == "species"), "former_species")
        .when(low & (seen == "infraspecies"), "former_subspecies")
        .otherwise("problematic")
    )
    n = F.row_number().over(Window.partitionBy("uid").orderBy("name", "syn_type")) - 1
    return rows.select("uid", "name", "syn_type", F.concat("uid", F.lit(":syn"), n.cast("string")).alias("syn_node"), kind.alias("kind"))


def authorities(syn: DataFrame) -> DataFrame:
    """authors, year, n, uids, n_basionyms of the authority synonyms, one node for each (authors, year); in brackets they are a basionym's."""
    rows = syn.filter("syn_type = 'authority'").select("uid", authority(F.col("name")).alias("a")).select("uid", "a.*")
    return rows.groupBy("authors", "year").agg(F.count("uid").alias("n"), F.array_sort(F.collect_set("uid")).alias("uids"), F.count_if("is_basionym").alias("n_basionyms"))


def former_ranks(kinds: DataFrame) -> DataFrame:
    """uid, former (sorted ranks that its synonyms show it had), problematic (sorted names of synonyms of no use), from ``synonym_kinds``."""
    rank = F.when(F.col("kind") == "former_species", "species").when(F.col("kind") == "former_subspecies", "subspecies")
    told = kinds.groupBy("uid").agg(F.array_sort(F.collect_set(rank)).alias("former"), F.array_sort(F.collect_set(F.when(F.col("kind") == "problematic", F.col("name")))).alias("problematic"))
    return told.filter((F.size("former") > 0) | (F.size("problematic") > 0))


def split_homonyms(rows: DataFrame) -> DataFrame:
    """node, epithet, authority from (epithet, authority): an epithet with several authorities becomes a node for each."""
    n = F.count("authority").over(Window.partitionBy("epithet"))
    own = rows.select("epithet", "authority").distinct().withColumn("n", n)
    return own.select(F.when(F.col("n") > 1, F.concat_ws("|", "epithet", "authority")).otherwise(F.col("epithet")).alias("node"), "epithet", "authority")


def impute_types(taxa: DataFrame, syn: DataFrame) -> DataFrame:
    """uid, type_id of the specimen-based, described taxa that lack type material and are no hybrids."""
    p = parsed(F.col("name"))
    own = taxa.filter(is_specimen_based(F.col("rank"))).select("uid", p.alias("p")).filter("not p.hybrid and not p.undescribed")
    return own.join(syn.filter("syn_type = 'type material'").select("uid"), "uid", "left_anti").select("uid", F.concat("uid", F.lit(":type")).alias("type_id"))


def valid_name_map(found: DataFrame) -> DataFrame:
    """name, id: the last concept (by id) of each valid name."""
    return found.groupBy("name").agg(F.max("id").alias("id"))


def canonical_names(found: DataFrame) -> DataFrame:
    """id, canonical, terminal: the combination, else the clade's name; the most terminal epithet."""
    p = F.col("p")
    return found.select("id", F.coalesce(p["combination"], p["clade_name"], F.col("name")).alias("canonical"), F.coalesce(p["infra_epithet"], p["sp_epithet"], p["clade_name"]).alias("terminal"))


def canonical_name_map(found: DataFrame) -> DataFrame:
    """name, id: the last concept (by id) of each canonical name."""
    return canonical_names(found).groupBy(F.col("canonical").alias("name")).agg(F.max("id").alias("id"))


def specimen_synonyms(taxa: DataFrame, syn: DataFrame) -> DataFrame:
    """uid, names: the sorted synonyms of taxa based on specimens, without authorities and type material."""
    own = taxa.filter(is_specimen_based(F.col("rank"))).select("uid")
    names = syn.filter(~F.col("syn_type").isin("authority", "type material")).join(own, "uid", "left_semi")
    return names.groupBy("uid").agg(F.array_sort(F.collect_set("name")).alias("names"))


def claim_flags(rows: DataFrame, known: tuple[str, ...] = KNOWN_FLAGS) -> DataFrame:
    """Rows (id, flags) with checked flags; one that is not known raises."""
    bad = F.array_except("flags", F.array(*map(F.lit, known)))
    return rows.withColumn("flags", F.when(F.size(bad) > 0, F.raise_error(F.concat(F.lit("unknown flag: "), F.array_join(bad, ","))).cast("array<string>")).otherwise(F.array_sort("flags")))


def graph_json(found: DataFrame) -> DataFrame:
    """class, json: the nodes of a class by id, one row a node."""
    return found.select(F.lit("taxon_concept").alias("class"), F.to_json(F.struct("id", "rank", "name", "p")).alias("json"))
