"""Partition a hierarchy into named clades with a remainder, check and undo it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import staged
from .hierarchy import absorb, closure, nearest, roots

MISC = "__misc__"

# The named clades, each with the clade that it is cut out of.
CLADES = {
    "Archaea": "", "Bacteria": "", "Eukaryota": "", "Viruses": "", "Archaeplastida": "Eukaryota", "Fungi": "Eukaryota",
    "Haptophyta": "Eukaryota", "Metazoa": "Eukaryota", "SAR": "Eukaryota", "Glaucophyta": "Archaeplastida",
    "Rhodophyta": "Archaeplastida", "Chloroplastida": "Archaeplastida", "Annelida": "Metazoa", "Arthropoda": "Metazoa",
    "Bryozoa": "Metazoa", "Chordata": "Metazoa", "Cnidaria": "Metazoa", "Ctenophora": "Metazoa", "Mollusca": "Metazoa",
    "Nematoda": "Metazoa", "Platyhelminthes": "Metazoa", "Porifera": "Metazoa", "Arachnida": "Arthropoda",
    "Malacostraca": "Arthropoda", "Insecta": "Arthropoda", "Diptera": "Insecta", "Coleoptera": "Insecta",
    "Lepidoptera": "Insecta", "Hymenoptera": "Insecta",
}


def clade_table(spark: SparkSession, clades: dict[str, str] = CLADES) -> DataFrame:
    """name, parent, fragment (path), is_terminal, level, postorder."""
    def path(n: str) -> str:
        return f"{path(clades[n])}/{n}" if clades.get(n) else n

    inner = set(clades.values())
    rows = [(n, p or None, path(n), n not in inner, path(n).count("/")) for n, p in clades.items()]
    order = {n: i for i, (n, *_) in enumerate(sorted(rows, key=lambda r: (-r[4], r[2])))}
    return spark.createDataFrame([(*r, order[r[0]]) for r in rows], "name string, parent string, fragment string, is_terminal boolean, level int, postorder int")


def assign(taxa: DataFrame, clade_roots: DataFrame) -> DataFrame:
    """``taxa`` with ``fragment``: that of the nearest root of ``clade_roots`` (uid, fragment) at or above, else the remainder."""
    named = clade_roots.select(F.col("uid").alias("stop"), "fragment")
    return nearest(taxa, clade_roots).join(named, "stop", "left").select(*taxa.columns, F.coalesce("fragment", F.lit(MISC)).alias("fragment"))


def assign_synonyms(synonyms: DataFrame, assigned: DataFrame) -> DataFrame:
    """Synonyms go where their accepted taxon is; those without one are left out."""
    return synonyms.join(assigned.select("uid", "fragment"), "uid")


def move_subtree(taxa: DataFrame, assigned: DataFrame, top: DataFrame, to: str) -> DataFrame:
    inside = absorb(taxa, top).filter("stop is not null").select("uid", F.lit(to).alias("moved"))
    return assigned.join(inside, "uid", "left").withColumn("fragment", F.coalesce("moved", "fragment")).drop("moved")


def moved_roots(assigned: DataFrame, top: DataFrame, to: str) -> DataFrame:
    """uid, fragment, moved_to: the tops of moved subtrees with the fragments that they leave."""
    return assigned.join(top, "uid", "left_semi").filter(F.col("fragment") != to).select("uid", "fragment", F.lit(to).alias("moved_to"))


def validity(assigned: DataFrame, synonyms: DataFrame, clade_roots: DataFrame) -> DataFrame:
    """check_name, n_violations: what a sound partition has none of."""
    up = assigned.select(F.col("uid").alias("par_id"), F.col("fragment").alias("par_fragment"))
    inner = assigned.join(roots(assigned), "uid", "left_anti")
    starts = clade_roots.select("uid")
    strayed = inner.join(up, "par_id").filter("fragment <> par_fragment").join(starts, "uid", "left_anti")
    checks = {
        "duplicate_rows": assigned.groupBy("uid").count().filter("count > 1"),
        "root_without_row": starts.join(assigned, "uid", "left_anti"),
        "synonym_without_row": synonyms.join(assigned, "uid", "left_anti"),
        "unmarked_border": strayed,
        "without_fragment": assigned.filter("fragment is null"),
    }
    out = None
    for name, rows in checks.items():
        one = rows.agg(F.count(F.lit(1)).alias("n_violations")).select(F.lit(name).alias("check_name"), "n_violations")
        out = one if out is None else out.unionByName(one)
    return out


def completeness(whole: DataFrame, parts: DataFrame) -> DataFrame:
    """check_name, n_violations: rows of the whole that no part has, and the reverse."""
    missing = whole.select("uid").exceptAll(parts.select("uid")).agg(F.count("uid").alias("n_violations")).select(F.lit("missing").alias("check_name"), "n_violations")
    extra = parts.select("uid").exceptAll(whole.select("uid")).agg(F.count("uid").alias("n_violations")).select(F.lit("extra").alias("check_name"), "n_violations")
    return missing.unionByName(extra)


def partition_maps(assigned_roots: DataFrame) -> DataFrame:
    """src, fragment, ids (sorted) from roots with (uid, fragment, src array)."""
    flat = assigned_roots.select("fragment", F.explode("src").alias("s")).select("fragment", "s.src", "s.id")
    return flat.groupBy("src", "fragment").agg(F.array_sort(F.collect_set("id")).alias("ids"))


def maps_of_resources(maps: DataFrame, resources: DataFrame) -> DataFrame:
    """id, src: the key of ``maps`` (src, ...) that serves each resource (id, base, aliases).

    Tried in order: its id, its aliases, those of its base, the base.  Null
    where no key serves; the caller decides whether that is an error.
    """
    up = resources.select(F.col("id").alias("base"), F.col("aliases").alias("more"))
    none = F.array().cast("array<string>")
    tries = F.concat(F.array("id"), F.coalesce("aliases", none), F.coalesce("more", none), F.array("base"))
    named = resources.join(up, "base", "left").select("id", F.posexplode(tries).alias("place", "src"))
    found = named.join(maps.select("src").distinct(), "src").groupBy("id").agg(F.min_by("src", "place").alias("src"))
    return resources.select("id").join(found, "id", "left")


def merge_lists(*lists: DataFrame) -> DataFrame:
    """Partition lists as one: rows of one fragment come together, repeated ones stay."""
    return reduce(DataFrame.unionByName, lists)


def fill_empty_ancestors(maps: DataFrame, clades: DataFrame) -> DataFrame:
    """name, ids: a clade without ids of its own has the union of the nearest clades below that have some."""
    tree = clades.select(F.col("name").alias("uid"), F.col("parent").alias("par_id"))
    own = maps.select(F.col("fragment").alias("des"), "ids")
    pairs = closure(tree)
    filled = own.select(F.col("des").alias("uid"))
    # a clade's ids reach an ancestor unless a clade with ids stands between
    between = pairs.filter("dist > 0").join(filled.withColumnRenamed("uid", "anc"), "anc", "left_semi").groupBy("des").agg(F.min("dist").alias("stop"))
    reach = pairs.join(own, "des").join(between, "des", "left").filter("dist = 0 or stop is null or dist < stop")
    return reach.groupBy(F.col("anc").alias("name")).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("ids"))


def slice_to_root(assigned: DataFrame, fragment: str, ancestors: list[str]) -> DataFrame:
    """A clade's own rows and the remainders of the levels above it."""
    uncles = [MISC if not a else f"{a}/{MISC}" for a in ancestors]
    return assigned.filter(F.col("fragment").isin(fragment, *uncles))


def deseparate(assigned: DataFrame, parents: DataFrame) -> DataFrame:
    """Moves each row of a fragment in ``parents`` (fragment, parent_fragment) up; rows already there stay once."""
    up = assigned.join(parents, "fragment", "left").withColumn("fragment", F.coalesce("parent_fragment", "fragment")).drop("parent_fragment")
    return up.dropDuplicates(["uid", "fragment"])


def deseparate_with_synonyms(assigned: DataFrame, synonyms: DataFrame, parents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same of taxa and their synonyms (uid, name, ..., fragment): both move up, equal rows are one."""
    up = synonyms.join(parents, "fragment", "left").withColumn("fragment", F.coalesce("parent_fragment", "fragment")).select(synonyms.columns).distinct()
    return deseparate(assigned, parents), up


def append_absent(target: DataFrame, rows: DataFrame) -> DataFrame:
    """``target`` and the rows that it has not."""
    return target.unionByName(rows.join(target, [*target.columns], "left_anti"))


def separated_children(assigned: DataFrame) -> DataFrame:
    """parent_fragment, child_uid, child_fragment: taxa whose parent lies in another fragment."""
    up = assigned.select(F.col("uid").alias("par_id"), F.col("fragment").alias("parent_fragment"))
    return assigned.join(up, "par_id").filter("fragment <> parent_fragment").select("parent_fragment", F.col("uid").alias("child_uid"), F.col("fragment").alias("child_fragment"))


def accumulated_roots(assigned: DataFrame, tree: DataFrame) -> DataFrame:
    """fragment, uid, par_id, source, passed: the roots of separated fragments as they roll up to the partitioned ancestors.

    ``tree`` has (fragment, parent, partitioned).  A root of a partitioned
    fragment, a taxon whose parent is not in it, is handed to the nearest
    partitioned fragment above; it stays there if that holds its parent, and
    else is passed on (``passed``) to the next one, up to the top.  So a
    fragment gets roots from all levels below, also over fragments that are not
    partitioned.  Rows of fragments that ``tree`` lacks are left out; a root
    without a parent is passed all the way.
    """
    nodes = tree.select(F.col("fragment").alias("uid"), F.col("parent").alias("par_id"), "partitioned")
    kept = nodes.filter("partitioned").select("uid")
    near = absorb(nodes.select("uid", "par_id"), kept).select(F.col("uid").alias("par_id"), "stop")
    borders = staged(nodes.filter("partitioned").join(near, "par_id", "left").select("uid", F.col("stop").alias("par_id")))
    above = staged(closure(borders).select(F.col("anc").alias("over"), F.col("des").alias("source"), "dist"))  # fragments, not taxa
    where = assigned.select(F.col("uid").alias("par_id"), F.col("fragment").alias("home"))
    roots = assigned.join(where, "par_id", "left").filter("home is null or home <> fragment").select("uid", "par_id", F.col("fragment").alias("source"), "home")
    home = roots.join(above.select("source", F.col("over").alias("home"), F.col("dist").alias("at")), ["source", "home"], "left")
    up = home.join(above.filter("dist > 0"), "source").filter("at is null or dist <= at")
    return up.select(F.col("over").alias("fragment"), "uid", "par_id", "source", F.coalesce(F.col("dist") < F.col("at"), F.lit(True)).alias("passed"))


def paths_of_names(assigned: DataFrame) -> DataFrame:
    """name, fragments (sorted): where each name occurs."""
    return assigned.filter("name is not null").groupBy("name").agg(F.array_sort(F.collect_set("fragment")).alias("fragments"))


def catalog_of_names(assigned: DataFrame) -> DataFrame:
    """fragment, n_taxa, names (distinct)."""
    return assigned.groupBy("fragment").agg(F.count("uid").alias("n_taxa"), F.countDistinct("name").alias("n_names"))


def write(assigned: DataFrame, path: str) -> None:
    assigned.write.mode("overwrite").partitionBy("fragment").parquet(path)


def fragments(spark: SparkSession, path: str) -> DataFrame:
    """fragment: the partitions that ``write`` left at the path (none, if nothing is there)."""
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = top.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.exists(top) and any("=" in f.getPath().getName() for f in files.listStatus(top))
    return spark.read.parquet(path).select(F.col("fragment").cast("string")).distinct() if found else spark.createDataFrame([], "fragment string")


def exists(spark: SparkSession, path: str, fragment: str) -> bool:
    return not fragments(spark, path).filter(F.col("fragment") == fragment).isEmpty()


def clean(spark: SparkSession, path: str, fragment: str | None = None) -> None:
    """Deletes one written fragment, or all that was written; what is not there is no error."""
    name = "" if fragment is None else "/fragment=" + spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(fragment)
    at = spark._jvm.org.apache.hadoop.fs.Path(path + name)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def staged_assignment(taxa: DataFrame, clade_roots: DataFrame) -> DataFrame:
    return staged(assign(taxa, clade_roots))
