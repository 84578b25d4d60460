"""Clean-ups on parent-pointer data before it is used."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..staging import staged
from .hierarchy import MAX_ROUNDS, absorb, upward


def orphans(taxa: DataFrame) -> DataFrame:
    """Taxa that name a parent which is no taxon."""
    own = taxa.select(F.col("uid").alias("par_id"))
    return taxa.filter("par_id is not null").join(own, "par_id", "left_anti")


def prune(taxa: DataFrame, ignored: DataFrame) -> DataFrame:
    """Without the ignored taxa and all below them."""
    return taxa.join(absorb(taxa, ignored).filter("stop is null").select("uid"), "uid", "left_semi")


def remove_tips(taxa: DataFrame, flagged: DataFrame) -> DataFrame:
    """Without those of the flagged taxa that are tips (one pass)."""
    tips = flagged.select("uid").join(taxa.select(F.col("par_id").alias("uid")), "uid", "left_anti")
    return taxa.join(tips, "uid", "left_anti")


def delete(taxa: DataFrame, ids: DataFrame) -> DataFrame:
    """Without the rows of ``ids``; children keep their par_id."""
    return taxa.join(ids.select("uid"), "uid", "left_anti")


def add_root(taxa: DataFrame, uid: str = "0", name: str = "life") -> DataFrame:
    """A synthetic root above all taxa without a parent."""
    spark = taxa.sparkSession
    row = spark.range(1).select(F.lit(uid).alias("uid"), F.lit(None).cast("string").alias("par_id"), F.lit(name).alias("name"), F.lit("no rank").alias("rank"))
    return taxa.withColumn("par_id", F.coalesce("par_id", F.lit(uid))).unionByName(row, allowMissingColumns=True)


def collapse(taxa: DataFrame, containers: DataFrame, flag: str = "incertae_sedis") -> DataFrame:
    """Splices container taxa out: their children go to the nearest ancestor that is none, with a flag.

    Adds ``flags`` (sorted) if there is none.  A chain of containers is crossed
    in one go.  Names with `` x `` get the flag ``hybrid``.
    """
    marks = containers.select("uid").distinct()
    if "flags" not in taxa.columns:
        taxa = taxa.withColumn("flags", F.array().cast("array<string>"))
    keep = taxa.join(marks, "uid", "left_anti")
    # the nearest non-container at or above each container
    target = absorb(taxa, keep).join(marks, "uid").select(F.col("uid").alias("par_id"), F.col("stop").alias("new_par"), F.lit(True).alias("moved"))
    out = keep.join(target, "par_id", "left")
    flags = F.when(F.col("moved"), F.array_union("flags", F.array(F.lit(flag)))).otherwise(F.col("flags"))
    flags = F.when(F.col("name").contains(" x "), F.array_union(flags, F.array(F.lit("hybrid")))).otherwise(flags)
    return out.select(
        *[F.when(F.col("moved"), F.col("new_par")).otherwise(F.col("par_id")).alias(c) if c == "par_id" else F.array_sort(flags).alias(c) if c == "flags" else c for c in keep.columns]
    )


def same_name_children(taxa: DataFrame) -> DataFrame:
    """uid, par_id, name, par_rank of taxa named like their parent."""
    up = taxa.select(F.col("uid").alias("par_id"), F.col("name").alias("par_name"), F.col("rank").alias("par_rank"))
    return taxa.join(up, "par_id").filter("name = par_name").select("uid", "par_id", "name", "par_rank")


def fix_same_names(taxa: DataFrame, synonyms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A child named like its parent: below a genus it is renamed (``<name> <name>``), else spliced out, its synonyms moving up."""
    same = staged(same_name_children(taxa))
    renamed = same.filter("par_rank = 'genus'").select("uid", F.lit(True).alias("again"))
    gone = same.filter("par_rank is null or par_rank <> 'genus'")
    kept = collapse(taxa, gone, "merged").drop("flags") if "flags" not in taxa.columns else collapse(taxa, gone, "merged")
    named = kept.join(renamed, "uid", "left").withColumn("name", F.when(F.col("again"), F.concat_ws(" ", "name", "name")).otherwise(F.col("name"))).drop("again")
    keep = taxa.join(gone, "uid", "left_anti")
    up = absorb(taxa, keep).withColumnRenamed("stop", "to")
    moved = synonyms.join(up, "uid", "left").withColumn("uid", F.coalesce("to", "uid")).drop("to")
    return named, moved


def prefix_with_parent(taxa: DataFrame, name: str = "environmental samples") -> DataFrame:
    """Taxa of that name get their parent's name in front."""
    up = taxa.select(F.col("uid").alias("par_id"), F.col("name").alias("par_name"))
    out = taxa.join(up, "par_id", "left")
    return out.withColumn("name", F.when(F.col("name") == name, F.concat_ws(" ", "par_name", "name")).otherwise(F.col("name"))).select(taxa.columns)


def resolve_chain(forwards: DataFrame) -> DataFrame:
    """old_id, new_id followed to the end; ids on a cycle end at the cycle's smallest id.

    Repeated forwards of an id follow the smallest target.
    """
    now = staged(forwards.groupBy("old_id").agg(F.min("new_id").alias("at")))
    start, n = now, None
    ends = None
    for k in range(MAX_ROUNDS):
        ahead = now.select(F.col("old_id").alias("at"), F.col("at").alias("next"))
        open_rows = now.join(ahead, "at")
        if open_rows.isEmpty():
            ends = now
            break
        n = n or start.count()
        if (1 << k) > n:
            # whoever still moves after n steps stands on a cycle
            on = now.select("at").distinct().join(start.select(F.col("old_id").alias("at")), "at", "left_semi")
            loops = staged(start.join(on.withColumnRenamed("at", "old_id"), "old_id", "left_semi"))
            low = staged(loops.select("old_id", "at", F.least("old_id", "at").alias("low")))
            step = 1
            while step <= n:
                far = low.select(F.col("old_id").alias("at"), F.col("at").alias("next"), F.col("low").alias("low2"))
                low = staged(low.join(far, "at").select("old_id", F.col("next").alias("at"), F.least("low", "low2").alias("low")))
                step *= 2
            ends = now.join(low.select(F.col("old_id").alias("at"), "low"), "at", "left").select("old_id", F.coalesce("low", "at").alias("at"))
            break
        now = staged(now.join(ahead, "at", "left").select("old_id", F.coalesce("next", "at").alias("at")))
    return ends.select("old_id", F.col("at").alias("new_id"))


def reparent_by_forwards(taxa: DataFrame, forwards: DataFrame) -> DataFrame:
    """Children of a forwarded id go to its valid id."""
    to = resolve_chain(forwards).select(F.col("old_id").alias("par_id"), "new_id")
    return taxa.join(to, "par_id", "left").withColumn("par_id", F.coalesce("new_id", "par_id")).select(taxa.columns)


def keep_with_ancestors(taxa: DataFrame, kept: DataFrame) -> DataFrame:
    """The kept taxa and all above them; what lost its parent becomes a root."""
    live = staged(upward(taxa, kept).select("uid"))
    out = taxa.join(live, "uid", "left_semi").join(live.select(F.col("uid").alias("par_id"), F.lit(True).alias("there")), "par_id", "left")
    return out.withColumn("par_id", F.when(F.col("there"), F.col("par_id"))).select(taxa.columns)


def auto_parents(taxa: DataFrame) -> DataFrame:
    """uid, par_id, name, rank of the genera and species that names ask for and no row has.

    A binomial's genus is its first word, a trinomial's species its first two.
    """
    parts = taxa.select("name", F.split("name", " ").alias("w"))
    genus = parts.filter("size(w) >= 2").select(F.col("w")[0].alias("name"), F.lit("genus").alias("rank"), F.lit(None).cast("string").alias("par_name"))
    species = parts.filter("size(w) >= 3").select(F.concat_ws(" ", F.col("w")[0], F.col("w")[1]).alias("name"), F.lit("species").alias("rank"), F.col("w")[0].alias("par_name"))
    wanted = genus.unionByName(species).distinct().join(taxa.select("name").distinct(), "name", "left_anti")
    made = lambda c: F.concat(F.lit("auto:"), c)
    return wanted.select(made(F.col("name")).alias("uid"), made(F.col("par_name")).alias("par_id"), "name", "rank")


def repeated_names(taxa: DataFrame) -> DataFrame:
    return taxa.groupBy("name").agg(F.count("uid").alias("n"), F.array_sort(F.collect_list("uid")).alias("ids")).filter("n > 1")


def duplicate_ids(taxa: DataFrame) -> DataFrame:
    return taxa.groupBy("uid").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def preferred_id(rows: DataFrame) -> DataFrame:
    """key, id from (key, id, line, preferred): the first preferred by line, else the smallest id."""
    first = F.min(F.when(F.col("preferred"), F.struct("line", "id")))["id"]
    return rows.groupBy("key").agg(F.coalesce(first, F.min("id")).alias("id"))


def path_prefixes(rows: DataFrame, path: str = "path", acc: str = "acc") -> DataFrame:
    """acc, prefix, element, pos (from 1), id of every prefix of a ``;`` path; the last element keeps the plain acc."""
    parts = F.filter(F.split(path, ";"), lambda x: F.trim(x) != "")
    out = rows.select(acc, parts.alias("a")).select(acc, "a", F.posexplode("a").alias("i", "element"))
    uid = F.when(F.col("i") + 1 == F.size("a"), F.col(acc)).otherwise(F.concat(F.col(acc), F.lit("/#"), (F.col("i") + 1).cast("string")))
    return out.select(acc, F.array_join(F.slice("a", 1, F.col("i") + 1), ";").alias("prefix"), "element", (F.col("i") + 1).alias("pos"), uid.alias("id"))


def path_parents(prefixes: DataFrame) -> DataFrame:
    """prefix, id, par_id from (prefix, id): the parent is the path without its last element."""
    up = prefixes.select(F.col("prefix").alias("above"), F.col("id").alias("par_id"))
    own = prefixes.withColumn("above", F.regexp_extract("prefix", "^(.*);[^;]*$", 1))
    return own.join(up, "above", "left").select("prefix", "id", "par_id")


def first_per_name(rows: DataFrame, name: str, score: str) -> DataFrame:
    own = Window.partitionBy(name).orderBy(F.desc(score), "uid")
    return rows.withColumn("__k", F.row_number().over(own)).filter("__k = 1").drop("__k")
