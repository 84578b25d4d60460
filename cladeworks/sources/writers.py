"""Sinks and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import model
from ..operators.hierarchy import leaves, preorder
from .readers import SEP


def taxonomy_lines(taxa: DataFrame, extinct: DataFrame | None = None, full: bool = False) -> DataFrame:
    """preorder_idx, value: the interim taxonomy's lines, the header first (index 0); ``extinct`` uids get that flag.

    ``full``: with sources and unique names (columns src, uniqname) before the flags.
    """
    flags = F.col("flags") if "flags" in taxa.columns else F.array().cast("array<string>")
    if extinct is not None:
        taxa = taxa.join(extinct.select("uid").distinct().withColumn("__gone", F.lit(True)), "uid", "left")
        flags = F.when(F.col("__gone"), model.add_flag(flags, "extinct")).otherwise(flags)
    more = [model.format_sources(F.col("src")), F.col("uniqname")] if full else []
    cells = [F.coalesce(c, F.lit("")) for c in (F.col("uid"), F.col("par_id"), F.col("name"), F.col("rank"), *more, model.format_flags(flags))]
    rows = taxa.join(preorder(taxa).select("uid", "preorder_idx"), "uid").select("preorder_idx", F.concat(F.concat_ws(SEP, *cells), F.lit("\t|\t")).alias("value"))
    head = SEP.join(("uid", "parent_uid", "name", "rank", *(("sourceinfo", "uniqname") if full else ()), "flags", ""))
    return taxa.sparkSession.range(1).select(F.lit(0).cast("long").alias("preorder_idx"), F.lit(head).alias("value")).unionByName(rows)


def synonym_lines(taxa: DataFrame, syn: DataFrame) -> DataFrame:
    """preorder_idx, value of synonyms in their taxa's order."""
    return syn.join(preorder(taxa).select("uid", "preorder_idx"), "uid").select("preorder_idx", F.concat(F.concat_ws(SEP, "uid", "name", "syn_type"), F.lit("\t|\t")).alias("value"))


def part_synonym_lines(syn: DataFrame, order: DataFrame) -> DataFrame:
    """rest, place, uid, value: a partition's synonyms, those of the known ids (uid, place) first and in their order, then the others by id."""
    line = F.concat(F.concat_ws(SEP, "uid", "name", "syn_type"), F.lit("\t|\t")).alias("value")
    return syn.join(order.select("uid", "place"), "uid", "left").select(F.col("place").isNull().alias("rest"), "place", "uid", line)


def write_part_lines(lines: DataFrame, path: str) -> None:
    """Text in order (part files follow it)."""
    lines.orderBy("rest", "place", "uid", "value").select("value").write.mode("overwrite").text(path)


def write_lines(lines: DataFrame, path: str) -> None:
    """Text in order (part files follow it)."""
    lines.orderBy("preorder_idx", "value").select("value").write.mode("overwrite").text(path)


def write_forwards(forwards: DataFrame, path: str) -> None:
    forwards.select("old_id", "new_id").write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def write_json(rows: DataFrame, path: str, by: str | None = None) -> None:
    out = rows.write.mode("overwrite")
    (out.partitionBy(by) if by else out).json(path)


def details(taxa: DataFrame, syn: DataFrame) -> DataFrame:
    """metric, n: what a written taxonomy holds."""
    tips = leaves(taxa)
    parts = [("taxa", taxa), ("tips", tips), ("internals", taxa.join(tips, "uid", "left_anti")), ("synonyms", syn), ("ids_with_synonyms", syn.select("uid").distinct())]
    out = None
    for name, rows in parts:
        one = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("metric"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def indented(taxa: DataFrame) -> DataFrame:
    """preorder_idx, line: the tree with four blanks a level, siblings by display name."""
    name = model.display_name(F.col("name"), F.col("uniqname")) if "uniqname" in taxa.columns else F.col("name")
    own = taxa.withColumn("__shown", name)
    return own.join(preorder(own, "__shown").select("uid", "depth", "preorder_idx"), "uid").select("preorder_idx", F.concat(F.expr("repeat('    ', depth)"), "__shown").alias("line"))


def rank_indented(taxa: DataFrame) -> DataFrame:
    """preorder_idx, line: ``+--`` before a sibling that has a later one, ``\\--`` before the last."""
    walk = preorder(taxa).select("uid", "depth", "preorder_idx")
    own = taxa.join(walk, "uid")
    last = own.groupBy("par_id").agg(F.max("preorder_idx").alias("last"))
    mark = F.when(F.col("par_id").isNull(), "").when(F.col("preorder_idx") == F.col("last"), "\\--").otherwise("+--")
    joined = own.join(last, own["par_id"].eqNullSafe(last["par_id"]), "left").drop(last["par_id"])
    return joined.select("preorder_idx", F.concat(F.expr("repeat('   ', greatest(depth - 1, 0))"), mark, "name", F.lit(" ("), F.coalesce("rank", F.lit("")), F.lit(")")).alias("line"))


def status_report(resources: DataFrame) -> DataFrame:
    """status, ids of resources by the furthest step they reached."""
    step = F.when(F.col("partitioned"), "partitioned").when(F.col("normalized"), "normalized").when(F.col("unpacked"), "unpacked").when(F.col("downloaded"), "downloaded").otherwise("none")
    return resources.groupBy(step.alias("status")).agg(F.array_sort(F.collect_list("id")).alias("ids"))


def status_lines(resources: DataFrame, layout: str = "flat") -> DataFrame:
    """line: the report on resources (id, base, ...) in one of four layouts.

    ``flat``: id and status, ``grouped``: a status and its ids, ``ids``: ids
    only, ``terminal``: only ids of resources that are no other's base.
    """
    if layout == "grouped":
        return status_report(resources).select(F.concat("status", F.lit(": "), F.array_join("ids", ", ")).alias("line"))
    if layout == "flat":
        return status_report(resources).select("status", F.explode("ids").alias("id")).select(F.concat("id", F.lit("\t"), "status").alias("line"))
    if layout not in ("ids", "terminal"):
        raise ValueError(f"no layout {layout}")
    bases = resources.filter("base is not null").select(F.col("base").alias("id")) if layout == "terminal" else resources.limit(0).select("id")
    return resources.select("id").join(bases, "id", "left_anti").select(F.col("id").alias("line"))
