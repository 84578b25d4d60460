"""Which taxa would make good new borders of a partition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..model import NON_SEPARATING_RANKS, stable_sources
from ..staging import staged
from .hierarchy import absorb, leaves, roots, tips_below

MIN_TIPS, FOLD = 20, 5000


def relevant_sources(taxa: DataFrame, fold: int = FOLD) -> DataFrame:
    """src, n of the stable sources that are at most ``fold`` times rarer than the commonest."""
    counts = taxa.select("uid", F.explode(stable_sources(F.col("src"))).alias("src")).groupBy("src").agg(F.count("uid").alias("n"))
    top = counts.agg(F.max("n").alias("top"))
    return counts.crossJoin(F.broadcast(top)).filter(F.col("n") >= F.when(F.col("top") < fold, 0).otherwise(F.floor(F.col("top") / fold))).select("src", "n")  # one row


def candidates(taxa: DataFrame, required: list[str] | None = None, min_tips: int = MIN_TIPS) -> DataFrame:
    """uid, name, n_tips: internal taxa below a root with enough tips, a separating rank and all required sources."""
    tree = staged(taxa.select("uid", "par_id"))  # read many times below, so that plans do not hold what made it
    inner = taxa.join(leaves(tree), "uid", "left_anti").join(roots(tree), "uid", "left_anti")
    ranked = inner.filter(F.col("rank").isNull() | ~F.col("rank").isin(*NON_SEPARATING_RANKS))
    if required:
        ranked = ranked.filter(F.size(F.array_except(F.array(*map(F.lit, required)), stable_sources(F.col("src")))) == 0)
    return ranked.join(tips_below(tree), "uid").filter(F.col("n_tips") >= min_tips).select("uid", "name", "n_tips")


def by_name(taxa: DataFrame, name: str) -> DataFrame:
    return taxa.filter(F.lower("name") == name.lower()).select("uid", "name")


def confirmed(taxa: DataFrame, found: DataFrame) -> DataFrame:
    """Those of ``found`` that lie below no other."""
    found, tree = staged(found), staged(taxa.select("uid", "par_id"))
    near = absorb(tree, found).filter("stop is not null").select(F.col("uid").alias("par_id"))
    nested = tree.join(near, "par_id", "left_semi").select("uid")
    return found.join(nested, "uid", "left_anti")


def nested(taxa: DataFrame, found: DataFrame) -> DataFrame:
    """uid, parent: each separator's nearest separator above; an only child of a separator is left out."""
    marks, tree = staged(found.select("uid")), staged(taxa.select("uid", "par_id"))
    up = tree.join(absorb(tree, marks).select(F.col("uid").alias("par_id"), F.col("stop").alias("parent")), "par_id", "left")
    own = staged(up.join(marks, "uid", "left_semi").select("uid", "parent"))
    lone = own.filter("parent is not null").groupBy("parent").agg(F.count("uid").alias("n")).filter("n = 1").select("parent")
    kept = own.join(lone, "parent", "left_anti").unionByName(own.filter("parent is null")).distinct()
    return kept.select("uid", "parent")


def separator_roots(found: DataFrame, source: str) -> DataFrame:
    """uid (of the source), fragment: the roots that separators name in one source (found: name, src array)."""
    rows = found.select("name", F.explode("src").alias("s")).filter(F.col("s.src") == source)
    return rows.select(F.col("s.id").alias("uid"), F.regexp_replace("name", "[^-a-zA-Z0-9._]", "_").alias("fragment"))
