"""Resources side by side, fragment by fragment: forests as text, name graphs, and which names the other side lacks.

Rows are taxa of several resources that are already cut into fragments:
(res_id, fragment, uid, par_id, name, rank).  All fragments of all resources
are worked on at once; those of every level of the hierarchy are rows alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import staged
from . import semgraph
from .folds import intervals


def shared_fragments(rows: DataFrame, main: str) -> DataFrame:
    """res_id, fragment of the fragments that both ``main`` and the resource have (``main``'s own included)."""
    own = rows.filter(F.col("res_id") == main).select("fragment").distinct()
    return rows.select("res_id", "fragment").distinct().join(own, "fragment", "left_semi").select("res_id", "fragment")


def forests(rows: DataFrame) -> DataFrame:
    """res_id, fragment, place (from 1), line: each fragment's trees with four blanks a level, siblings and roots by name, then uid.

    A taxon whose parent is in another fragment, or nowhere, is a root.
    """
    rows = staged(rows.select("res_id", "fragment", "uid", "par_id", "name"))
    # keys are the uid and a number of the forest: text that differs early, which structs with the fragment in front do not
    forests = staged(rows.select("res_id", "fragment").distinct().withColumn("forest", F.monotonically_increasing_id()))
    key = lambda c: F.concat(c, F.lit(":"), "forest")
    tree = rows.join(forests, ["res_id", "fragment"]).select(key("uid").alias("uid"), key("par_id").alias("par_id"), "name", F.col("uid").alias("id"), "forest")
    walk = intervals(tree, ("name", "id"), ("name", "forest"), "forest").join(forests, "forest")
    return walk.select("res_id", "fragment", F.col("first").alias("place"), F.concat(F.expr("repeat('    ', cast(depth as int))"), F.coalesce("name", F.lit(""))).alias("line"))


def graphs(rows: DataFrame, predicates: tuple[str, ...] | None = None) -> DataFrame:
    """res_id, fragment, subject, predicate, object: the name graph's edges (or those with ``predicates``) of every fragment; a subject is named by its resource."""
    key = lambda c: F.concat_ws(":", "res_id", "fragment", c)
    tree = rows.select(key("uid").alias("uid"), F.when(F.col("par_id").isNotNull(), key("par_id")).alias("par_id"), "name", "rank")
    found = semgraph.edges(semgraph.concepts(tree, "tc"), predicates)
    where = rows.select(F.concat(F.lit("tc:tc:"), key("uid")).alias("subject"), "res_id", "fragment")
    return found.join(where, "subject").select("res_id", "fragment", "subject", "predicate", "object")


def names_report(rows: DataFrame, main: str) -> DataFrame:
    """res_id, fragment, name, category (both, main_only, ref_only) of the names in the fragments that a resource shares with ``main``."""
    named = rows.filter("name is not null").select("res_id", "fragment", "name").distinct()
    shared = shared_fragments(rows, main).filter(F.col("res_id") != main)
    mine = named.filter(F.col("res_id") == main).select("fragment", "name", F.lit(True).alias("m")).join(shared, "fragment")
    theirs = named.join(shared, ["res_id", "fragment"], "left_semi").withColumn("r", F.lit(True))
    both = mine.join(theirs, ["res_id", "fragment", "name"], "full")
    return both.select("res_id", "fragment", "name", F.when(F.col("m") & F.col("r"), "both").when(F.col("m"), "main_only").otherwise("ref_only").alias("category"))
