"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from .workspace import Workspace


def components(edges: DataFrame, ws: Workspace, max_rounds: int = 60) -> DataFrame:
    """(node, comp) for every node of the edges (a, b); comp is the smallest node reachable.

    Each round is a few equi-joins and minima and is written to the shared
    folder; nothing but two numbers a round reaches the driver.  Loops and
    repeated edges are ignored; without edges the result is empty.
    """
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    # a node's edges to several smaller ones become one edge to the least, and edges among these, of which many are alike
    led = pairs.withColumn("m", F.min("v").over(Window.partitionBy("u")))
    now = led.select("u", F.col("m").alias("v")).unionByName(led.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()
    now, mark = ws.table(now), None
    for _ in range(max_rounds):
        new_mark = tuple(now.agg(F.count("u"), F.sum(F.shiftright(F.xxhash64("u", "v"), 24))).first())
        if new_mark == mark or new_mark[0] == 0:
            break
        mark = new_mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = ws.table(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        ws.drop(now)
        now = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    own = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(own.select("node", F.col("node").alias("comp")))


def roots_of(parents: DataFrame, ws: Workspace, max_rounds: int = 60) -> DataFrame:
    """(node, comp) for every node of a forest (a, b), in which each b has one parent a and no way leads back to it; comp is the root.

    Pointer jumping: a round is one equi-join and halves the depth; only
    a count a round reaches the driver.  Without edges the result is empty.
    """
    now = ws.table(parents.select(F.col("b").alias("node"), F.col("a").alias("comp")))
    for _ in range(max_rounds):
        up = now.select(F.col("node").alias("comp"), F.col("comp").alias("to"))
        moved = Observation()
        after = now.join(up, "comp", "left").observe(moved, F.count("to").alias("rows"))
        after = ws.table(after.select("node", F.coalesce("to", "comp").alias("comp")))
        ws.drop(now)
        now = after
        if not moved.get["rows"]:
            return ws.table(now.unionByName(now.select(F.col("comp").alias("node"), "comp").distinct()))
    raise RuntimeError(f"a forest is deeper than 2 ** {max_rounds}")


def merged(comps: DataFrame, links: DataFrame, ws: Workspace, forest: bool = False) -> DataFrame:
    """``comps`` (node, comp) after the links (a, b) between components (a node without one is its own) are added.

    ``forest``: each b has one link, and these make no cycle.
    """
    joined = roots_of(links, ws) if forest else ws.table(components(links.distinct(), ws))
    moved = joined.select(F.col("node").alias("comp"), F.col("comp").alias("to"))
    after = comps.join(moved, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp"))
    return ws.table(after.unionByName(joined.join(comps.select("node"), "node", "left_anti")))
