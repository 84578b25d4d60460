"""The hierarchy kernel: questions about parent pointers.

Taxa have ``uid`` and ``par_id`` (null, or not a uid: a root).  Paths are found
by pointer jumping: the number of joins grows with the logarithm of the depth,
and each round is staged, so plans stay small.  A cycle is an error that names
a member, except where a function says otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import SPECIES, rank_number
from ..staging import staged
from .folds import MAX_ROUNDS, fold_up, intervals, raked


def roots(taxa: DataFrame) -> DataFrame:
    """uid of the taxa whose parent is no taxon."""
    own = taxa.select(F.col("uid").alias("par_id"))
    return taxa.select("uid", "par_id").join(own, "par_id", "left_anti").select("uid")


def leaves(taxa: DataFrame) -> DataFrame:
    """uid of the taxa that are nobody's parent."""
    return taxa.select("uid").join(taxa.select(F.col("par_id").alias("uid")).distinct(), "uid", "left_anti")


def children(taxa: DataFrame) -> DataFrame:
    """par_id, n_children, children (sorted)."""
    return taxa.filter("par_id is not null").groupBy("par_id").agg(F.count("uid").alias("n_children"), F.array_sort(F.collect_list("uid")).alias("children"))


def closure(taxa: DataFrame) -> DataFrame:
    """All (anc, des, dist) with anc on the path from des to its root, des itself included at 0."""
    ids = taxa.select("uid")
    up = taxa.select(F.col("par_id").alias("anc"), F.col("uid").alias("des")).join(ids.withColumnRenamed("uid", "anc"), "anc", "left_semi")
    jump = staged(up)
    own = ids.select(F.col("uid").alias("anc"), F.col("uid").alias("des"), F.lit(0).alias("dist"))
    pairs = own.unionByName(jump.select("anc", "des", F.lit(1).alias("dist")))
    for k in range(1, MAX_ROUNDS):
        # pairs hold all distances below 2**k; jump goes from 2**(k - 1) to 2**k
        jump = staged(jump.select(F.col("anc").alias("top"), F.col("des").alias("anc")).join(jump, "anc").select(F.col("top").alias("anc"), "des"))
        if jump.isEmpty():
            return pairs
        over = jump.select(F.col("anc").alias("top"), F.col("des").alias("anc"))
        further = over.join(pairs, "anc").select(F.col("top").alias("anc"), "des", (F.col("dist") + (1 << k)).alias("dist"))
        pairs = pairs.unionByName(further)
        if k >= 2:  # plans of two rounds are small enough
            pairs = staged(pairs)
        if k >= 4 and not (loop := pairs.filter("anc = des and dist > 0").limit(1)).isEmpty():
            raise ValueError(f"cycle through {loop.first()['anc']}")
    raise ValueError("paths too long")


def depths(taxa: DataFrame) -> DataFrame:
    """uid, depth (a root's is 0), root."""
    none = taxa.select("uid").limit(0)
    found = absorb(taxa, none, count=True)
    return found.select("uid", F.col("steps").alias("depth"), F.col("last").alias("root"))


def absorb(taxa: DataFrame, stops: DataFrame, count: bool = False) -> DataFrame:
    """uid, stop: the nearest of ``stops`` at or above each taxon (null: none).

    With ``count`` also steps (to the stop, or else to the root) and last (the
    stop or the root).  Rows stay one a taxon however deep the tree is.
    """
    marks = stops.select("uid").distinct().withColumn("is_stop", F.lit(True))
    tree = raked(taxa.select("uid", "par_id").join(marks, "uid", "left"), keep=("is_stop",))
    # at: where a taxon's way ends so far; hit: that is a stop
    own = lambda t: t.select("uid", "up", F.coalesce("is_stop", F.lit(False)).alias("hit"))
    ended = lambda t: t.filter("hit or up is null").select("uid", F.col("uid").alias("at"), "hit", F.lit(0).cast("long").alias("steps"))
    ahead = [F.col("uid").alias("at"), F.col("at").alias("next"), F.col("hit").alias("next_hit"), F.col("steps").alias("more")]
    moved = ["uid", F.col("next").alias("at"), F.col("next_hit").alias("hit"), (F.col("steps") + F.col("more")).alias("steps")]
    parts = []
    if tree.core is not None:
        core, limit = own(tree.core), tree.core.count()
        now = ended(core).withColumn("ended", F.lit(True)).unionByName(core.filter("not hit and up is not null").select("uid", F.col("up").alias("at"), "hit", F.lit(1).cast("long").alias("steps"), F.lit(False).alias("ended")))
        for k in range(MAX_ROUNDS):
            open_rows = now.filter("not ended")
            if open_rows.isEmpty():
                break
            if (1 << k) > 2 * limit:
                raise ValueError(f"cycle at or above {open_rows.first()['uid']}")
            now = staged(now.filter("ended").unionByName(open_rows.drop("hit", "ended").join(now.select(*ahead, "ended"), "at").select(*moved, "ended")))
        parts.append(now.drop("ended"))
    for k in reversed(range(len(tree.layers))):
        tips = own(tree.layers[k])
        done = ended(tips)
        if parts:
            above = reduce(DataFrame.unionByName, parts).select(*ahead)
            lower = tips.filter("not hit and up is not null").select("uid", F.col("up").alias("at"), F.lit(1).cast("long").alias("steps"))
            done = done.unionByName(lower.join(above, "at").select(*moved))
        parts.append(staged(done))
    out = reduce(DataFrame.unionByName, parts).select("uid", F.when(F.col("hit"), F.col("at")).alias("stop"), "steps", F.col("at").alias("last"))
    return out if count else out.select("uid", "stop")


def nearest(taxa: DataFrame, stops: DataFrame) -> DataFrame:
    """``taxa`` with ``stop`` (see ``absorb``): the way up is sought for parents only, all others take their parent's."""
    parents = taxa.filter("par_id is not null").select(F.col("par_id").alias("uid")).distinct()
    inner = staged(taxa.select("uid", "par_id").join(parents, "uid", "left_semi"))
    above = staged(absorb(inner, stops).filter("stop is not null").select(F.col("uid").alias("par_id"), F.col("stop").alias("__above")))
    own = stops.select("uid").distinct().withColumn("__own", F.lit(True))
    found = taxa.filter("uid is not null").join(own, "uid", "left").join(above, "par_id", "left")
    return found.select(*taxa.columns, F.when(F.col("__own"), F.col("uid")).otherwise(F.col("__above")).alias("stop"))


def subtree(taxa: DataFrame, top: DataFrame) -> DataFrame:
    """The taxa at or below any uid of ``top``."""
    inside = absorb(taxa, top).filter("stop is not null").select("uid")
    return taxa.join(inside, "uid", "left_semi")


def subtree_with_synonyms(taxa: DataFrame, synonyms: DataFrame, top: DataFrame) -> tuple[DataFrame, DataFrame]:
    own = subtree(taxa, top)
    return own, synonyms.join(own.select("uid"), "uid", "left_semi")


def upward(taxa: DataFrame, starts: DataFrame) -> DataFrame:
    """uid, dist of the taxa at or above any uid of ``starts``; dist is that from the nearest one below.

    Round k takes all that is known 2**k steps up, so there are as many rounds
    as the depth has bits, and never more rows than taxa.
    """
    ids = taxa.select("uid")
    jump = staged(taxa.select("uid", F.col("par_id").alias("up")).join(ids.withColumnRenamed("uid", "up"), "up", "left_semi"))
    live = ids.join(starts.select("uid").distinct(), "uid", "left_semi").withColumn("dist", F.lit(0).cast("long"))
    limit = None
    for k in range(MAX_ROUNDS):
        if jump.isEmpty():
            return live
        if limit is None:
            limit = taxa.count()
        if (1 << k) > limit:
            raise ValueError(f"cycle at or above {jump.first()['uid']}")
        further = live.join(jump, "uid").select(F.col("up").alias("uid"), (F.col("dist") + (1 << k)).alias("dist"))
        live = staged(live.unionByName(further).groupBy("uid").agg(F.min("dist").alias("dist")))
        jump = staged(jump.join(jump.select(F.col("uid").alias("up"), F.col("up").alias("top")), "up").select("uid", F.col("top").alias("up")))
    raise ValueError("paths too long")


def path_to_root(taxa: DataFrame, uid: str) -> DataFrame:
    """uid, dist from the taxon up to its root."""
    return upward(taxa, taxa.filter(F.col("uid") == uid)).withColumn("dist", F.col("dist").cast("int"))


def with_parents(taxa: DataFrame, parents: DataFrame) -> DataFrame:
    """The taxa whose parent is a uid of ``parents``, be that a taxon or not."""
    return taxa.join(parents.select(F.col("uid").alias("par_id")), "par_id", "left_semi").select(taxa.columns)


def contains(taxa: DataFrame, tests: DataFrame) -> DataFrame:
    """Which of ``tests`` (first, second) have first at or above second, by nested-set labels."""
    labels = staged(intervals(taxa).select("uid", F.col("first").alias("__low"), F.col("last").alias("__high")))
    above = tests.join(labels.withColumnRenamed("uid", "first"), "first")
    return above.join(labels.select(F.col("uid").alias("second"), F.col("__low").alias("__at")), "second").filter("__at between __low and __high").select("first", "second")


def find_below(taxa: DataFrame, top: str, test: Column) -> DataFrame:
    return subtree(taxa, taxa.filter(F.col("uid") == top)).filter(test)


def preorder(taxa: DataFrame, key: str = "uid") -> DataFrame:
    """uid, depth, preorder_idx (from 1): siblings, and roots, in the order of (``key``, uid)."""
    return intervals(taxa, key).select("uid", "depth", F.col("first").alias("preorder_idx"))


def postorder(taxa: DataFrame, key: str = "uid") -> DataFrame:
    """uid, postorder_idx: parents after their children (the preorder reversed)."""
    walk = staged(preorder(taxa, key))
    n = walk.agg(F.max("preorder_idx").alias("n"))
    return walk.crossJoin(F.broadcast(n)).select("uid", (F.col("n") - F.col("preorder_idx") + 1).alias("postorder_idx"))  # one row


def tips_below(taxa: DataFrame) -> DataFrame:
    """uid, n_tips; a leaf counts itself."""
    return fold_up(taxa, leaves(taxa).select("uid", F.lit(1).cast("long").alias("n_tips")), {"n_tips": F.sum})


def genus_of(taxa: DataFrame) -> DataFrame:
    """uid, genus_uid: the nearest taxon of rank genus at or above (null: none)."""
    return absorb(taxa, taxa.filter("rank = 'genus'")).withColumnRenamed("stop", "genus_uid")


def rank_ranges(taxa: DataFrame) -> DataFrame:
    """uid, low, high, best: bounds of each taxon's rank number and the best guess.

    A known rank is both bounds.  Else the lower is one above the largest of
    (known number below + distance) over the ranked descendants that are reached
    through unranked taxa only, 0 where there are none; the upper one below the nearest ranked ancestor's (less one a step between), null
    above the topmost rank.  The guess is the lower bound, raised until it tops
    every child's guess: the largest of (number below + distance) over the
    descendants, computed in one aggregate.
    """
    num = staged(taxa.select("uid", "par_id", rank_number(F.col("rank")).alias("num")))
    bounds = _best_guesses(num)
    # nearest ranked proper ancestor: sought for the unranked ones only, among them and their ranked parents
    blank = num.filter("num is null").select("uid", "par_id")
    tops = num.filter("num is not null").join(blank.select(F.col("par_id").alias("uid")).distinct(), "uid", "left_semi")
    ranked = staged(tops.select("uid", "num"))
    tree = blank.unionByName(ranked.select("uid", F.lit(None).cast(num.schema["par_id"].dataType).alias("par_id")))
    found = absorb(tree, ranked, count=True).filter("steps > 0").join(ranked.withColumnRenamed("uid", "stop"), "stop")
    above = found.select("uid", (F.col("num") - F.col("steps").cast("int")).alias("above"))
    high = F.when(F.col("num").isNotNull(), F.col("num")).otherwise(F.col("above"))
    return bounds.join(above, "uid", "left").select("uid", "low", high.alias("high"), "best")


def best_ranks(taxa: DataFrame) -> DataFrame:
    """uid, best: the best guess of ``rank_ranges`` alone."""
    return _best_guesses(staged(taxa.select("uid", "par_id", rank_number(F.col("rank")).alias("num")))).select("uid", "best")


def _best_guesses(num: DataFrame) -> DataFrame:
    """uid, num, low, best (see ``rank_ranges``).

    The guess differs from the lower bound only at and above a taxon that some
    child's bound reaches, so only these are folded; where every taxon's bound
    tops its children's there are none.
    """
    blank, ranked = num.filter("num is null").select("uid", "par_id"), num.filter("num is not null")
    kids = staged(ranked.filter("par_id is not null").groupBy(F.col("par_id").alias("uid")).agg((F.max("num") + 1).alias("asked")))
    # ranked descendants reached through unranked taxa only: a fold over the unranked ones, from the ranked children of each
    seeds = kids.join(blank.select("uid"), "uid", "left_semi").withColumnRenamed("asked", "below")
    below = fold_up(blank, seeds, {"below": F.max}, {"below": lambda c, d: c + d})
    rest = staged(num.filter("num is null").join(below, "uid", "left").select("uid", "par_id", "num", F.coalesce(F.col("below") + 1, F.lit(0)).alias("low")))
    low = ranked.withColumn("low", F.col("num")).unionByName(rest)
    # each taxon's bound beside the largest that its children ask for
    asked = kids.unionByName(rest.filter("par_id is not null").select(F.col("par_id").alias("uid"), (F.col("low") + 1).alias("asked"))).groupBy("uid").agg(F.max("asked").alias("asked"))
    inner = staged(low.select("uid", "low").join(asked, "uid"))
    short = inner.filter("asked > low").select("uid")
    if short.isEmpty():
        return low.select("uid", "num", "low", F.col("low").alias("best"))
    over = staged(upward(low.select("uid", "par_id"), short).select("uid"))
    part = low.select("uid", "par_id").join(over, "uid", "left_semi")
    seeds = inner.join(over, "uid", "left_semi").select("uid", F.greatest("asked", "low").alias("best"))
    best = fold_up(part, seeds, {"best": F.max}, {"best": lambda c, d: c + d})
    return low.join(best, "uid", "left").select("uid", "num", "low", F.coalesce("best", "low").alias("best"))


def specimen_typed(taxa: DataFrame) -> DataFrame:
    """uid, specimen_typed: at or below species (null where the bounds cannot tell)."""
    own = taxa.select("uid", rank_number(F.col("rank")).alias("num")).join(rank_ranges(taxa), "uid")
    told = F.when(F.col("num").isNotNull(), F.col("num") <= SPECIES).when(F.col("low") > SPECIES, False).when(F.col("high") < SPECIES, True)
    return own.select("uid", told.alias("specimen_typed"))


def union_below(taxa: DataFrame, marked: DataFrame) -> DataFrame:
    """uid, found (sorted distinct values of ``marked`` (uid, value) at or below); taxa without any are left out.

    The answer of a taxon is as long as its values are many; to count marked
    taxa below, fold a count instead.
    """
    own = marked.groupBy("uid").agg(F.collect_set("value").alias("found"))
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c))))
    return fold_up(taxa, own, {"found": union}).filter(F.size("found") > 0).select("uid", F.array_sort("found").alias("found"))


def mrca(taxa: DataFrame, names: DataFrame) -> DataFrame:
    """uid, depth, n_found of the deepest taxon with all of ``names`` (uid) at or below."""
    total = names.select("uid").distinct().join(taxa.select("uid"), "uid", "left_semi")
    n = total.count()
    found = fold_up(taxa, total.select("uid", F.lit(1).cast("long").alias("n_found")), {"n_found": F.sum})
    return found.filter(F.col("n_found") == n).join(depths(taxa).select("uid", "depth"), "uid").orderBy(F.desc("depth"), "uid").limit(1).select("uid", "depth", "n_found")


def overlap_children(taxa: DataFrame, top: str, names: DataFrame) -> DataFrame:
    """uid, n_found, n_tips, overlap (only, mainly, minor, none) of the children of ``top``."""
    kids = taxa.filter(F.col("par_id") == top).select("uid")
    one = lambda df, c: df.select("uid").distinct().withColumn(c, F.lit(1).cast("long"))
    counts = fold_up(taxa, one(leaves(taxa), "n_tips").join(one(names, "n_found"), "uid", "full"), {"n_tips": F.sum, "n_found": F.sum})
    out = kids.join(counts, "uid").withColumn("n_found", F.coalesce("n_found", F.lit(0)))
    kind = F.when(F.col("n_found") == 0, "none").when(F.col("n_found") == F.col("n_tips"), "only").when(2 * F.col("n_found") > F.col("n_tips"), "mainly").otherwise("minor")
    return out.select("uid", "n_found", "n_tips", kind.alias("overlap"))
