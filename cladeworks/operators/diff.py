"""What changed between two releases of one hierarchy."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..model import SPECIES
from ..staging import staged
from .folds import fold_up
from .hierarchy import absorb, best_ranks, closure, genus_of, leaves

# Status bits.
PAR_CHANGED, NAME_CHANGED, NEW_TERMINAL, INTERNAL, UNDIAGNOSED, DELETED_TERMINAL = 0x01, 0x02, 0x04, 0x08, 0x10, 0x20
SYN_DELETED, PROMOTED, SUNK, CASCADING, NEWLY_BARREN, OLDLY_BARREN = 0x40, 0x80, 0x100, 0x800, 0x1000, 0x2000
ELEVATED, DEMOTED = 0x4000, 0x8000


def _sides(prev: DataFrame, curr: DataFrame) -> DataFrame:
    tips = lambda t: leaves(t).withColumn("tip", F.lit(True))
    side = lambda t, s: t.join(tips(t), "uid", "left").select("uid", F.lit(True).alias(f"{s}_there"), *[F.col(c).alias(f"{s}_{c}") for c in ("par_id", "name", "rank")], F.coalesce("tip", F.lit(False)).alias(f"{s}_tip"))
    return side(prev, "old").join(side(curr, "new"), "uid", "full")


def _joined(prev: DataFrame, curr: DataFrame) -> DataFrame:
    """The records of every uid of either release side by side."""
    side = lambda t, s: t.select("uid", F.lit(True).alias(f"{s}_there"), *[F.col(c).alias(f"{s}_{c}") for c in ("par_id", "name", "rank")])
    return side(prev, "old").join(side(curr, "new"), "uid", "full")


def statuses(prev: DataFrame, curr: DataFrame) -> DataFrame:
    """uid, status (label), code (bits) of every uid of either release."""
    return _told(_sides(prev, curr)).select("uid", "status", "code")


def _told(both: DataFrame) -> DataFrame:
    """The rows of ``_sides`` with status and code."""
    old, new = F.col("old_there").isNotNull(), F.col("new_there").isNotNull()
    par = ~F.col("old_par_id").eqNullSafe(F.col("new_par_id"))
    name = ~F.col("old_name").eqNullSafe(F.col("new_name"))
    other = ~F.col("old_rank").eqNullSafe(F.col("new_rank"))
    kinds = [
        (~old & F.col("new_tip"), "NEW_TERMINAL", NEW_TERMINAL),
        (~old, "NEW_INTERNAL", NEW_TERMINAL | INTERNAL),
        (~new & F.col("old_tip"), "DELETED_TERMINAL", DELETED_TERMINAL),
        (~new, "DELETED_INTERNAL", DELETED_TERMINAL | INTERNAL),
        (par & name, "NAME_AND_PAR_CHANGED", PAR_CHANGED | NAME_CHANGED),
        (par, "PAR_CHANGED", PAR_CHANGED),
        (name, "NAME_CHANGED", NAME_CHANGED),
        (other, "UNDIAGNOSED_CHANGE", UNDIAGNOSED),
    ]
    label, code = F.lit("UNCHANGED"), F.lit(0)
    for test, text, bits in reversed(kinds):
        label, code = F.when(test, text).otherwise(label), F.when(test, bits).otherwise(code)
    return both.withColumns({"status": label, "code": code})


def field_changes(prev: DataFrame, curr: DataFrame) -> DataFrame:
    """uid, field, kind (deleted, modified, added), old, new for each differing field."""
    both = _sides(prev, curr).filter("old_there and new_there")
    fields = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"old_{f}").alias("old"), F.col(f"new_{f}").alias("new")) for f in ("par_id", "name", "rank")])
    rows = both.select("uid", F.explode(fields).alias("x")).select("uid", "x.*").filter("not (old <=> new)")
    kind = F.when(F.col("new").isNull(), "deleted").when(F.col("old").isNull(), "added").otherwise("modified")
    return rows.select("uid", "field", kind.alias("kind"), "old", "new")


def synonym_changes(prev: DataFrame, curr: DataFrame) -> DataFrame:
    """uid, name, change (deleted, added, changed) of synonyms paired by uid and name."""
    a = prev.groupBy("uid", "name").agg(F.array_sort(F.collect_set("syn_type")).alias("old"))
    b = curr.groupBy("uid", "name").agg(F.array_sort(F.collect_set("syn_type")).alias("new"))
    kind = F.when(F.col("new").isNull(), "deleted").when(F.col("old").isNull(), "added").when(F.col("old") != F.col("new"), "changed")
    return a.join(b, ["uid", "name"], "full").select("uid", "name", kind.alias("change")).filter("change is not null")


def promoted(prev: DataFrame, curr: DataFrame, prev_synonyms: DataFrame) -> DataFrame:
    """uid, name, from_uid: new taxa that carry a name that was a synonym before."""
    new = curr.join(prev.select("uid"), "uid", "left_anti")
    return new.select("uid", "name").join(prev_synonyms.select(F.col("uid").alias("from_uid"), "name").distinct(), "name").select("uid", "name", "from_uid")


def sunk(prev: DataFrame, curr: DataFrame, curr_synonyms: DataFrame) -> DataFrame:
    """uid, name, to_uid: deleted taxa whose name is a synonym now."""
    gone = prev.join(curr.select("uid"), "uid", "left_anti")
    return gone.select("uid", "name").join(curr_synonyms.select(F.col("uid").alias("to_uid"), "name").distinct(), "name").select("uid", "name", "to_uid")


def cascading_renames(prev: DataFrame, curr: DataFrame) -> DataFrame:
    """uid, old, new: renamed with the parent, the rest of the name unchanged."""
    old = prev.select("uid", F.col("par_id").alias("p"), F.col("name").alias("old"))
    new = curr.select("uid", "par_id", F.col("name").alias("new"))
    up_old = prev.select(F.col("uid").alias("p"), F.col("name").alias("p_old"))
    up_new = curr.select(F.col("uid").alias("p"), F.col("name").alias("p_new"))
    rows = old.join(new, "uid").filter("p = par_id and old <> new").join(up_old, "p").join(up_new, "p")
    rest = F.expr("substr(old, length(p_old) + 1)")
    return rows.filter((F.col("p_old") != F.col("p_new")) & F.expr("startswith(old, p_old)") & (F.col("new") == F.concat("p_new", rest))).select("uid", "old", "new")


def species_moves(prev: DataFrame, curr: DataFrame) -> DataFrame:
    """uid, move (elevated, demoted): across the species border while the genus stayed."""
    best = lambda t, s: best_ranks(t).withColumnRenamed("best", s)
    both = best(prev, "old").join(best(curr, "new"), "uid")
    same = genus_of(prev).withColumnRenamed("genus_uid", "g").join(genus_of(curr), "uid").filter("g = genus_uid").select("uid")
    move = F.when((F.col("old") < SPECIES) & (F.col("new") == SPECIES), "elevated").when((F.col("old") == SPECIES) & (F.col("new") < SPECIES), "demoted")
    return both.join(same, "uid", "left_semi").select("uid", move.alias("move")).filter("move is not null")


def barren(prev: DataFrame, curr: DataFrame) -> DataFrame:
    """uid, kind: higher taxa without children now (newly), or then and now (oldly)."""
    from ..model import rank_number

    # one aggregate over flags: no side is sorted, and each parent is sent once a task
    sides = [(prev, "then"), (curr, "now")]
    high = [t.filter(rank_number(F.col("rank")) > SPECIES).select("uid", F.lit(f"high_{s}").alias("flag")) for t, s in sides]
    parents = [t.filter("par_id is not null").select(F.col("par_id").alias("uid"), F.lit(f"kids_{s}").alias("flag")) for t, s in sides]
    has = lambda flag: F.max(F.col("flag") == flag)
    flags = reduce(DataFrame.unionByName, high + parents).groupBy("uid").agg(*[has(f"{f}_{s}").alias(f"{f}_{s}") for f in ("high", "kids") for _, s in sides])
    return flags.filter("uid is not null and high_now and not kids_now").select("uid", F.when(F.expr("high_then and not kids_then"), "oldly_barren").otherwise("newly_barren").alias("kind"))


def compare_ranges(a: DataFrame, b: DataFrame, pairs: DataFrame) -> DataFrame:
    """a, b, relation of the rank ranges of pairs: same, higher, lower or overlap."""
    left = a.select(F.col("uid").alias("a"), F.col("low").alias("al"), F.coalesce("high", F.lit(1 << 30)).alias("ah"))
    right = b.select(F.col("uid").alias("b"), F.col("low").alias("bl"), F.coalesce("high", F.lit(1 << 30)).alias("bh"))
    kind = F.when((F.col("al") == F.col("bl")) & (F.col("ah") == F.col("bh")), "same").when(F.col("al") > F.col("bh"), "higher").when(F.col("ah") < F.col("bl"), "lower").otherwise("overlap")
    return pairs.join(left, "a").join(right, "b").select("a", "b", kind.alias("relation"))


def oldest_changed(curr: DataFrame, changed: DataFrame) -> DataFrame:
    """uid, top: the highest ancestor up to which every taxon from here on is among ``changed`` (uid)."""
    still = curr.join(changed.select("uid"), "uid", "left_semi")
    tree = still.select("uid", "par_id")
    return absorb(tree, tree.limit(0).select("uid"), count=True).select("uid", F.col("last").alias("top"))


def child_transfers(prev: DataFrame, curr: DataFrame) -> DataFrame:
    """par_id, n_new, n_lost, took_from, lost_to: children that changed parents."""
    return _transfers(prev.select("uid", F.col("par_id").alias("old")).join(curr.select("uid", F.col("par_id").alias("new")), "uid").filter("old <> new"))


def _transfers(both: DataFrame) -> DataFrame:
    """``child_transfers`` of the children (uid, old, new) that have moved."""
    gained = both.groupBy(F.col("new").alias("par_id")).agg(F.count("uid").alias("n_new"), F.array_sort(F.collect_set("old")).alias("took_from"))
    lost = both.groupBy(F.col("old").alias("par_id")).agg(F.count("uid").alias("n_lost"), F.array_sort(F.collect_set("new")).alias("lost_to"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    none = lambda c: F.coalesce(c, F.array().cast("array<string>")).alias(c)
    return gained.join(lost, "par_id", "full").select("par_id", zero("n_new"), zero("n_lost"), none("took_from"), none("lost_to"))


def edits(prev: DataFrame, curr: DataFrame) -> DataFrame:
    """level, edit_id, uid, status, previous, current, parent, new_children, took_from, lost_to of each edit.

    A taxon that changed, or whose children did, is edited once.  previous and
    current are its records (uid, par_id, name, rank; null where it is not in
    that release).  Other records are given once and named by id after that:
    new_children are the ids of the edits of children that were added or moved
    to it, and level is one above the largest of theirs, so in the order of
    (level, edit_id) each comes before its users; took_from and lost_to are
    taxa.  parent is the current parent's record at its first use in that order
    if the parent is not edited itself, else only its uid.
    """
    both = _joined(prev, curr)
    # the few taxa that differ are kept with both records; only theirs are asked whether they are tips
    there = F.col("old_there").isNotNull() & F.col("new_there").isNotNull()
    same = reduce(lambda x, y: x & y, [F.col(f"old_{c}").eqNullSafe(F.col(f"new_{c}")) for c in ("par_id", "name", "rank")])
    raw = staged(both.filter(~(there & same)))
    for t, s, o in ((prev, "old", "new"), (curr, "new", "old")):  # a tip counts only where the taxon is in one release alone
        alone = raw.filter(F.col(f"{o}_there").isNull()).select("uid")
        inner = t.select(F.col("par_id").alias("uid")).join(alone, "uid", "left_semi").distinct().withColumn(f"{s}_inner", F.lit(True))
        raw = raw.join(staged(inner), "uid", "left").withColumn(f"{s}_tip", F.col(f"{s}_there").isNotNull() & F.col(f"{s}_inner").isNull())
    changed = staged(_told(raw).select("uid", "status", *[f"{s}_{c}" for s in ("old", "new") for c in ("there", "par_id", "name", "rank")]))
    mine = F.concat_ws(":", F.lower("status"), "uid")
    moved = changed.filter("old_par_id <> new_par_id and old_there and new_there").select("uid", F.col("old_par_id").alias("old"), F.col("new_par_id").alias("new"))
    moves = _transfers(moved).select(F.col("par_id").alias("uid"), "took_from", "lost_to")
    kids = staged(changed.filter("status like 'NEW%' or status like '%PAR_CHANGED'").select("uid", "status", F.col("new_par_id").alias("par_id")))
    gained = kids.groupBy(F.col("par_id").alias("uid")).agg(F.array_sort(F.collect_list(mine)).alias("new_children"))
    gone = changed.filter("status like 'DELETED%'").select(F.col("old_par_id").alias("uid")).distinct().withColumn("lost", F.lit(True))
    above = staged(moves.join(gained, "uid", "full").join(gone, "uid", "full").filter("uid is not null"))
    # taxa that did not change themselves, but whose children did
    still = above.select("uid").join(changed.select("uid"), "uid", "left_anti")
    records = both.filter(there & same).join(staged(still), "uid", "left_semi").withColumn("status", F.lit("UNCHANGED"))
    edited = staged(changed.unionByName(records.select(changed.columns)).join(above.drop("lost"), "uid", "left").withColumn("edit_id", mine))

    # an edit stands above those of its new children: a fold over these edges only
    edges = edited.select("uid").join(kids.select("uid", "par_id"), "uid", "left")
    levels = fold_up(edges, edges.select("uid", F.lit(0).alias("level")), {"level": F.max}, {"level": lambda c, k: c + k})
    record = lambda s: F.when(F.col(f"{s}_there"), F.struct("uid", *[F.col(f"{s}_{c}").alias(c) for c in ("par_id", "name", "rank")]))
    full = edited.join(levels, "uid").withColumns({"previous": record("old"), "current": record("new")})
    full = staged(full.withColumn("up", F.col("current.par_id")))
    # the parent's record goes with its first user
    users = full.filter("up is not null").join(edited.select(F.col("uid").alias("up")), "up", "left_anti")
    first = users.groupBy("up").agg(F.min(F.struct("level", "edit_id")).alias("f"))
    records = curr.select(F.col("uid").alias("up"), F.struct("uid", "par_id", "name", "rank").alias("above"))
    first = staged(first).join(records, "up").select(F.col("f.edit_id").alias("edit_id"), "above")
    names = F.struct(F.col("up").alias("uid"), F.col("above.par_id").alias("par_id"), F.col("above.name").alias("name"), F.col("above.rank").alias("rank"))
    none = F.array().cast("array<string>")
    return full.join(first, "edit_id", "left").select(
        "level", "edit_id", "uid", "status", "previous", "current", F.when(F.col("up").isNotNull(), names).alias("parent"),
        *[F.coalesce(c, none).alias(c) for c in ("new_children", "took_from", "lost_to")],
    )


def edit_log(prev: DataFrame, curr: DataFrame) -> DataFrame:
    """level, edit_id, uid, edit (JSON without nulls and empty lists): ``edits`` as the lines of a log, in the order of (level, edit_id)."""
    rows = edits(prev, curr)
    some = lambda c: F.when(F.size(c) > 0, F.col(c)).alias(c)
    return rows.select("level", "edit_id", "uid", F.to_json(F.struct("edit_id", "status", "previous", "current", "parent", some("new_children"), some("took_from"), some("lost_to"))).alias("edit"))


def genus_report(prev: DataFrame, curr: DataFrame) -> DataFrame:
    """genus, retained, modified, added, deleted: the children of every genus in both releases."""
    kids = lambda t, s: t.join(t.filter("rank = 'genus'").select(F.col("uid").alias("par_id")), "par_id", "left_semi").select(F.col("par_id").alias("genus"), "uid", F.col("name").alias(s))
    both = kids(prev, "old").join(kids(curr, "new"), ["genus", "uid"], "full")
    n = lambda test: F.count_if(test)
    old, new = F.col("old"), F.col("new")
    return both.groupBy("genus").agg(n(old == new).alias("retained"), n(old != new).alias("modified"), n(old.isNull()).alias("added"), n(new.isNull()).alias("deleted"))


def ancestors_changed(curr: DataFrame, changed: DataFrame) -> DataFrame:
    """uid, n_changed: how many of a taxon's ancestors are among ``changed``."""
    pairs = closure(curr).filter("dist > 0").join(changed.select(F.col("uid").alias("anc")), "anc", "left_semi")
    return pairs.groupBy(F.col("des").alias("uid")).agg(F.count("anc").alias("n_changed"))


def has(code: Column, bits: int) -> Column:
    return code.bitwiseAND(F.lit(bits)) == bits
