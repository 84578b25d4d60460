"""Line dedup: a suffix array over line-ID sequences by distributed prefix doubling.

Every line gets an ID (a hash of its trimmed text).  Suffixes of the documents'
ID sequences are ranked by their first 1, 2, 4, ... lines: the rank at 2k of a
suffix is the rank of the pair (rank at k here, rank at k further on).  Only
groups of two or more suffixes that still agree are carried on, so a step costs
what is repeated, and only distinct pairs are sorted, so no task holds a group.
Such a group at k lines is an LCP interval of depth k or more: a line run that
occurs several times.  Of each interval all but the first occurrence (in order
of doc_id and line) are later copies, and their lines are deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .workspace import Workspace, plain_names

#: A repeated run counts from so many lines, or from one line of so many words.
MIN_LINES, MIN_WORDS = 2, 10


def _ranked(pairs: DataFrame, keys: list[str], ws: Workspace) -> DataFrame:
    """keys -> (rank, first, n) of the groups of two or more; ranks follow the order of the keys."""
    groups = pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "rid", "i")).alias("first"))
    # distinct keys only are sorted over ranges; ids grow along the ranges
    return ws.table(groups.filter("n > 1").orderBy(*keys).withColumn("rank", F.monotonically_increasing_id()))


def intervals(docs: DataFrame, ws: Workspace) -> list[tuple[int, DataFrame]]:
    """[(k, suffixes that share their first k lines with others)] for k = 1, 2, 4, ... until none does.

    Columns: doc_id, rid (row identity), i (line), words, rank (of the
    interval, in suffix order), n (its occurrences), later (whether an earlier
    one exists).
    """
    rid = F.xxhash64("doc_id", "text")
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter("text is not null").select("doc_id", rid.alias("rid"), "text")
    lines = rows.select("doc_id", "rid", F.posexplode(F.split("text", "\n", -1)).alias("i", "line")).select("doc_id", "rid", "i", F.trim("line").alias("line"))
    words = F.size(F.split("line", r"\s+"))
    ids = lines.filter("line <> ''").select("doc_id", "rid", "i", F.xxhash64("line").alias("id"), words.alias("words"))
    ids = ws.table(ids.dropDuplicates(["rid", "i"]))  # repeated rows are one document
    out, k = [], 1
    pairs, keys = ids, ["id"]
    while True:
        groups = _ranked(pairs, keys, ws)
        here = F.struct("doc_id", "rid", "i")
        live = ws.table(pairs.join(groups, keys).select("doc_id", "rid", "i", "words", "rank", "n", (here > F.col("first")).alias("later")))
        ws.drop(groups)
        if live.isEmpty():
            ws.drop(live)
            return out
        out.append((k, live))
        ahead = live.select("rid", (F.col("i") - k).alias("i"), F.col("rank").alias("ahead"))
        own = live.select("doc_id", "rid", "i", "words", F.col("rank").alias("own"))
        pairs, keys = own.join(ahead, ["rid", "i"]), ["own", "ahead"]
        k *= 2


def runs(docs: DataFrame) -> DataFrame:
    """length, rank, n, doc_id, i of every LCP interval's first occurrence, for lengths 1, 2, 4, ..."""
    levels = intervals(docs, Workspace(docs.sparkSession, "lines"))
    empty = docs.sparkSession.createDataFrame([], "length int, rank long, n long, doc_id " + docs.schema["doc_id"].dataType.simpleString() + ", i int")
    parts = [live.filter("not later").select(F.lit(k).alias("length"), "rank", "n", "doc_id", "i") for k, live in levels]
    for p in parts:
        empty = empty.unionByName(p)
    return empty


def _later(live: DataFrame, gap: int) -> DataFrame:
    """The later copies of the runs that are ``gap`` lines longer than those of ``live``: two of these, ``gap`` lines apart."""
    if not gap:
        return live.filter("later")
    here = F.struct("doc_id", "rid", "i")
    ahead = live.select("rid", (F.col("i") - gap).alias("i"), F.col("rank").alias("ahead"))
    pairs = live.select("doc_id", "rid", "i", F.col("rank").alias("own")).join(ahead, ["rid", "i"])
    groups = pairs.groupBy("own", "ahead").agg(F.count(F.lit(1)).alias("n"), F.min(here).alias("first")).filter("n > 1")
    return pairs.join(groups, ["own", "ahead"]).filter(here > F.col("first"))


def dedup_lines(docs: DataFrame, min_lines: int = MIN_LINES, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs`` with later copies of repeated line runs cut from ``text``.

    A run counts if it has ``min_lines`` lines (any number from 1) or holds a
    line of ``min_words`` words.  Adds __n_lines, __n_deleted and __shared (the
    largest of 1, 2, 4, ... lines of a run that this document shares with
    another place; 0 if none).  Blank lines never match and stay.  A null text
    has no lines; an empty one has one.  Repeated rows (doc_id and text) count
    as one document and get the same result; different documents with one
    doc_id are ordered by a hash of their text; null ids come first.  Columns of
    ``docs`` that have the name of an added one give way to it; an empty table
    gives an empty result.
    """
    names, docs = docs.columns, plain_names(docs)
    ws = Workspace(docs.sparkSession, "lines")
    levels = dict(intervals(docs, ws))
    none = docs.sparkSession.createDataFrame([], "rid long, at int")
    gone, shared = none, docs.sparkSession.createDataFrame([], "rid long, k int")
    if 1 in levels and min_words:
        gone = gone.unionByName(levels[1].filter(F.col("later") & (F.col("words") >= min_words)).select("rid", F.col("i").alias("at")))
    low = 1 << (min_lines.bit_length() - 1)
    if low in levels:
        later = _later(levels[low], min_lines - low)
        gone = gone.unionByName(later.select("rid", F.explode(F.sequence("i", F.col("i") + min_lines - 1)).alias("at")))
    for k, live in levels.items():
        shared = shared.unionByName(live.select("rid", F.lit(k).alias("k")))
    cut = gone.groupBy("rid").agg(F.array_sort(F.collect_set("at")).alias("__gone"))  # at most a document's own lines
    most = shared.groupBy("rid").agg(F.max("k").alias("__k"))
    found = ws.table(most.join(cut, "rid", "left"))
    text = F.col("text").cast("string")
    rows = docs.withColumn("__rid", F.xxhash64("doc_id", "text")).join(found.withColumnRenamed("rid", "__rid"), "__rid", "left")
    lines = F.split(text, "\n", -1)
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(F.col("__gone"), i)), "\n")
    added = {
        "__n_lines": F.when(text.isNull(), 0).otherwise(F.size(lines)).cast("long"),
        "__n_deleted": F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__gone")).cast("long"),
        "__shared": F.coalesce("__k", F.lit(0)).cast("long"),
    }
    own = [(F.when(F.col("__gone").isNull(), text).otherwise(kept) if c == "text" else F.col(c)).alias(n) for c, n in zip(docs.columns, names, strict=True) if n.lower() not in added]
    return rows.select(*own, *[c.alias(n) for n, c in added.items()])
