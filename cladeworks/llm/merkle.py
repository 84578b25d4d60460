"""A Merkle manifest of a table: a digest tree for each group, a tree over the groups' roots, and a proof for every row.

Rows are leaves, ordered within their group; every ``fanout`` consecutive nodes
become one.  The trees are cut into aligned blocks of ``fanout ** HEIGHT``
nodes.  A task holds one block at a time, as a contiguous numpy matrix of
64-byte hex digests: a level is hashed row by row after a reshape by the
fanout, and siblings are taken by index arithmetic.  Blocks' tops are the
nodes of the next round, so there are as many rounds as the logarithm of the
rows to the base of a block has; no task sees more than a block, and only the
question whether a round is the last reaches the driver.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .workspace import Workspace

FANOUT = 16
#: Levels of a block: a task holds fanout ** HEIGHT digests.
HEIGHT = 3
_WIDTH = 64  # bytes of a digest in hex


def digest(*columns: Column) -> Column:
    """Lowercase hex SHA-256 over all columns: ``-`` for null, else the UTF-8 byte count, a colon and the value."""
    said = lambda c: F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
    return F.sha2(F.concat(*[said(c) for c in columns]).cast("binary"), 256)


def _hashed(rows: np.ndarray) -> np.ndarray:
    """The digest of each row of a byte matrix, as a matrix of hex digests."""
    sha = hashlib.sha256
    return np.frombuffer(b"".join(sha(row).hexdigest().encode() for row in np.ascontiguousarray(rows)), np.uint8).reshape(-1, _WIDTH)


def level_above(nodes: np.ndarray, fanout: int) -> np.ndarray:
    """(n, 64) digests -> those of the runs of ``fanout``; the last run may be shorter."""
    full = len(nodes) // fanout * fanout
    out = _hashed(nodes[:full].reshape(-1, fanout * _WIDTH))
    return out if full == len(nodes) else np.concatenate((out, _hashed(nodes[full:].reshape(1, -1))))


def siblings(nodes: np.ndarray, fanout: int) -> list[bytes]:
    """For each node the digests of the others of its run, left to right."""
    full = len(nodes) // fanout * fanout
    out: list[bytes] = []
    for run in (nodes[:full].reshape(-1, fanout, _WIDTH), nodes[full:].reshape(1, -1, _WIDTH)):
        width = run.shape[1]
        if run.size:
            others = np.arange(width - 1) + (np.arange(width - 1) >= np.arange(width)[:, None])
            flat = np.ascontiguousarray(run[:, others]).reshape(len(run) * width, (width - 1) * _WIDTH)
            out += map(bytes, flat)
    return out


def _levels(n: int, fanout: int, most: int) -> int:
    """Rounds of hashing until one node of n is left, at most ``most``."""
    k = 0
    while n > 1 and k < most:
        n, k = -(-n // fanout), k + 1
    return k


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer("".join(column.to_pylist()).encode(), np.uint8).reshape(-1, _WIDTH)


def _text(row: np.ndarray) -> str:
    return row.tobytes().decode()


def folded(leaf: bytes, proof: bytes, places: list[tuple[int, int]], fanout: int) -> bytes:
    """The root that a leaf and its siblings give; ``places`` are (index, number of nodes) in each tree, from the leaf's up."""
    at = 0
    for pos, n in places:
        while n > 1:
            run, own = divmod(pos, fanout)
            width = min(fanout, n - run * fanout)
            others = proof[at : at + (width - 1) * _WIDTH]
            if len(others) != (width - 1) * _WIDTH:
                raise ValueError("a proof of another length")
            leaf = hashlib.sha256(others[: own * _WIDTH] + leaf + others[own * _WIDTH :]).hexdigest().encode()
            at, pos, n = at + len(others), run, -(-n // fanout)
    if at != len(proof):
        raise ValueError("a proof of another length")
    return leaf


_NODES = "grp long, pos long, n long, digest string"
_ABOVE = "grp long, pos long, above binary, top string, root string, grps long"


def _block_top(table: pa.Table, fanout: int, height: int) -> pa.Table:
    table = table.sort_by("pos")
    grp, pos, n = (table[c][0].as_py() for c in ("grp", "pos", "n"))
    nodes = _matrix(table["digest"])
    for _ in range(_levels(n, fanout, height)):
        nodes = level_above(nodes, fanout)
    size = fanout**height
    return pa.table({"grp": [grp], "pos": [pos // size], "n": [-(-n // size)], "digest": [_text(nodes[0])]})


def _paths(nodes: np.ndarray, levels: int, above: bytes, fanout: int) -> list[bytes]:
    """For each node of a block its siblings up to the root of everything."""
    steps = []
    for _ in range(levels):
        steps.append(siblings(nodes, fanout))
        nodes = level_above(nodes, fanout)
    out = [above] * len(nodes)
    for step in reversed(steps):  # a node's path ends with that of the node above it
        out = [own + out[k // fanout] for k, own in enumerate(step)]
    return out


def _nodes_above(table: pa.Table, given: pa.Table, fanout: int, height: int) -> pa.Table:
    table, row = table.sort_by("pos"), given.to_pylist()[0]
    paths = _paths(_matrix(table["digest"]), _levels(table["n"][0].as_py(), fanout, height), row["above"], fanout)
    k = len(paths)
    same = {c: pa.array([row[c]] * k, given.schema.field(c).type) for c in ("top", "root", "grps")}
    return pa.table({"grp": table["grp"], "pos": table["pos"], "above": pa.array(paths, pa.binary()), **same})


def _leaf_rows(table: pa.Table, given: pa.Table, fanout: int, height: int) -> pa.Table:
    table, row = table.sort_by("pos"), given.to_pylist()[0]
    grp, n = table["grp"][0].as_py(), table["n"][0].as_py()
    paths = _paths(_matrix(table["digest"]), _levels(n, fanout, height), row["above"], fanout)
    found = [
        folded((now or own).encode(), path, [(pos, n), (grp, row["grps"])], fanout).decode()
        for own, now, pos, path in zip(*(table[c].to_pylist() for c in ("digest", "claimed", "pos")), paths, strict=True)
    ]
    k = len(found)
    same = {"subroot": pa.array([row["top"]] * k, pa.string()), "root": pa.array([row["root"]] * k, pa.string())}
    return pa.table({"key": table["key"], "leaf": table["digest"], **same, "proof": pa.array(paths, pa.binary()), "folded_root": pa.array(found, pa.string())})


def _placed(df: DataFrame, order: list[str], ws: Workspace) -> DataFrame:
    """``df`` with ``place``, its index from 0 in the order of ``order``: ranges are sorted apart and the sizes of those before are added."""
    ordered = ws.table(df.orderBy(*order).withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id()))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ordered.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"))  # a row a range
    ranges = ranges.select("__part", (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift"))
    return ordered.join(F.broadcast(ranges), "__part").withColumn("place", F.col("__at") + F.col("__shift")).drop("__part", "__at", "__shift")


@dataclass(frozen=True)
class Manifest:
    """``rows``: key, group, leaf, subroot, root, proof (siblings' digests in a row, from the leaf's run up), folded_root, verified."""

    rows: DataFrame
    workspace: Workspace


def manifest(leaves: DataFrame, fanout: int = FANOUT, height: int = HEIGHT) -> Manifest:
    """The manifest of ``leaves`` (key, group, leaf, claimed).

    leaf is a hex digest.  claimed is one to be tested in its place, with the
    siblings as they were (null: the leaf itself); folded_root is what it gives
    and verified whether that is the root.  Groups and the leaves in one ascend
    by group and key, nulls first, strings bytewise; rows with one key are told
    apart by their leaf, and equal ones are equal leaves.  A group of one row
    has that leaf as subroot, a single group's subroot is the root.  Without
    rows the result is empty.  A null leaf is an error.
    """
    spark = leaves.sparkSession
    ws, size = Workspace(spark, "merkle"), fanout**height
    key, group = (leaves.schema[c].dataType.simpleString() for c in ("key", "group"))
    leaf = F.when(F.col("leaf").isNull(), F.raise_error(F.lit("a leaf is null"))).otherwise(F.col("leaf"))
    once = ws.table(leaves.select("key", "group", leaf.alias("leaf"), "claimed"))
    ordered = ws.table(_placed(once, ["group", "key", "leaf"], ws))
    groups = _placed(ordered.groupBy("group").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")), ["group"], ws)
    groups = ws.table(groups.select("group", "first", "n", F.col("place").alias("grp")))
    own = ordered.alias("o").join(groups.alias("g"), F.expr("o.group <=> g.group"))
    base = ws.table(own.select("grp", (F.col("place") - F.col("first")).alias("pos"), "n", F.col("o.leaf").alias("digest"), "claimed", "key", F.col("o.group").alias("group")))

    blocks = lambda df: df.groupBy("grp", F.expr(f"pos div {size}").alias("block"))

    def tree(nodes: DataFrame) -> list[DataFrame]:
        out = [nodes]
        while not out[-1].filter("n > 1").isEmpty():
            out.append(ws.table(blocks(out[-1].select("grp", "pos", "n", "digest")).applyInArrow(lambda t: _block_top(t, fanout, height), _NODES)))
        return out

    def carried(tables: list[DataFrame], above: DataFrame) -> DataFrame:
        """``above`` of each tree's top -> above of the nodes right over the blocks of the lowest table."""
        for nodes in reversed(tables[1:-1]):
            given = above.groupBy("grp", F.col("pos").alias("block"))
            above = ws.table(blocks(nodes).cogroup(given).applyInArrow(lambda t, g: _nodes_above(t, g, fanout, height), _ABOVE))
        return above

    own_trees = tree(base)
    tops = own_trees[-1].select("grp", "digest")
    count = groups.agg(F.count(F.lit(1)).alias("n"))  # one row
    joint = ws.table(tops.join(F.broadcast(count)).select(F.lit(0).cast("long").alias("grp"), F.col("grp").alias("pos"), "n", "digest"))
    joint_trees = tree(joint)
    root = joint_trees[-1].select(F.col("digest").alias("root"))  # one row
    none = F.lit(b"").alias("above")
    start = ws.table(joint_trees[-1].select("grp", F.lit(0).cast("long").alias("pos"), none, F.lit("").alias("top"), F.col("digest").alias("root"), F.col("n").alias("grps")))
    top_paths = carried(joint_trees, start)
    # each group's subroot as a leaf of the joint tree, with the siblings up to the root
    paths = blocks(joint).cogroup(top_paths.groupBy("grp", F.col("pos").alias("block"))).applyInArrow(lambda t, g: _nodes_above(t, g, fanout, height), _ABOVE)
    over = paths.select(F.col("pos").alias("grp"), "above").join(tops, "grp").join(F.broadcast(count.crossJoin(root)))
    over = ws.table(over.select("grp", F.lit(0).cast("long").alias("pos"), "above", F.col("digest").alias("top"), "root", F.col("n").alias("grps")))
    above = carried(own_trees, over)
    schema = f"key {key}, leaf string, subroot string, root string, proof binary, folded_root string"
    rows = blocks(base).cogroup(above.groupBy("grp", F.col("pos").alias("block"))).applyInArrow(lambda t, g: _leaf_rows(t, g, fanout, height), schema)
    ws.keep_only(base, above, groups)
    return Manifest(rows.withColumn("verified", F.col("folded_root") == F.col("root")), ws)


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered(text: Column) -> Column:
    """A-Z lower-cased, nothing else."""
    return F.translate(text, _UPPER, _LOWER)


def document_leaves(docs: DataFrame, every: int = 5) -> DataFrame:
    """(key, group, leaf, claimed) of documents: their five columns are digested, the source is the group.

    claimed is the digest with the text's A-Z lower-cased, where ``every``
    divides the CRC-32 of the doc_id in decimal (a null doc_id: not tampered
    with).  Further columns are ignored.
    """
    doc, text = F.col("doc_id"), F.col("text").cast("string")
    of = lambda t: digest(doc, F.col("source"), F.col("lang"), F.col("n_chars"), t)
    tampered = F.crc32(doc.cast("string").cast("binary")) % every == 0
    return docs.select(doc.alias("key"), F.col("source").cast("string").alias("group"), of(text).alias("leaf"), F.when(tampered, of(lowered(text))).alias("claimed"))
