"""Hierarchical weighted hash tree: rows descend region, rack and shard by weighted hash draws.

Every node of the tree has a weight (the sum of its shards' weights).  At each
level the children of the node reached so far draw ``-ln(u) / weight`` with
``u`` a uniform hash of (key, node name); the smallest draw wins.  A child wins
with a probability in proportion to its weight, and a changed weight moves rows
only into (grown) or out of (shrunk) that child, so movement stays in the
subtrees whose weights change.  ``grow`` adds one shard as a region of its own:
rows then move into the new shard only.

Everything is SQL expressions; a draw uses the first 52 bits of an MD5, so that
any engine can repeat it.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


@dataclass(frozen=True)
class Shard:
    number: int
    region: str
    rack: str
    weight: float = 1.0


@dataclass(frozen=True)
class Topology:
    shards: tuple[Shard, ...]

    @classmethod
    def balanced(cls, regions: int = 2, racks: int = 2, per_rack: int = 2) -> Topology:
        """regions x racks x per_rack shards of equal weight, numbered from 0."""
        return cls(
            tuple(
                Shard((a * racks + b) * per_rack + c, f"r{a}", f"r{a}k{b}")
                for a in range(regions)
                for b in range(racks)
                for c in range(per_rack)
            )
        )

    def grow(self, weight: float = 1.0) -> Topology:
        """One more shard, alone in a new region: rows move only into it."""
        n = max((s.number for s in self.shards), default=-1) + 1
        return Topology((*self.shards, Shard(n, f"g{n}", f"g{n}k0", weight)))

    def reweight(self, number: int, weight: float) -> Topology:
        return Topology(tuple(replace(s, weight=weight) if s.number == number else s for s in self.shards))


def draw(key: Column, node: str) -> Column:
    """Uniform in (0, 1), decided by the key and the node's name."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(f"/{node}")).cast("binary")), 1, 13), 16, 10)
    return (bits.cast("double") + F.lit(0.5)) / F.lit(2.0**52)


def _pick(key: Column, children: list[tuple[str, float, Column]]) -> Column:
    """The value of the child with the smallest weighted draw; ties go to the first by name."""
    live = sorted((c for c in children if c[1] > 0), key=lambda c: c[0])
    if not live:
        return F.lit(None).cast("int")
    if len(live) == 1:
        return live[0][2]
    draws = [-F.log(draw(key, name)) / F.lit(float(w)) for name, w, _ in live]
    best = F.least(*draws)
    out = F.when(draws[0] == best, live[0][2])
    for d, (_, _, value) in zip(draws[1:], live[1:], strict=True):
        out = out.when(d == best, value)
    return out


def assign(key: Column, topology: Topology) -> Column:
    """The shard number of a key.  A null key is the key ''."""
    key = F.coalesce(key.cast("string"), F.lit(""))
    regions: dict[str, dict[str, list[Shard]]] = {}
    for s in topology.shards:
        regions.setdefault(s.region, {}).setdefault(s.rack, []).append(s)
    total = lambda shards: sum(s.weight for s in shards if s.weight > 0)
    level1 = []
    for region, racks in regions.items():
        level2 = [
            (rack, total(shards), _pick(key, [(f"{rack}s{s.number}", s.weight, F.lit(s.number)) for s in shards]))
            for rack, shards in racks.items()
        ]
        level1.append((region, sum(w for _, w, _ in level2), _pick(key, level2)))
    return _pick(key, level1).cast("int")


def slots(df: DataFrame, shard: str, order: list[str], slot: str = "slot", buckets: int = 64) -> DataFrame:
    """Adds a gapless number from 0 within each shard.

    Rows are dealt to ``buckets`` hash buckets per shard, so no task holds a
    whole shard; the start of each bucket is a running sum over the
    (shard, bucket) counts, a table of ``shards x buckets`` rows.  Within a
    bucket rows are numbered in the given order (nulls first; rows that tie in
    all of it are alike).
    """
    b, before, first = (f"__slot_{x}" for x in ("bucket", "n", "first"))
    dealt = df.withColumn(b, F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    sums = Window.partitionBy(shard).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        dealt.groupBy(shard, b)
        .agg(F.count(F.lit(1)).alias(before))
        .select(shard, b, F.coalesce(F.sum(before).over(sums), F.lit(0)).alias(first))
    )
    own = Window.partitionBy(shard, b).orderBy(*order)
    numbered = dealt.withColumn(slot, F.row_number().over(own).cast("long") - 1)
    return (
        numbered.join(F.broadcast(starts), [shard, b])  # at most shards x buckets rows
        .withColumn(slot, F.col(slot) + F.col(first))
        .drop(b, first)
    )


def shard_documents(docs: DataFrame, topology: Topology, buckets: int = 64) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of ``docs``.

    Law ``key``: doc_id and the topology decide.  Size is the text's UTF-8
    bytes plus 1 (null text: 1, CRC 0); an empty table gives an empty result;
    repeated rows land in one shard on slots of their own; other columns are
    ignored; a null doc_id is placed like the key ''.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
        assign(F.col("doc_id"), topology).alias("shard"),
        assign(F.col("doc_id"), topology.grow()).alias("grown_shard"),
    )
    numbered = slots(rows, "shard", ["doc_id"], buckets=buckets)
    return numbered.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
