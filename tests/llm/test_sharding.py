import hashlib
import math
import zlib
from collections import Counter

from pyspark.sql import functions as F

from cladeworks.llm.sharding import Topology, assign, shard_documents


def _draw(key: str, node: str) -> float:
    return (int(hashlib.md5(f"{key}/{node}".encode()).hexdigest()[:13], 16) + 0.5) / 2.0**52


def _descend(key: str, shards) -> int:
    def pick(groups):
        live = sorted((name, w, v) for name, (w, v) in groups.items())
        return live[0][2] if len(live) == 1 else min(live, key=lambda c: (-math.log(_draw(key, c[0])) / c[1], c[0]))[2]

    tree = {}
    for s in shards:
        tree.setdefault(s.region, {}).setdefault(s.rack, []).append(s)
    racks = pick({r: (float(sum(s.weight for x in k.values() for s in x)), k) for r, k in tree.items()}) if len(tree) > 1 else next(iter(tree.values()))
    own = pick({r: (float(sum(s.weight for s in x)), x) for r, x in racks.items()}) if len(racks) > 1 else next(iter(racks.values()))
    return pick({f"{s.rack}s{s.number}": (s.weight, s.number) for s in own})


def test_matches_brute_force(spark):
    top = Topology.balanced().reweight(3, 2.5)
    rows = spark.range(300).select("id", assign(F.col("id"), top).alias("s"), assign(F.col("id"), top.grow()).alias("g")).collect()
    for r in rows:
        assert r["s"] == _descend(str(r["id"]), top.shards)
        assert r["g"] == _descend(str(r["id"]), top.grow().shards)


def test_growth_and_weights_confine_movement(spark):
    top = Topology.balanced()
    heavier = top.reweight(5, 3.0)
    rows = spark.range(4000).select(*[assign(F.col("id"), t).alias(n) for n, t in (("a", top), ("b", top.grow()), ("c", heavier))]).collect()
    assert all(r["b"] in (r["a"], 8) for r in rows)
    n = Counter(r["a"] for r in rows)
    assert set(n) == set(range(8)) and max(n.values()) < 1.3 * min(n.values())
    # region r1 (shards 4-7) has grown: nothing leaves it, and rows that stay below rack r1k1 do not move
    assert all(r["c"] >= 4 for r in rows if r["a"] >= 4)
    assert all(r["c"] == r["a"] for r in rows if r["a"] < 4 and r["c"] < 4)
    assert all(r["c"] == r["a"] for r in rows if r["a"] in (6, 7) and r["c"] in (6, 7))


def test_documents(spark, odd_docs, odd_rows, no_docs):
    out = shard_documents(odd_docs, Topology.balanced(), buckets=5).collect()
    assert len(out) == len(odd_rows)
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in odd_rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == want
    for s in {r["shard"] for r in out}:
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sum(r["shard"] == s for r in out)))
    assert all(r["grown_shard"] in (r["shard"], 8) and r["law"] == "key" for r in out)
    assert shard_documents(no_docs, Topology.balanced()).count() == 0
