"""Exact Jaccard components of word-shingle sets by a set-relation skipping join.

The join works on inverted lists (shingle -> sets that hold it in their prefix)
and skips in two ways.

* Index lists are kept in blocks by set size and position of the shingle in the
  set's global order; blocks that cannot reach the overlap a pair needs are
  skipped, as are lists and blocks whose sets are linked already.
* Answers of a set come from a set very like it.  A set within ``ABSORB`` of a
  verified leader has no entries of its own but for the prefix shingles that
  its leader's prefix lacks: Jaccard distance is a metric, so a partner of a
  member lies within the link distance plus the member's distance of the leader.
  Members are looked at one by one only where two leaders meet between the
  link distance and the wider one.

Every list is first read as a star around its most central sets (those with the
fewest rare shingles), so that a group of near copies is linked after about as
many pairs as it has sets; only then all pairs of different components are taken
from the lists that still hold several.  Of a component's pairs with others the
likeliest is verified first, the others only if they are not linked by then.

Equal sets are one class from the start.  The result is exact: every pair that
links ends in one component, and no pair that does not link joins two.  Sets
are known by 64-bit hashes of their shingles (two different classes of N clash
with a chance of about N * N / 4e19).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import merged, roots_of
from .text import mix, shingle_sets
from .workspace import Workspace

BANDS, ROWS = 8, 4
#: A set at most so far from a leader (and no further than a link) is answered through it.
ABSORB = 0.05
#: Shingles of at least so many documents (as far as the map tasks see them) rank last; at most HEAVY_MOST of them, 8 bytes each, go to every task.
HEAVY_FROM, HEAVY_MOST = 16, 1 << 18
#: Sets that one hub is verified against in one task.
FAN = 256
_FLUSH = 4 << 20  # shingles counted at once in a map task
BINS = 128


@dataclass(frozen=True)
class Likeness:
    """Words a shingle and the share, in hundredths, of the union that the intersection needs."""

    words: int = 5
    percent: int = 80

    @property
    def far(self) -> float:
        return 1 - self.percent / 100

    @property
    def absorb(self) -> float:
        return min(ABSORB, self.far)


def _node(own: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(own.tobytes(), seed=len(own)) - (1 << 63)


_EDGES = (np.arange(BANDS * ROWS, dtype=np.uint64) << np.uint64(64 - (BANDS * ROWS).bit_length() + 1))


def _minima(own: np.ndarray) -> np.ndarray:
    """The smallest shingle of each of BANDS * ROWS parts of the hash range (an empty part: its edge)."""
    at = np.searchsorted(own, _EDGES)
    return np.where(np.append(at[1:], len(own)) > at, own[np.minimum(at, len(own) - 1)], _EDGES)


def _bands(sets: list[np.ndarray]) -> list[list[int]]:
    """One hash for each band of ROWS minima."""
    least = np.array([_minima(own) for own in sets], np.uint64).reshape(-1, BANDS, ROWS)
    acc = least[:, :, 0] + np.arange(BANDS, dtype=np.uint64)
    for k in range(1, ROWS):
        acc = mix(acc) + least[:, :, k]
    return mix(acc).view(np.int64).tolist()


def _bins(own: np.ndarray) -> bytes | None:
    """How many shingles each of BINS parts of the hash range has: an exact bound of any overlap.  None if one has over 255."""
    counts = np.bincount((own >> np.uint64(57)).astype(np.int64), minlength=BINS)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else None


_SKETCH = pa.schema([("n", pa.int64()), ("node", pa.int64()), ("token", pa.int64())])


def _sketch(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """A row for each document (doc_id, n, node) and, apart, counts of shingles seen often (token, n)."""
    held, size = [], 0

    def made(ids: pa.Array, columns: list) -> pa.RecordBatch:
        arrays = [pa.nulls(len(ids), f.type) if c is None else pa.array(c, f.type) for c, f in zip(columns, _SKETCH, strict=True)]
        return pa.RecordBatch.from_arrays([ids, *arrays], ["doc_id", *_SKETCH.names])

    def often(kind: pa.DataType) -> pa.RecordBatch:
        flat = np.concatenate(held)
        held.clear()
        flat.sort()
        at = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1], [True])))
        counts = np.diff(at)
        tokens, counts = flat[at[:-1][counts >= 3]], counts[counts >= 3]
        return made(pa.nulls(len(tokens), kind), [counts, None, tokens.view(np.int64)])

    for batch in batches:
        sets = list(shingle_sets(batch.column("text").to_pylist(), words))
        some = [own if len(own) else None for own in sets]
        held += [own for own in some if own is not None]
        size += sum(map(len, sets))
        ids = batch.column("doc_id")
        yield made(ids, [[len(own) for own in sets], [None if own is None else _node(own) for own in some], None])
        if size >= _FLUSH:
            yield often(ids.type)
            size = 0
    if held:
        yield often(ids.type)


def _rare(own: np.ndarray, known: np.ndarray) -> int:
    """How many of the shingles are not in ``known``."""
    return len(own) if not len(known) else int((known[np.minimum(np.searchsorted(known, own), len(known) - 1)] != own).sum())


def _keyed(batches: Iterator[pa.RecordBatch], words: int, heavy) -> Iterator[pa.RecordBatch]:
    """(rep, node, n, rare, bands, bins, text) of texts with words."""
    known = heavy.value
    for batch in batches:
        texts = batch.column("text").to_pylist()
        sets = list(shingle_sets(texts, words))
        some = [k for k, own in enumerate(sets) if len(own)]
        own = [sets[k] for k in some]
        columns = [
            batch.column("doc_id").take(pa.array(some, pa.int64())), pa.array(map(_node, own), pa.int64()), pa.array(map(len, own), pa.int32()),
            pa.array([_rare(x, known) for x in own], pa.int32()), pa.array(_bands(own), pa.list_(pa.int64())), pa.array(map(_bins, own), pa.binary()), pa.array([texts[k] for k in some], pa.string()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["rep", "node", "n", "rare", "bands", "bins", "text"])


def _prefix(own: np.ndarray, known: np.ndarray, far: float) -> np.ndarray:
    """The shingles of which a partner within ``far`` shares one at least: rare ones first, then those in ``known``."""
    k = len(own) - int(np.ceil((1 - far) * len(own) - 1e-9)) + 1
    if not len(known):
        return own[:k]
    at = np.minimum(np.searchsorted(known, own), len(known) - 1)
    late = known[at] == own
    first = own[~late][:k]
    return first if len(first) == k else np.concatenate((first, own[late][: k - len(first)]))


def _postings(frames: Iterator[pd.DataFrame], words: int, heavy, far: float) -> Iterator[pd.DataFrame]:
    """(token, n, pos, node, comp, radius) for the prefix of each set."""
    known = heavy.value
    for pdf in frames:
        out = []
        sets = shingle_sets(pdf["text"].tolist(), words)
        for node, own, comp, radius in zip(pdf["node"], sets, pdf["comp"], pdf["radius"], strict=True):
            first = _prefix(own, known, far)
            k = len(first)
            out.append((first.view(np.int64), np.full(k, len(own), np.int32), np.arange(k, dtype=np.int32), np.full(k, node), np.full(k, comp), np.full(k, radius)))
        if out:
            columns = [np.concatenate(x) for x in zip(*out, strict=True)]
            yield pd.DataFrame(dict(zip(("token", "n", "pos", "node", "comp", "radius"), columns, strict=True)))


_BLOCK = 512


def _list_pairs(n, pos, node, comp, radius, far: float, block=None, bins=None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidate pairs of one inverted list that is sorted by (n, pos), block against block.

    ``block``: only pairs of different ones count.  ``bins`` (a row for each
    set) drop pairs that they show to share too little; two sets without bins
    (see _matrix) are bound by their sizes alone.
    """
    m = len(n)
    unbound = None if bins is None else bins.min(axis=1) == 255
    rest = n - pos
    starts = range(0, m, _BLOCK)
    floor = 1 - far - 2 * float(radius.max())
    tops = [(int(n[s : s + _BLOCK].max()), int(rest[s : s + _BLOCK].max()), float(radius[s : s + _BLOCK].max()), comp[s] if (comp[s : s + _BLOCK] == comp[s]).all() else None) for s in starts]
    for bi, i in enumerate(starts):
        a = slice(i, i + _BLOCK)
        least, rad, own = int(n[i]), tops[bi][2], tops[bi][3]
        for bj in range(bi, -1, -1):
            top, room, rad_j, own_j = tops[bj]
            t = 1 - far - rad - rad_j
            if top < floor * least - 1e-9:
                break  # every earlier block holds smaller sets still
            if top < t * least - 1e-9:
                continue
            if own is not None and own == own_j:
                continue  # answered already
            if min(room, tops[bi][1]) < t / (1 + t) * (least + int(n[bj * _BLOCK])) - 1e-9:
                continue  # too late in their sets to reach the overlap
            b = slice(bj * _BLOCK, bj * _BLOCK + _BLOCK)
            tt = (1 - far) - radius[a, None] - radius[None, b]
            need = tt / (1 + tt) * (n[a, None] + n[None, b]) - 1e-9
            ok = (np.minimum(rest[a, None], rest[None, b]) >= need) & (comp[a, None] != comp[None, b])
            ok &= np.minimum(n[a, None], n[None, b]) >= tt * np.maximum(n[a, None], n[None, b]) - 1e-9
            if block is not None:
                ok &= block[a, None] != block[None, b]
            x, y = np.nonzero(ok)
            need = need[x, y]
            x, y = x + i, y + b.start
            if bins is not None and len(x):
                some = [np.minimum(bins[x[s : s + _PAIRS]], bins[y[s : s + _PAIRS]]).sum(axis=1, dtype=np.int64) for s in range(0, len(x), _PAIRS)]
                ok = (np.concatenate(some) >= need) | (unbound[x] & unbound[y])
                x, y = x[ok], y[ok]
            x, y = node[x], node[y]
            yield np.minimum(x, y), np.maximum(x, y)


#: Lists up to this length are joined together, row against row at each distance.
_SHORT = 32
#: Rows joined at once (a longer list is joined alone).
_GATHER = 200_000
#: Pairs whose bins are compared at once.
_PAIRS = 1 << 15
#: Rows of a list in one block; longer lists are dealt to a task for each two blocks.
_LIST = 4096


def _fits(n, rest, radius, x, y, far: float) -> np.ndarray:
    """Whether the position and the sizes leave the pairs (x, y) room for the overlap that they need."""
    t = (1 - far) - radius[x] - radius[y]
    small, large = np.minimum(n[x], n[y]), np.maximum(n[x], n[y])
    return (np.minimum(rest[x], rest[y]) >= t / (1 + t) * (n[x] + n[y]) - 1e-9) & (small >= t * large - 1e-9)


def _short_pairs(token, n, pos, node, comp, radius, far: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidate pairs of many short lists that are sorted by (token, n, pos)."""
    rest = n - pos
    for d in range(1, _SHORT):
        same = np.flatnonzero((token[d:] == token[:-d]) & (comp[d:] != comp[:-d])) if d < len(token) else ()
        if d >= len(token) or not (token[d:] == token[:-d]).any():
            return
        x, y = same + d, same
        ok = _fits(n, rest, radius, x, y, far)
        x, y = node[x[ok]], node[y[ok]]
        yield np.minimum(x, y), np.maximum(x, y)


def _star_pairs(token, n, pos, node, comp, radius, far: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of each set with the centres (least position) of its own and the next sizes of its lists: three a row at most."""
    if not len(token):
        return node, node
    size = np.floor(np.log(n) / -np.log1p(-far / 2 - 1e-3)).astype(np.int64)
    run = np.cumsum(np.concatenate(([0], (token[1:] != token[:-1]) | (size[1:] != size[:-1]))))
    order = np.lexsort((node, pos, run))
    hub = order[np.searchsorted(run[order], np.arange(run[-1] + 1))]
    rest, every, found = n - pos, np.arange(len(token)), []
    for step in (-1, 0, 1):
        y = hub[np.clip(run + step, 0, run[-1])]
        ok = (token == token[y]) & (comp != comp[y])
        x, y = every[ok], y[ok]
        ok = _fits(n, rest, radius, x, y, far)
        found.append((node[x[ok]], node[y[ok]]))
    x, y = (np.concatenate(z) for z in zip(*found, strict=True))
    return np.minimum(x, y), np.maximum(x, y)


_ROW = ("token", "n", "pos", "node", "comp", "radius")


def _unique(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


def _stars(batches: Iterator[pa.RecordBatch], far: float) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (token, n, pos); yields them again, and apart from them (token null) pairs a < b.  A list may span several rounds."""
    held, rows = [], 0

    def out() -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        a, b = _unique(*_star_pairs(*[table.column(c).to_numpy() for c in _ROW], far))
        for batch in held:
            none = pa.nulls(len(batch), pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in _ROW], none, none], [*_ROW, "a", "b"])
        kinds = [held[0].schema.field(c).type for c in _ROW]
        yield pa.RecordBatch.from_arrays([*[pa.nulls(len(a), k) for k in kinds], pa.array(a), pa.array(b)], [*_ROW, "a", "b"])

    for batch in batches:
        if len(batch):
            held.append(batch)
            rows += len(batch)
        if rows >= _GATHER:
            yield from out()
            held, rows = [], 0
    if held:
        yield from out()


def _candidates(batches: Iterator[pa.RecordBatch], far: float, binned: bool) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (token, cell, n, pos); yields pairs a < b, without repeats among the rows joined at once.

    Rows with bins are those of long lists: each cell holds one block of its
    list (``own``) or two, of which only pairs of different blocks count.
    """
    columns = [*_ROW, "cell", "block", "own"] if binned else list(_ROW)
    held: list[list[np.ndarray]] = []

    def joined(arrays: list[np.ndarray]) -> pa.RecordBatch:
        token = arrays[0]
        if not binned:
            found = list(_short_pairs(*arrays, far)) if len(token) else []
        else:
            found, (cell, block, own, bins) = [], arrays[6:]
            edges = np.flatnonzero(np.concatenate(([True], (token[1:] != token[:-1]) | (cell[1:] != cell[:-1]), [True])))
            for k, e in zip(edges, edges[1:], strict=False):
                found += _list_pairs(*[x[k:e] for x in arrays[1:6]], far, None if own[k] else block[k:e], bins[k:e])
        a, b = _unique(*(np.concatenate(x) for x in zip(*found, strict=True))) if found else (np.zeros(0, np.int64),) * 2
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    rows = 0
    for batch in batches:
        if len(batch):
            held.append([batch.column(c).to_numpy(zero_copy_only=False) for c in columns])
            if binned:
                held[-1].append(_matrix(batch.column("bins")))
            rows += len(batch)
        if rows >= _GATHER // (8 if binned else 1):
            arrays = [np.concatenate(x) for x in zip(*held, strict=True)]
            last = (arrays[0] == arrays[0][-1]) & (arrays[6] == arrays[6][-1]) if binned else arrays[0] == arrays[0][-1]
            cut = int(np.argmax(last))  # the last list may go on
            if cut:
                yield joined([x[:cut] for x in arrays])
            held, rows = [[x[cut:] for x in arrays]], 0  # counts new rows, so that a long list is not copied over and over
    if held:
        yield joined([np.concatenate(x) for x in zip(*held, strict=True)])


def _matrix(column: pa.Array) -> np.ndarray:
    """A row of BINS counts for each value; a set without bins gets 255 in each, which bounds its overlap with a set that has some, but not with another such set."""
    blank = bytes([255]) * BINS
    return np.frombuffer(b"".join(x or blank for x in column.to_pylist()), np.uint8).reshape(-1, BINS)


def _possible(batches: Iterator[pa.RecordBatch], far: float) -> Iterator[pa.RecordBatch]:
    """Drops pairs whose bins alone show that they share too little; adds the likeness that the bins allow."""
    for batch in batches:
        get = lambda c: batch.column(c).to_numpy(zero_copy_only=False)  # noqa: B023, E731
        na, nb, t = get("na"), get("nb"), (1 - far) - get("ra") - get("rb")
        most = np.minimum(_matrix(batch.column("binsa")), _matrix(batch.column("binsb"))).sum(axis=1, dtype=np.int64)
        most = np.minimum(most, np.minimum(na, nb))
        for c in ("binsa", "binsb"):
            if batch.column(c).null_count:
                unknown = np.array([x is None for x in batch.column(c).to_pylist()], bool)
                most = np.where(unknown, np.minimum(na, nb), most)
        ok = most >= t / (1 + t) * (na + nb) - 1e-9
        kept = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(most / (na + nb - most))], ["a", "b", "bound"])
        yield kept.filter(pa.array(ok))


def _verify(frames: Iterator[pd.DataFrame], words: int, heavy, far: float, absorb: float) -> Iterator[pd.DataFrame]:
    """Rows come sorted by (a, salt, other), each hub's own text first (other is false).

    For sets within ``absorb`` of their hub ``tokens`` and ``places`` have what
    their prefix holds beyond the hub's, and its positions.
    """
    hub, own, known, first = None, None, heavy.value, None
    for pdf in frames:
        rows = []
        sets = shingle_sets(pdf["text"].tolist(), words)
        for a, salt, is_other, b, other in zip(pdf["a"], pdf["salt"], pdf["other"], pdf["b"], sets, strict=True):
            if not is_other:
                hub, own, first = (a, salt), other, None
                continue
            if hub != (a, salt):
                raise RuntimeError("a pair without its hub")
            at = np.minimum(np.searchsorted(own, other), len(own) - 1)
            both = int((own[at] == other).sum())
            either, tokens, places = len(own) + len(other) - both, None, None
            if 1 - both / either <= absorb + 1e-12:
                first = np.sort(_prefix(own, known, far)) if first is None else first
                mine = _prefix(other, known, far)
                at = np.minimum(np.searchsorted(first, mine), len(first) - 1)
                places = np.flatnonzero(first[at] != mine)
                tokens = mine[places].view(np.int64)
            rows.append((a, b, len(other), both, either, tokens, places))
        yield pd.DataFrame(rows, columns=["a", "b", "n", "both", "either", "tokens", "places"])


class _Join:
    def __init__(self, docs: DataFrame, like: Likeness, name: str):
        self.like, self.ws, self.spark = like, Workspace(docs.sparkSession, name), docs.sparkSession
        self.docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
        self.parts = max(2, int(self.spark.conf.get("spark.sql.shuffle.partitions")))

    def verified(self, pairs: DataFrame, absorb: float = -1.0) -> DataFrame:
        """(a, b, n of b, both, either, tokens, places) of the pairs (a, b): the hub's text is sent once to every FAN of its partners."""
        words, far, heavy = self.like.words, self.like.far, self.heavy
        degree = pairs.groupBy("a").agg(F.ceil(F.count("b") / FAN).alias("salts"))
        hubs = self.texts.join(degree, F.col("node") == F.col("a")).select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt"), F.lit(False).alias("other"), F.col("a").alias("b"), "text")
        dealt = pairs.join(degree, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("salts")).alias("salt"))
        others = self.texts.join(dealt, F.col("node") == F.col("b")).select("a", "salt", F.lit(True).alias("other"), "b", "text")
        both = hubs.unionByName(others).repartition(self.parts, "a", "salt").sortWithinPartitions("a", "salt", "other")
        schema = "a long, b long, n int, both long, either long, tokens array<long>, places array<int>"
        return self.ws.table(both.mapInPandas(lambda f: _verify(f, words, heavy, far, absorb), schema))

    def linked(self, checked: DataFrame) -> DataFrame:
        return checked.filter(F.col("both") * 100 >= F.col("either") * self.like.percent)

    def possible(self, pairs: DataFrame, radii: DataFrame | None = None) -> DataFrame:
        """(a, b, bound) of the pairs that the bins allow; ``radii`` (node, radius) widen what is allowed."""
        far = self.like.far
        sized = self.bins if radii is None else self.bins.join(radii, "node", "left")
        radius = F.lit(0.0) if radii is None else F.coalesce("radius", F.lit(0.0))
        of = lambda s: sized.select(F.col("node").alias(s), radius.alias(f"r{s}"), F.col("n").alias(f"n{s}"), F.col("bins").alias(f"bins{s}"))
        both = pairs.join(of("a"), "a").join(of("b"), "b")
        return self.ws.table(both.mapInArrow(lambda f: _possible(f, far), "a long, b long, bound double"))

    def apart(self, pairs: DataFrame, comps: DataFrame) -> DataFrame:
        """The pairs of different components, with these as (ca, cb)."""
        of = lambda side: comps.select(F.col("node").alias(side), F.col("comp").alias(f"c{side}"))
        placed = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
        return placed.withColumns({"ca": F.coalesce("ca", "a"), "cb": F.coalesce("cb", "b")}).filter("ca <> cb")

    def settle(self, pairs: DataFrame, comps: DataFrame, checked: list[DataFrame], rounds: int, rest: bool) -> DataFrame:
        """The components after ``rounds`` in which each component's likeliest pair is verified, and (``rest``) then all other pairs.

        A round links a group around a hub whatever the hub's name is.  Pairs have one order, (bound, a, b), by which each
        component picks its first: such picks make no cycle, but that two components may pick the same pair.
        """
        for k in range(rounds + rest):
            left = self.apart(pairs, comps).join(self.union(checked), ["a", "b"], "left_anti")
            if k < rounds:
                ends = F.explode(F.array(F.struct(F.col("ca").alias("c"), F.col("cb").alias("other")), F.struct(F.col("cb").alias("c"), F.col("ca").alias("other"))))
                sided = left.select("bound", "a", "b", ends.alias("end"))
                best = sided.groupBy(F.col("end.c").alias("c")).agg(F.max(F.struct("bound", "a", "b", "end.other")).alias("best"))
                left = best.groupBy("best.a", "best.b").agg(F.max(F.struct("c", "best.other")).alias("end"))  # of two that pick one pair the larger name joins the smaller
            left, rows = self.ws.counted(left.select("a", "b", *(["end"] if k < rounds else [])))
            if not rows:
                break
            checked.append(self.verified(left.select("a", "b")))
            linked = self.linked(checked[-1]).select("a", "b")
            if k < rounds:
                links = linked.join(left, ["a", "b"]).select(F.col("end.other").alias("a"), F.col("end.c").alias("b"))
            else:
                links = self.apart(linked, comps).select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b"))
            links, rows = self.ws.counted(links)
            if rows:
                comps = merged(comps, links, self.ws, forest=k < rounds)
        return comps

    def union(self, checked: list[DataFrame], *columns: str) -> DataFrame:
        """The verified pairs, with a < b."""
        parts = [x.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), *columns) for x in checked]
        return reduce(DataFrame.unionByName, parts)

    def joined(self, nodes: DataFrame, comps: DataFrame, checked: list[DataFrame], extras: DataFrame | None = None) -> DataFrame:
        """The components after all pairs of ``nodes`` (node, comp, radius) that may link are settled.

        ``extras`` are further entries (token, n, pos, node, comp, radius) of the lists.
        """
        ws, words, far, heavy = self.ws, self.like.words, self.like.far, self.heavy
        rows = self.texts.join(nodes, "node").select("node", "text", "comp", "radius")
        postings = rows.mapInPandas(lambda f: _postings(f, words, heavy, far), "token long, n int, pos int, node long, comp long, radius double")
        if extras is not None:
            postings = postings.unionByName(extras)
        lists = Window.partitionBy("token")
        dealt = (
            postings.repartition(self.parts, "token")
            .withColumns({"low": F.min("comp").over(lists), "high": F.max("comp").over(lists)})
            .filter("low <> high")  # one set, or sets that are linked already
            .drop("low", "high")
            .sortWithinPartitions("token", "n", "pos")
        )
        stars = ws.table(dealt.mapInArrow(lambda f: _stars(f, far), "token long, n int, pos int, node long, comp long, radius double, a long, b long"))
        radii = nodes.filter("radius > 0").select("node", "radius")
        star = self.possible(stars.filter("token is null").select("a", "b").distinct(), radii)
        comps = self.settle(star, comps, checked, 1, False)

        # what is left: lists that still hold several components, long ones block against block with their bins
        live = stars.filter("token is not null").drop("a", "b").join(comps.select("node", F.col("comp").alias("to")), "node", "left")
        live = live.select("token", "n", "pos", "node", F.coalesce("to", "comp").alias("comp"), "radius").repartition(self.parts, "token")
        live = ws.table(live.withColumns({"low": F.min("comp").over(lists), "high": F.max("comp").over(lists), "rows": F.count(F.lit(1)).over(lists)}).filter("low <> high").drop("low", "high"))
        ws.drop(stars)
        short = live.filter(F.col("rows") <= _SHORT).repartition(self.parts, "token").sortWithinPartitions("token", "n", "pos")
        blocks = F.ceil(F.col("rows") / _LIST)
        long = live.filter(F.col("rows") > _SHORT).withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
        long = long.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        long = long.withColumns({"cell": F.least("block", "other") * F.col("blocks") + F.greatest("block", "other"), "own": F.col("block") == F.col("other")})
        long = long.join(self.bins.select("node", "bins"), "node").select(*_ROW, "cell", "block", "own", "bins")
        long = long.repartition(self.parts, "token", "cell").sortWithinPartitions("token", "cell", "n", "pos")
        found = short.mapInArrow(lambda f: _candidates(f, far, False), "a long, b long").unionByName(long.mapInArrow(lambda f: _candidates(f, far, True), "a long, b long"))
        return self.settle(self.possible(found.distinct(), radii), comps, checked, 1, True)

    def run(self) -> DataFrame:
        ws, words, like = self.ws, self.like.words, self.like
        kind = self.docs.schema["doc_id"].dataType.simpleString()
        sketch = ws.table(self.docs.mapInArrow(lambda f: _sketch(f, words), f"doc_id {kind}, n long, node long, token long"))
        base = sketch.filter("token is null").select("doc_id", "n", "node")
        counted = sketch.filter("token is not null").groupBy("token").agg(F.sum("n").alias("n")).filter(F.col("n") >= HEAVY_FROM)
        top = counted.orderBy(F.desc("n"), "token").limit(HEAVY_MOST).select("token").toPandas()["token"]
        self.heavy = heavy = self.spark.sparkContext.broadcast(np.sort(top.to_numpy().astype(np.int64).view(np.uint64)))

        # a row for each class of equal sets, bucketed so that later joins on node move small rows only
        table = f"cladeworks_sets_{ws.root.rsplit('-', 1)[1]}"
        keyed = self.docs.mapInArrow(lambda f: _keyed(f, words, heavy), f"rep {kind}, node long, n int, rare int, bands array<long>, bins binary, text string")
        same = [F.first(c).alias(c) for c in ("n", "rare", "bands", "bins", "text")]
        keyed.groupBy("node").agg(F.min("rep").alias("rep"), *same).write.bucketBy(self.parts, "node").option("path", f"{ws.root}/sets").saveAsTable(table)
        try:
            sets = self.spark.table(table)
            self.texts, self.bins = sets.select("node", "text"), sets.select("node", "n", "bins")
            classes = sets.select("node", "rep", "rare", "bands")
            comps = self.components(classes)
            least = classes.join(comps, "node").groupBy("comp").agg(F.min("rep").alias("component_id"))
            joined = comps.join(least, "comp").select("node", "component_id")
            own = ws.table(classes.join(joined, "node", "left").select("node", F.coalesce("component_id", "rep").alias("component_id")))
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            ws.drop_folder("sets")
        out = base.select("doc_id", F.col("n").alias("n_shingles"), "node").join(own, "node", "left")
        result = ws.table(out.select("doc_id", "n_shingles", F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))
        ws.keep_only(result)
        return result

    def components(self, classes: DataFrame) -> DataFrame:
        """(node, comp) of all classes that link with another."""
        ws, like = self.ws, self.like
        # leaders: of each band the set with the fewest rare shingles, so the middle of a group; each set is verified against the likeliest of its own
        banded = classes.select("node", F.struct("rare", "node").alias("rank"), F.explode("bands").alias("band"))
        shared = banded.groupBy("band").agg(F.min("rank").alias("lead"), F.count("node").alias("n")).filter("n > 1").select("band", F.col("lead.node").alias("a"))
        near = self.possible(banded.drop("rank").join(shared, "band").filter("node <> a").select("a", F.col("node").alias("b")).distinct())
        first = self.verified(ws.table(near.groupBy("b").agg(F.max(F.struct("bound", "a")).alias("best")).select("best.a", "b")), like.absorb)
        comps = roots_of(self.linked(first).select("a", "b"), ws)  # each set has one leader, and that one of fewer rare shingles, or of a smaller name
        checked = [first]
        close = first.filter("tokens is not null").withColumn("radius", 1 - F.col("both") / F.col("either"))
        roots = close.select("a").distinct().join(close.select(F.col("b").alias("a")).distinct(), "a", "left_anti")
        members = ws.table(close.join(roots, "a").select(F.col("b").alias("node"), "a", "radius", "n", "tokens", "places"))
        reach = members.groupBy("a").agg(F.max("radius").alias("radius")).withColumnRenamed("a", "node")
        known = classes.select("node").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        leaders = known.join(members.select("node"), "node", "left_anti").join(reach, "node", "left").withColumn("radius", F.coalesce("radius", F.lit(0.0)))
        own = members.join(comps, "node").select("node", "comp", "n", F.explode(F.arrays_zip("tokens", "places")).alias("t"))
        extras = own.select(F.col("t.tokens").alias("token"), "n", F.col("t.places").alias("pos"), "node", "comp", F.lit(0.0).alias("radius"))
        comps = self.joined(ws.table(leaders), comps, checked, extras)

        # members of two leaders that are not linked but near enough that their members may be
        radius = lambda side: reach.select(F.col("node").alias(side), F.col("radius").alias(f"r{side}"))
        zero = lambda c: F.coalesce(c, F.lit(0.0))
        unsettled = self.union(checked, "both", "either").filter(F.col("both") * 100 < F.col("either") * like.percent)
        for side in "ab":
            unsettled = unsettled.join(radius(side), side, "left")
        distance = 1 - F.col("both") / F.col("either")
        unsettled = self.apart(unsettled.filter("ra is not null or rb is not null").filter(distance <= F.lit(like.far + 1e-9) + zero(F.col("ra")) + zero(F.col("rb"))), comps)
        hubs, rows = ws.counted(unsettled.select(F.explode(F.array("a", "b")).alias("node")).distinct())
        if rows:
            every = hubs.unionByName(members.join(hubs.withColumnRenamed("node", "a"), "a").select("node")).distinct()
            nodes = every.join(comps, "node", "left").select("node", F.coalesce("comp", "node").alias("comp"), F.lit(0.0).alias("radius"))
            comps = self.joined(ws.table(nodes), comps, checked)
        return comps


def link_components(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """doc_id, n_shingles, component_id for every document.

    component_id is the smallest doc_id reachable by links (its own, if none).
    Texts without words (null, empty, white space) have an empty set and link
    with nothing, not even each other.  Repeated rows and equal texts share a
    component; a null doc_id never names a component unless no other does;
    other columns are ignored; an empty table gives an empty result.
    """
    return _Join(docs, like, "jaccard").run()


def _free(stem: str, columns: list[str]) -> str:
    """A name that no column has (Spark takes names that differ in case as equal)."""
    taken = {c.lower() for c in columns}
    while stem in taken:
        stem += "_"
    return stem


def keep_one(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """The rows of ``docs`` with one document left of each component: that with the smallest doc_id.

    Rows are told apart by doc_id and text, so texts that share a doc_id are
    judged one by one; of those with words that are equal in both one row stays,
    and so does one of a component whose rows have no doc_id (null ids come
    last, and by a hash of their text).  Documents without words all stay,
    repeated or not.  All columns are kept, whatever their names; an empty
    table gives an empty result.
    """
    key, doc, text = _free("key", docs.columns), F.col("doc_id"), F.col("text")
    keyed = docs.withColumn(key, F.xxhash64(doc, doc.isNull(), text, text.isNull()))
    # as its doc_id each row has (none, doc_id, key), so a component is named by its row with the smallest doc_id
    row = F.struct(doc.isNull().alias("none"), doc.alias("doc_id"), F.col(key).alias("key"))
    found = link_components(keyed.select(row.alias("doc_id"), "text"), like).select(F.col("doc_id").alias("row"), "n_shingles", F.col("component_id").alias("component"))
    stay = found.filter("row = component").groupBy(F.col("row.key").alias(key)).agg((F.max("n_shingles") > 0).alias("worded"), F.count(F.lit(1)).alias("rows"))
    left = keyed.join(stay.select(key), key, "left_semi")
    again = stay.filter("worded and rows > 1").select(key)
    if again.isEmpty():
        return left.select(docs.columns)
    repeated = left.join(again, key, "left_semi").dropDuplicates([key])
    return left.join(again, key, "left_anti").unionByName(repeated).select(docs.columns)
