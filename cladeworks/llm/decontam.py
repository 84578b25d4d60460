"""Benchmark decontamination by a broadcast hash set of normalised test n-grams.

Windows of 13 consecutive words of each benchmark item (an item of fewer words
is one window) go to every task as a sorted hash array; the windows of each
training text are looked up there and every hit is verified word by word.
A benchmark above the broadcast bound is not sent to the tasks: its windows
meet those of the documents in an equi-join on the window hash instead.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import ALNUM_TABLE, alnum_words, mix, word_hashes
from .workspace import Workspace, plain_names

WINDOW = 13
#: Broadcast only up to so many UTF-8 bytes of benchmark text (some 10 times that in a task's memory).
BROADCAST_BYTES = 16 << 20

_B = 0x9E3779B97F4A7C15 | 1
_B_INV = pow(_B, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    return np.concatenate(([np.uint64(1)], np.cumprod(np.full(max(n - 1, 0), base, np.uint64), dtype=np.uint64)))[:n]


def window_hashes(words: np.ndarray, lengths: list[int]) -> dict[int, np.ndarray]:
    """length -> hash of the window that starts at each position (a rolling polynomial mod 2**64)."""
    n = len(words)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * _powers(_B, n), dtype=np.uint64)))
    back = _powers(_B_INV, n)
    return {m: mix((sums[m:] - sums[:-m]) * back[: n - m + 1] + np.uint64(m)) for m in lengths if m <= n}


def item_windows(items: list[tuple[object, str | None]], window: int = WINDOW) -> dict[int, dict[int, list[tuple[tuple[bytes, ...], list]]]]:
    """window length -> hash -> [(words, item ids)]."""
    out: dict = defaultdict(lambda: defaultdict(dict))
    for item, text in items:
        words = alnum_words(text)
        if not words:
            continue
        m = min(window, len(words))
        for start, h in enumerate(window_hashes(word_hashes(words), [m])[m].tolist()):
            out[m][h].setdefault(tuple(words[start : start + m]), set()).add(item)
    return {m: {h: [(w, sorted(map(str, ids))) for w, ids in by.items()] for h, by in own.items()} for m, own in out.items()}


class Matcher:
    def __init__(self, items: list[tuple[object, str | None]], window: int = WINDOW):
        self.by = item_windows(items, window)
        self.sorted = {m: np.array(sorted(own), np.uint64) for m, own in self.by.items()}

    def hits(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words lie in an occurrence of a window, and whose windows occur."""
        hit, items = np.zeros(len(words), bool), set()
        if not words or not self.sorted:
            return hit, items
        for m, hashes in window_hashes(word_hashes(words), list(self.sorted)).items():
            known = self.sorted[m]
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            for i in np.nonzero(known[at] == hashes)[0].tolist():
                own = tuple(words[i : i + m])
                for window, ids in self.by[m][int(hashes[i])]:
                    if window == own:
                        hit[i : i + m] = True
                        items.update(ids)
        return hit, items


def spans(hit: np.ndarray) -> list[tuple[int, int]]:
    """Word spans [from, to) of consecutive hit words."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def cut(text: str, hit: np.ndarray) -> str:
    """The text without its hit word spans (with what lies between the words of a span)."""
    raw = text.encode("utf-8", "surrogatepass")
    inside = np.frombuffer(raw.translate(ALNUM_TABLE), np.uint8) != 0x20
    edges = np.diff(np.concatenate(([0], inside.astype(np.int8), [0])))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    out, at = [], 0
    for a, b in spans(hit):
        out.append(raw[at : starts[a]])
        at = ends[b - 1]
    return b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass")


def _digest(items: set[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


def _scan(batches: Iterator[pa.RecordBatch], matcher: Matcher, share: int) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    for batch in batches:
        rows = []
        for text in batch.column("text").to_pylist():
            words = alnum_words(text)
            hit, items = matcher.hits(words)
            n = int(hit.sum())
            rows.append((len(words), n, len(items), _digest(items), n > 0 and share * n >= len(words)))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 5, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)


def _clean(batches: Iterator[pa.RecordBatch], matcher: Matcher, share: int, cut_spans: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep, texts = [], []
        for text in batch.column("text").to_pylist():
            words = alnum_words(text)
            hit, _ = matcher.hits(words)
            n = int(hit.sum())
            keep.append(not (n > 0 and share * n >= len(words)))
            texts.append(cut(text, hit) if cut_spans and n and keep[-1] else text)
        if cut_spans:
            at = batch.schema.get_field_index("text")
            batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
        yield batch.filter(pa.array(keep, pa.bool_()))


def _items(benchmark: DataFrame, bound: int) -> list[tuple[object, str | None]] | None:
    """The benchmark's rows, or None if they exceed the broadcast bound."""
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    return [tuple(r) for r in items.collect()] if size <= bound else None


def _with_id_type(docs: DataFrame) -> str:
    return docs.schema["doc_id"].dataType.simpleString()


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every document.

    A null or wordless text has no words and is clean; without items (or an
    empty benchmark) the digest is that of the empty string.  Repeated rows are
    judged one by one; other columns are ignored.
    """
    items = _items(benchmark, broadcast_bytes)
    if items is None:
        return _report_by_join(docs, benchmark, window, share)
    sent = docs.sparkSession.sparkContext.broadcast(items)
    schema = f"doc_id {_with_id_type(docs)}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        lambda batches: _scan(batches, _matcher(sent, window), share), schema
    )


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20, mode: str = "documents", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The columns of ``docs`` without contaminated documents; ``mode="spans"`` also cuts hit spans out of the others.

    Each row is judged alone, whatever the benchmark's size: repeated rows stay
    or go together, rows that share a doc_id (or have none) do not.  Null and
    wordless texts stay as they are; without items nothing goes; an empty table
    gives an empty result; all columns are kept, whatever their names.
    """
    names, docs = docs.columns, plain_names(docs)
    items = _items(benchmark, broadcast_bytes)
    if items is None:
        return _clean_by_join(docs, benchmark, window, share, mode == "spans").toDF(*names)
    sent = docs.sparkSession.sparkContext.broadcast(items)
    return docs.mapInArrow(lambda batches: _clean(batches, _matcher(sent, window), share, mode == "spans"), docs.schema).toDF(*names)


_MATCHERS: dict = {}


def _matcher(sent, window: int) -> Matcher:
    """One matcher a worker process and broadcast."""
    key = (id(sent.value), window)  # the cache keeps the value, so its id stays its own
    if key not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[key] = (Matcher(sent.value, window), sent.value)
    return _MATCHERS[key][0]


def _windows(frames: Iterator[pd.DataFrame], lengths: list[int], window: int | None) -> Iterator[pd.DataFrame]:
    for pdf in frames:
        out = []
        for row in pdf.itertuples(index=False):
            words = alnum_words(row.text)
            sizes = [min(window, len(words))] if window else lengths
            for m, hashes in (window_hashes(word_hashes(words), sizes) if words else {}).items():
                texts = [b" ".join(words[i : i + m]) for i in range(len(hashes))]
                out.append(pd.DataFrame({"id": row.id, "at": np.arange(len(hashes)), "m": m, "h": hashes.view(np.int64), "n": len(words), "w": texts}))
        if out:
            yield pd.concat(out)


def _hits_by_join(own: DataFrame, benchmark: DataFrame, window: int) -> DataFrame:
    """id, at, m, item: where windows of the benchmark occur in ``own`` (id, text)."""
    schema = "id {}, at long, m long, h long, n long, w binary"
    item = benchmark.select(F.col("item_id").cast("string").alias("id"), F.col("text").cast("string").alias("text"))
    grams = item.mapInPandas(lambda f: _windows(f, [], window), schema.format("string")).select("id", "m", "h", "w").distinct()
    lengths = [r[0] for r in grams.select("m").distinct().collect()]  # at most ``window`` values
    mine = own.select("id", "text").mapInPandas(lambda f: _windows(f, lengths, None), schema.format("long"))
    return mine.select("id", "at", "m", "h", "w").join(grams.withColumnRenamed("id", "item"), ["m", "h", "w"]).select("id", "at", "m", "item")


def _hit_words(hits: DataFrame) -> DataFrame:
    return hits.select("id", F.explode(F.sequence("at", F.col("at") + F.col("m") - 1)).alias("i")).distinct()


def _cut_hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches whose last column has the positions of hit words: cuts these out of the text and drops the column."""
    for batch in batches:
        at, texts = batch.schema.get_field_index("text"), []
        for text, places in zip(batch.column("text").to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
            if places:
                hit = np.zeros(len(alnum_words(text)), bool)
                hit[places] = True
                text = cut(text, hit)
            texts.append(text)
        batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))
        yield batch.select(batch.schema.names[:-1])


def _clean_by_join(docs: DataFrame, benchmark: DataFrame, window: int, share: int, cut_spans: bool) -> DataFrame:
    """The same for a benchmark of any size; rows are told apart by a number of their own."""
    numbered = docs.withColumn("__row", F.monotonically_increasing_id())
    own = Workspace(docs.sparkSession, "decontam").table(numbered)  # the numbers stay as they are
    texts = own.select(F.col("__row").alias("id"), "doc_id", F.col("text").cast("string").alias("text"))
    places = _hit_words(_hits_by_join(texts, benchmark, window)).groupBy("id").agg(F.collect_list("i").alias("__hit"))  # as many as the text has words, at most
    found = Workspace(docs.sparkSession, "decontam").table(places)
    counts = texts.join(found.select("id"), "id", "left_semi").select("id", "doc_id", "text").mapInArrow(_count, f"id long, doc_id {_with_id_type(docs)}, n_words long")
    bad = counts.join(found, "id").filter(share * F.size("__hit") >= F.col("n_words")).select(F.col("id").alias("__row"))
    left = own.join(bad, "__row", "left_anti")
    if not cut_spans:
        return left.select(docs.columns)
    return left.join(found.withColumnRenamed("id", "__row"), "__row", "left").select(*docs.columns, "__hit").mapInArrow(_cut_hits, docs.schema)


def _report_by_join(docs: DataFrame, benchmark: DataFrame, window: int, share: int) -> DataFrame:
    """The same for a benchmark of any size: both sides' windows meet on (length, hash, words).

    Rows are told apart by a number of their own, so repeated doc_ids stay apart.
    """
    numbered = docs.select("doc_id", F.col("text").cast("string").alias("text")).withColumn("id", F.monotonically_increasing_id())
    own = Workspace(docs.sparkSession, "decontam").table(numbered)  # the numbers stay as they are
    hits = _hits_by_join(own, benchmark, window)
    words = _hit_words(hits).groupBy("id").agg(F.count("i").alias("n_hit"))
    items = hits.select("id", "item").distinct().groupBy("id").agg(F.array_sort(F.collect_list("item")).alias("items"))
    counts = own.select("id", "doc_id", "text").mapInArrow(_count, f"id long, doc_id {_with_id_type(docs)}, n_words long")
    none = F.coalesce("items", F.array().cast("array<string>"))
    out = counts.join(words, "id", "left").join(items, "id", "left").withColumn("n_hit", F.coalesce("n_hit", F.lit(0)))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size(none).cast("long").alias("n_items"), F.sha2(F.array_join(none, ","), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = pa.array([len(alnum_words(t)) for t in batch.column("text").to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("doc_id"), n], ["id", "doc_id", "n_words"])
