"""SimHash: weighted term hashes vote on signed bits; permuted block tables find near fingerprints.

Terms are the 1- and 2-word shingles of a text (white-space words, A-Z
lower-cased) with a weight of ``sqrt(count)``; each term's 128-bit hash votes
+weight or -weight on every bit, and the fingerprint has the bits with a
positive sum.  ``within_radius`` finds all pairs of fingerprints that differ in
at most ``radius`` bits: the bits are cut into ``radius + extra`` blocks, and for
each choice of ``extra`` blocks a table is keyed by these blocks' bits; two
fingerprints within the radius agree on all blocks of at least one table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .sampling import first_by_hash
from .text import mix, shingle_hashes, space_words, word_hashes

BITS = 128
_SEED2 = np.uint64(0xD6E8FEB86659FD93)


def fingerprint(text: str | None) -> np.ndarray:
    """128 bits as 16 bytes; the empty text has none set."""
    words = word_hashes(space_words(text))
    if not len(words):
        return np.zeros(BITS // 8, np.uint8)
    terms = words if len(words) < 2 else np.concatenate((words, shingle_hashes(words, 2)))
    terms, counts = np.unique(terms, return_counts=True)
    both = np.stack((terms, mix(terms ^ _SEED2)), axis=1)
    weight = np.sqrt(counts).astype(np.float32)
    votes = np.zeros(BITS, np.float64)
    for at in range(0, len(terms), 8192):  # bounds memory for very long texts
        bits = np.unpackbits(both[at : at + 8192].view(np.uint8).reshape(-1, BITS // 8), axis=1)
        votes += weight[at : at + 8192] @ bits
    return np.packbits(2 * votes > weight.sum(dtype=np.float64))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """cos(pi * hamming / bits), at least 0: what SimHash estimates of the weighted terms' cosine."""
    h = int(np.unpackbits(a ^ b).sum())
    return max(0.0, float(np.cos(np.pi * h / BITS)))


def edited(text: str, following: str) -> str:
    """The last floor(n/2) code points replaced by the first as many (or all) of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _pairs(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (bucket, halo, doc_id, text); each bucket ends with the first row after it."""
    held = None  # the last row: bucket, halo, doc_id, text, fingerprint
    for batch in batches:
        rows = []
        for bucket, halo, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("bucket", "halo", "doc_id", "text")), strict=True):
            if held and held[0] == bucket and held[1]:
                continue  # only the first row of a halo counts
            now = (bucket, halo, doc_id, text, fingerprint(text))
            if held and held[0] == bucket:
                new = edited(held[3], text)
                print_new = fingerprint(new)
                rows.append((
                    held[2], len(held[3]), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), held[4].tobytes().hex(),
                    print_new.tobytes().hex(), likeness(held[4], print_new), likeness(held[4], now[4]),
                ))
            held = now
        columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def fingerprints(docs: DataFrame, buckets: int | None = None, sample_rows: int = 4096) -> DataFrame:
    """One row per document with its own and its edited text's fingerprint (see ``edited``).

    The following document is the next by (doc_id, text), nulls first; after
    the last comes the first (a single document follows itself).  A null text
    is empty.  Documents are dealt to ranges of doc_id bounded by quantiles of
    a hash-ordered sample (which only places the bounds); each range also gets
    the first document after it, so texts are shuffled once and no task sees
    more than its range.  Repeated rows are rows of their own; other columns
    are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    buckets = buckets or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    ids = docs.select("doc_id")
    sample = first_by_hash(ids.filter("doc_id is not null"), "doc_id", sample_rows).collect()
    known = sorted(r[0] for r in sample)
    bounds = sorted({known[len(known) * i // buckets] for i in range(1, buckets)}) if known else []
    kind = docs.schema["doc_id"].dataType
    at = F.lit(bounds).cast(T.ArrayType(kind)) if bounds else None
    bucket_of = lambda c: F.when(c.isNull(), 0).otherwise(F.size(F.filter(at, lambda x: x <= c))) if bounds else F.lit(0)
    own = rows.withColumn("bucket", bucket_of(F.col("doc_id"))).withColumn("halo", F.lit(False))
    # the first id of each bucket, at most ``buckets`` rows; a bucket's halo is the first of the next one in use
    firsts = {
        r[0]: (r["nulls"] > 0, r["first"])
        for r in ids.groupBy(bucket_of(F.col("doc_id")).alias("b")).agg(F.min("doc_id").alias("first"), F.count_if(F.col("doc_id").isNull()).alias("nulls")).collect()
    }
    used = sorted(firsts)
    before = [(firsts[b][1], firsts[b][0], used[i - 1]) for i, b in enumerate(used)]  # the last bucket is before the first
    starts = spark.createDataFrame(
        [(first, null, b) for first, null, b in before] or [(None, True, -1)], T.StructType([T.StructField("first", kind), T.StructField("null_first", T.BooleanType()), T.StructField("bucket", T.IntegerType())])
    )
    is_first = F.when(F.col("null_first"), F.col("doc_id").isNull()).otherwise(F.col("doc_id") == F.col("first"))
    halo = rows.join(F.broadcast(starts), is_first).select("doc_id", "text", "bucket", F.lit(True).alias("halo"))  # starts: at most ``buckets`` rows
    dealt = own.unionByName(halo).repartition(max(1, len(bounds) + 1), "bucket").sortWithinPartitions("bucket", "halo", "doc_id", "text")
    schema = f"doc_id {kind.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    arrow = to_arrow_schema(T._parse_datatype_string(schema))
    return dealt.select("bucket", "halo", "doc_id", "text").mapInArrow(lambda batches: _pairs(batches, arrow), schema)


def hamming(a: Column, b: Column) -> Column:
    """Differing bits of two hex fingerprints of 128 bits."""
    word = lambda c, k: F.conv(F.substring(c, 1 + 8 * k, 8), 16, 10).cast("long")
    parts = [F.bit_count(word(a, k).bitwiseXOR(word(b, k))) for k in range(BITS // 32)]
    return sum(parts[1:], parts[0])


def _table_keys(hex_print: Column, radius: int, extra: int) -> Column:
    """One key per table: the table's number and the bits of its blocks (blocks are runs of hex digits)."""
    digits = BITS // 4
    blocks = radius + extra
    edges = [digits * i // blocks for i in range(blocks + 1)]
    cut = [F.substring(hex_print, a + 1, b - a) for a, b in zip(edges, edges[1:], strict=False)]
    return F.array(*[F.concat_ws(":", F.lit(str(n)), *[cut[i] for i in use]) for n, use in enumerate(combinations(range(blocks), extra))])


def within_radius(prints: DataFrame, radius: int = 6, extra: int = 2) -> DataFrame:
    """All pairs (a, b, distance) with a < b of distinct values of ``prints.fingerprint`` within ``radius`` bits.

    Equal fingerprints are one value, so a group of copies makes no pairs.
    Nulls are ignored; an empty table gives no pairs.
    """
    distinct = prints.select("fingerprint").filter("fingerprint is not null").distinct()
    tables = distinct.select("fingerprint", F.explode(_table_keys(F.col("fingerprint"), radius, extra)).alias("key"))
    a, b = tables.withColumnRenamed("fingerprint", "a"), tables.withColumnRenamed("fingerprint", "b")
    near = a.join(b, "key").filter((F.col("a") < F.col("b")) & (hamming(F.col("a"), F.col("b")) <= radius))
    return near.select("a", "b").distinct().withColumn("distance", hamming(F.col("a"), F.col("b")))
