"""URL rules by a sort-merge range join over reversed-host keys.

A host ``www.example.com`` becomes the canonical key ``com\\x01example\\x01www\\x01``.
A rule's host is then the interval of all keys that start with its own key, and
two such intervals are nested or disjoint.  Rules and pages are dealt to key
ranges, sorted together, and swept once: a stack holds the rules whose interval
is still open, and the longest rule on the stack whose path starts the url's
path decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .sampling import first_by_hash

#: (verdict, host, path)
Rule = tuple[str, str, str]
_AFTER = "\U0010ffff"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def reversed_host(host: Column) -> Column:
    """``a.b`` -> ``b\\x01a\\x01``: \\x01 sorts below all that a label holds, so prefixes become intervals."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "\x01"), F.lit("\x01"))


def _sweep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by (bucket, key, kind): rules before the pages of their own key."""
    bucket, stack = None, []  # stack: (key prefix, [(path, rule text, verdict), ...])
    for pdf in frames:
        rows = []
        for b, key, kind, page_id, url_host, path, rule, verdict in pdf.itertuples(index=False, name=None):
            if b != bucket:
                bucket, stack = b, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if kind == 0:
                if stack and stack[-1][0] == key:
                    stack[-1][1].append((path, rule, verdict))
                else:
                    stack.append((key, [(path, rule, verdict)]))
                continue
            # rules tie on length only if they are equal texts; then block wins
            fits = [r for _, own in stack for r in own if path.startswith(r[0])]
            best = max(fits, key=lambda r: (len(r[1]), r[2] == "block"), default=(None, None, None))
            rows.append((page_id, url_host, path, best[1], best[2]))
        yield pd.DataFrame(rows, columns=["page_id", "host", "path", "rule", "verdict"])


def judge(
    pages: DataFrame, rules: DataFrame, default: str = "allow", buckets: int | None = None, sample_rows: int = 4096
) -> DataFrame:
    """page_id, host, path, rule, verdict for every page.

    ``rules`` has verdict, host, path.  Pages and rules are dealt to ``buckets``
    ranges of (key, hash of the page id) whose bounds are quantiles of a
    hash-ordered sample of ``sample_rows`` pages (the sample only places the
    bounds; every page is judged).  A host that holds many pages spans several
    ranges.  A rule goes to every range its interval meets.  Only the bounds
    (at most ``buckets``) reach the driver.

    A null url or one without ``://`` has an empty host and path and fits no
    rule; a null page_id is judged like any other; repeated pages are each
    judged; an empty table gives an empty result, empty rules the default.
    """
    spark = pages.sparkSession
    buckets = buckets or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    url = F.col("url").cast("string")
    host = host_of(url)
    salt = lambda c: F.format_string("%016x", F.xxhash64(c))
    keyed = pages.select(
        "page_id", host.alias("host"), path_of(url).alias("path"), reversed_host(host).alias("key"), salt(F.col("page_id")).alias("salt")
    )
    # \x00 sorts below every key byte: (key, salt) compare as one string
    place = F.concat(F.col("key"), F.lit("\x00"), F.col("salt"))
    sample = sorted(r[0] for r in first_by_hash(keyed, "page_id", sample_rows).select(place).collect())
    bounds = sorted({sample[len(sample) * i // buckets] for i in range(1, buckets)}) if sample else []
    last = len(bounds)
    at = F.array(*[F.lit(x) for x in bounds]) if bounds else F.array().cast("array<string>")
    below = lambda c: F.size(F.filter(at, lambda x: x <= c)) if bounds else F.lit(0)
    schema = ("bucket", "key", "kind", "page_id", "host", "path", "rule", "verdict")
    none = F.lit(None).cast("string")
    page_rows = keyed.select(below(place).alias("bucket"), "key", F.lit(1).alias("kind"), "page_id", "host", "path", none.alias("rule"), none.alias("verdict"))
    rule_key = reversed_host(F.col("host"))
    rule_rows = (
        rules.select(F.translate("host", _UPPER, _LOWER).alias("host"), "path", "verdict")
        .select(
            F.explode(F.sequence(below(F.concat(rule_key, F.lit("\x00"))), below(F.concat(rule_key, F.lit(_AFTER))))).alias("bucket"),
            rule_key.alias("key"), F.lit(0).alias("kind"), F.lit(None).cast(pages.schema["page_id"].dataType).alias("page_id"),
            none.alias("host"), "path", F.concat("host", "path").alias("rule"), "verdict",
        )
    )
    sweep_in = page_rows.select(*schema).unionByName(rule_rows.select(*schema))
    dealt = sweep_in.repartition(last + 1, "bucket").sortWithinPartitions("bucket", "key", "kind")
    kind_of_id = pages.schema["page_id"].dataType
    # ids travel as strings: pandas has no integer column with nulls
    swept = dealt.withColumn("page_id", F.col("page_id").cast("string")).mapInPandas(_sweep, "page_id string, host string, path string, rule string, verdict string")
    return swept.withColumns({"page_id": F.col("page_id").cast(kind_of_id), "verdict": F.coalesce("verdict", F.lit(default))})


def rules_frame(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    return spark.createDataFrame(rules, "verdict string, host string, path string")
