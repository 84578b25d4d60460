"""Time-ordered, out-of-fold target encoding by a step-function validity table.

For a key the counts of its history are a step function of time: they hold from
a change's time plus the gap, exclusive, to the next change's, inclusive.
``validity`` lays these pieces out as a table (key, fold, pos, n, s), cut at
every change, at every probe's time and, for keys with many events, at the
bounds of time bins; (n, s) hold up to ``pos`` and are those of the key less
those of the fold's own component.  As the pieces are cut at the probes' times,
the range join of a probe is an equi-join with the piece that ends there.

Events of one key, time and fold are summed before anything is shuffled by key,
so a hot instant is one row a fold.  A hot key is split over its bins: each bin
starts with the sums of those before it (a piece that goes on over the bound),
so no task holds more of a key than a bin's instants or the number of its bins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .workspace import Workspace

#: Keys with more events are split at time bins of so many seconds.
HOT_EVENTS, BIN_SECONDS = 10_000, 3600


def micros(df: DataFrame, time: str) -> Column:
    """Microseconds since 1970 of a timestamp with or without a zone; the latter's do not depend on the session's."""
    if df.schema[time].dataType.typeName() == "timestamp":
        return F.unix_micros(time)
    seconds = F.expr(f"unix_date(to_date(`{time}`)) * 86400L + hour(`{time}`) * 3600L + minute(`{time}`) * 60L")
    return seconds * 1_000_000 + F.expr(f"cast(extract(SECOND FROM `{time}`) * 1000000 AS bigint)")


def validity(
    events: DataFrame, ws: Workspace, folds: int, gap_seconds: int = 0, probes: DataFrame | None = None,
    hot_events: int = HOT_EVENTS, bin_seconds: int = BIN_SECONDS,
) -> DataFrame:
    """(key, fold, pos, n, s) of each event's own time and of each of ``probes`` (key, at, fold).

    n and s sum the events (key, at, fold, n, s) of the key in other folds at a
    time more than the gap before ``pos`` (microseconds).  Folds run from 0 to
    ``folds`` - 1.  Without events before it a piece has 0 and 0; a null key is
    a key; events without a time are in no history; no events, no rows.
    """
    gap, width = 1_000_000 * gap_seconds, 1_000_000 * bin_seconds
    timed = events.filter("at is not null").select("key", (F.col("at") + gap).alias("pos"), "fold", "n", "s")
    steps = timed
    asked = [p.filter("at is not null").select("key", F.col("at").alias("pos"), "fold") for p in (probes, events if gap else None) if p is not None]
    for p in asked:  # without a gap an event's own time is cut anyway
        steps = steps.unionByName(p.withColumns({"n": F.lit(0).cast("long"), "s": F.lit(0).cast("long")}))
    steps = steps.groupBy("key", "pos", "fold").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))

    hot = ws.table(timed.groupBy("key").count().filter(F.col("count") > hot_events).select(F.col("key").alias("hot_key"), F.lit(True).alias("hot")))
    same = lambda df, how: df.join(hot, df["key"].eqNullSafe(hot["hot_key"]), how)
    at_bin = F.expr(f"floor(pos / {width})").cast("long")
    # what a hot key has before each of its bins, by fold, is the bin's first piece
    of = lambda c, k: F.coalesce(F.sum(F.when(F.col("fold") == k, F.col(c))), F.lit(0))
    columns = [(c, k) for k in range(folds) for c in "ns"]
    with_probes = same(timed, "left_semi").select("key", at_bin.alias("bin"), "fold", "n", "s")
    for p in asked:
        with_probes = with_probes.unionByName(same(p, "left_semi").select("key", at_bin.alias("bin"), "fold", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("s")))
    sums = with_probes.groupBy("key", "bin").agg(*[of(c, k).alias(f"{c}{k}") for c, k in columns])
    earlier = Window.partitionBy("key").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select("key", "bin", *[F.sum(f"{c}{k}").over(earlier).alias(f"{c}{k}") for c, k in columns]).filter("n0 is not null")
    by_fold = F.array(*[F.struct(F.lit(k).alias("fold"), F.col(f"n{k}").alias("n"), F.col(f"s{k}").alias("s")) for k in range(folds)])
    starts = ws.table(carried.select("key", "bin", F.explode(by_fold).alias("x")).select("key", "bin", (F.col("bin") * width - 1).alias("pos"), "x.fold", "x.n", "x.s"))

    binned = same(steps, "left").select("key", F.when(F.col("hot"), at_bin).otherwise(F.lit(0)).alias("bin"), "pos", "fold", "n", "s")
    both = binned.withColumn("real", F.lit(True)).unionByName(starts.withColumn("real", F.lit(False)))
    before = Window.partitionBy("key", "bin").orderBy("pos").rangeBetween(Window.unboundedPreceding, -1)
    held = both.select("key", "fold", "pos", "real", *[F.coalesce(F.sum(F.when(F.col("fold") == k, F.col(c))).over(before), F.lit(0)).alias(f"{c}{k}") for c, k in columns])
    others = lambda c: reduce(Column.__add__, [F.when(F.col("fold") == k, 0).otherwise(F.col(f"{c}{k}")) for k in range(folds)])
    return held.filter("real").select("key", "fold", "pos", others("n").cast("long").alias("n"), others("s").cast("long").alias("s"))


def rate(n: Column, s: Column, prior: Column, weight: int = 50, scale: int = 1_000_000) -> Column:
    """floor((scale * s + weight * prior) / (n + weight)), and the prior itself without history."""
    share = F.call_function("div", F.lit(scale).cast("long") * s + F.lit(weight).cast("long") * prior, n + F.lit(weight).cast("long"))
    return F.when(n < 1, prior).otherwise(share)


def encoded(rows: DataFrame, table: DataFrame, key: Column, prior: Column, name: str) -> DataFrame:
    """``rows`` (at, fold, ...) with ``{name}_n`` and ``{name}_rate`` of the pieces of ``table`` that end at their times (none: 0 and the prior)."""
    own = f"__key_{name}"
    pieces = table.select(F.col("key").alias("__of"), F.col("fold").alias("__fold"), F.col("pos").alias("__pos"), F.col("n").alias("__n"), F.col("s").alias("__s"))
    asked = rows.withColumns({own: key, "__prior": prior})
    # the time first: rows are sorted by it, and it tells most of them apart
    found = asked.join(pieces, (asked["at"] == pieces["__pos"]) & asked[own].eqNullSafe(pieces["__of"]) & (asked["fold"] == pieces["__fold"]), "left")
    n, s = F.coalesce("__n", F.lit(0).cast("long")), F.coalesce("__s", F.lit(0).cast("long"))
    return found.select(*[asked[c] for c in rows.columns], n.alias(f"{name}_n"), rate(n, s, F.col("__prior")).alias(f"{name}_rate"))


def fold_of(key: Column, folds: int) -> Column:
    """The CRC-32 of the key's decimal digits, modulo ``folds``."""
    return (F.crc32(key.cast("string").cast("binary")) % folds).cast("int")


def encode_sales(
    lines: DataFrame, sales: DataFrame, items: DataFrame, vendors: DataFrame, clients: DataFrame, folds: int = 5, prior: int = 500_000,
    gap_seconds: int = 0, hot_events: int = HOT_EVENTS, bin_seconds: int = BIN_SECONDS,
) -> DataFrame:
    """Per sale_id, item_id, vendor_id: n_lines, n_returned and the out-of-fold history of item, vendor and client.

    Lines without a sale or a time of sale are left out; repeated lines count.
    A null item_id or client_id is the ordinary id -1; a null vendor_id is an id
    of its own and stays null.  Items, vendors and clients that are unknown or
    lack a kind, nation or segment share one.  Where an id has several rows in
    its table the smallest value counts; further columns are ignored.  The
    prior of an id is the rate of its kind, nation or segment, theirs the rate
    of all history, and that one's ``prior``.  Empty tables give no rows.
    """
    ws = Workspace(lines.sparkSession, "encoding")
    own = lines.filter("sale_id is not null").select("sale_id", F.coalesce("item_id", F.lit(-1)).alias("item_id"), "vendor_id", (F.col("flag") == "returned").alias("back"))
    groups = own.groupBy("sale_id", "item_id", "vendor_id").agg(F.count(F.lit(1)).alias("n"), F.count_if("back").alias("s"))
    sold = sales.filter("sold_at is not null").select("sale_id", F.coalesce("client_id", F.lit(-1)).alias("client_id"), micros(sales, "sold_at").alias("at"))
    # written first, so that a join sees their size, and splits a hot id where they are too large to be sent to all
    of = lambda df, key, value: ws.table(df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(value).alias(value)))
    groups = groups.join(sold, "sale_id").withColumn("fold", fold_of(F.col("sale_id"), folds))
    groups = groups.join(of(items, "item_id", "kind"), "item_id", "left").join(of(vendors, "vendor_id", "nation_id"), "vendor_id", "left")
    groups = ws.table(groups)
    # a sale's lines share its time, fold and client
    per_sale = groups.groupBy("sale_id", "client_id", "at", "fold").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    per_sale = ws.table(per_sale.join(of(clients, "client_id", "segment"), "client_id", "left"))

    keys = {"all": F.lit(0), "segment": F.col("segment"), "client": F.col("client_id"), "kind": F.col("kind"), "item": F.col("item_id"), "nation": F.col("nation_id"), "vendor": F.col("vendor_id")}

    def with_rate(rows: DataFrame, level: str, prior: Column) -> DataFrame:
        events = per_sale if level in ("all", "segment", "client") else groups
        table = validity(events.select(keys[level].alias("key"), "at", "fold", "n", "s"), ws, folds, gap_seconds, None, hot_events, bin_seconds)
        return encoded(rows, table, keys[level], prior, level)

    done = with_rate(per_sale.drop("n", "s"), "all", F.lit(prior).cast("long"))
    done = with_rate(with_rate(done, "segment", F.col("all_rate")), "client", F.col("segment_rate"))
    done = done.select("sale_id", "client_id", "at", "all_rate", "client_n", "client_rate")
    lines_of = groups.join(done, ["sale_id", "client_id", "at"]).drop("client_id")
    for level, above in (("kind", "all"), ("item", "kind"), ("nation", "all"), ("vendor", "nation")):
        lines_of = with_rate(lines_of, level, F.col(f"{above}_rate"))
    return lines_of.select(
        "sale_id", "item_id", "vendor_id", F.col("n").alias("n_lines"), F.col("s").alias("n_returned"),
        "item_n", "item_rate", "vendor_n", "vendor_rate", "client_n", "client_rate",
    )
