import datetime
import random
import zlib

import pytest

from cladeworks.llm import target_encoding as te
from cladeworks.llm.workspace import Workspace

T0 = datetime.datetime(2024, 1, 1)


def _brute(lines, sales, items, vendors, clients, folds=5, prior=500_000, gap=0):
    def least(rows, at=1):
        out = {}
        for r in rows:
            if r[0] is not None:
                known = [v for v in (out.get(r[0]), r[at]) if v is not None]
                out[r[0]] = min(known) if known else None
        return out

    kind, nation, segment = least(items), least(vendors), least(clients)
    joined = []
    for sale, item, vendor, flag in lines:
        for s, client, at in sales:
            if sale is not None and s == sale and at is not None:
                item_, client_ = -1 if item is None else item, -1 if client is None else client
                joined.append((sale, item_, vendor, flag == "returned", client_, at, zlib.crc32(str(sale).encode()) % folds, kind.get(item_), nation.get(vendor), segment.get(client_)))
    out = {}
    for row in joined:
        history = [h for h in joined if h[6] != row[6] and (row[5] - h[5]).total_seconds() > gap]

        def counts(at):
            same = [h for h in history if at is None or h[at] == row[at]]  # noqa: B023
            return len(same), sum(h[3] for h in same)

        def rate(c, p):
            return p if c[0] < 1 else (1_000_000 * c[1] + 50 * p) // (c[0] + 50)

        top = rate(counts(None), prior)
        values = []
        for own, above in ((1, 7), (2, 8), (4, 9)):
            values += [counts(own)[0], rate(counts(own), rate(counts(above), top))]
        key = (row[0], row[1], row[2], row[4], row[5])
        n, s, _ = out.get(key, (0, 0, None))
        out[key] = (n + 1, s + row[3], values)
    return sorted(((*k[:3], n, s, *v) for k, (n, s, v) in out.items()), key=str)


def _tables(spark, seed=3, n_sales=50):
    rng = random.Random(seed)
    at = lambda: T0 + datetime.timedelta(seconds=rng.choice([0, 0, 3600, rng.randrange(200_000)]))
    sales = [(k, rng.choice([None, 1, 1, 2, 3, 99]), None if k % 11 == 0 else at()) for k in range(n_sales)] + [(None, 1, T0)]
    lines = [(rng.choice([None, 0, 7, 500, *range(n_sales)]), rng.choice([None, 7, 7, 7, 8, 9, 77]), rng.choice([None, 4, 4, 5, 66]), rng.choice([None, "kept", "returned"])) for _ in range(260)]
    lines += lines[:20]  # repeated lines count
    items = [(7, "a"), (8, "b"), (9, None), (9, "a"), (None, "z")]
    vendors = [(4, 1), (5, None), (None, 3)]
    clients = [(1, "s"), (2, "t"), (3, None), (None, "u")]
    return lines, sales, items, vendors, clients


def _frames(spark, lines, sales, items, vendors, clients, zone="timestamp_ntz"):
    clash = "level string, key string, pos long, n long, s long, bin int, `at` int"
    more = ("L", "K", 1, 2, 3, 4, 5)
    return (
        spark.createDataFrame([(*r, *more) for r in lines], f"sale_id long, item_id long, vendor_id long, flag string, {clash}").repartition(3),
        spark.createDataFrame([(*r, *more) for r in sales], f"sale_id long, client_id long, sold_at {zone}, {clash}").repartition(2),
        spark.createDataFrame([(*r, *more) for r in items], f"item_id long, kind string, {clash}"),
        spark.createDataFrame([(*r, *more) for r in vendors], f"vendor_id long, nation_id int, {clash}"),
        spark.createDataFrame([(*r, *more) for r in clients], f"client_id long, segment string, {clash}"),
    )


def _got(*frames, **how):
    return sorted((tuple(r) for r in te.encode_sales(*frames, **how).collect()), key=str)


@pytest.mark.parametrize(("gap", "hot", "width"), [(0, 10_000, 3600), (0, 3, 3600), (0, 0, 7), (4000, 3, 3600)])
def test_matches_brute_force(spark, gap, hot, width):
    """Nulls in every column, ties in time, repeated lines, unknown ids, clashing columns; keys split over bins and whole."""
    rows = _tables(spark)
    assert _got(*_frames(spark, *rows), gap_seconds=gap, hot_events=hot, bin_seconds=width) == _brute(*rows, gap=gap)


def test_other_folds_and_zones(spark):
    rows = _tables(spark, 9, 20)
    assert _got(*_frames(spark, *rows, zone="timestamp"), folds=2, prior=100_000, hot_events=2) == _brute(*rows, folds=2, prior=100_000)


def test_times_without_a_zone_do_not_follow_the_session(spark):
    """An hour that a zone with summer time skips or repeats counts as it is written."""
    times = [datetime.datetime(2024, 3, 31, h, 30) for h in (1, 2, 3)] + [datetime.datetime(1969, 12, 31, 23, 59, 59, 250_000)]
    df = spark.createDataFrame([(t,) for t in times], "t timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        got = [r[0] for r in df.select(te.micros(df, "t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    epoch = datetime.datetime(1970, 1, 1)
    assert got == [(t - epoch) // datetime.timedelta(microseconds=1) for t in times]


def test_empty_tables(spark):
    frames = _frames(spark, *_tables(spark))
    assert _got(frames[0].limit(0), *frames[1:]) == []
    assert _got(frames[0], frames[1].limit(0), *frames[2:]) == []
    lines, sales, *_ = _tables(spark)
    bare = [f.limit(0) for f in frames[2:]]
    assert _got(frames[0], frames[1], *bare) == _brute(lines, sales, [], [], [])


def test_probes_between_changes_are_range_joined(spark):
    """validity() at times that are no event's, against the definition; a bin without events of its own still has what came before."""
    rng = random.Random(8)
    events = [(rng.choice(["a", "b", None]), rng.randrange(5_000_000_000), rng.randrange(3), rng.randrange(3), 1) for _ in range(120)] + [("a", None, 1, 5, 5)]
    asked = [(k, rng.choice([-5, 0, 9_000_000_000, rng.randrange(6_000_000_000)]), f) for k in ("a", "b", None, "new") for f in range(3) for _ in range(6)]
    rows = spark.createDataFrame(events, "key string, at long, fold int, n long, s long")
    probes = spark.createDataFrame(asked, "key string, at long, fold int")
    for gap in (0, 700):
        table = te.validity(rows, Workspace(spark, "test"), 3, gap, probes, hot_events=5, bin_seconds=500)
        found = {(r["key"], r["pos"], r["fold"]): (r["n"], r["s"]) for r in table.collect()}
        for key, at, fold in asked:
            past = [e for e in events if e[0] == key and e[2] != fold and e[1] is not None and e[1] + gap * 1_000_000 < at]
            assert found[(key, at, fold)] == (sum(e[3] for e in past), sum(e[4] for e in past))
