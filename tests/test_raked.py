"""Tips are taken off before the rounds: what is written stays near the rows there are; the results those of brute force."""

import pytest
from pyspark.sql import functions as F

from cladeworks.operators import diff, folds, hierarchy


@pytest.fixture
def written(monkeypatch):
    """Rows that the folds write."""
    rows, plain = [], folds.staged

    def counted(df):
        out = plain(df)
        rows.append(out.count())
        return out

    monkeypatch.setattr(folds, "staged", counted)
    monkeypatch.setattr(hierarchy, "staged", counted)
    return rows


def _tree():
    """600 tips in three levels, a chain of 40 that bears tips, and a root that names a missing parent."""
    par = {"r": None, "lost": "nowhere"} | {f"a{i}": "r" for i in range(5)} | {f"b{i}": f"a{i % 5}" for i in range(60)} | {f"t{i}": f"b{i % 60}" for i in range(600)}
    par |= {f"k{i}": f"k{i - 1}" if i else "b7" for i in range(40)} | {f"kt{i}": f"k{i}" for i in range(0, 40, 9)}
    return par


def _up(par, u):
    out = [u]
    while par.get(out[-1]) in par:
        out.append(par[out[-1]])
    return out


def test_rows_written_and_results(spark, written):
    par = _tree()
    t = spark.createDataFrame(list(par.items()), "uid string, par_id string")
    got = {r["uid"]: (r["depth"], r["first"], r["last"]) for r in folds.intervals(t).collect()}
    assert sum(written) < 5.5 * len(par)
    kids, want = {}, {}
    for u, p in par.items():
        kids.setdefault(p if p in par else None, []).append(u)

    def walk(u, depth, at):
        end = at
        for c in sorted(kids.get(u, [])):
            end = walk(c, depth + 1, end + 1)
        want[u] = (depth, at, end)
        return end

    at = 0
    for r in sorted(kids[None]):
        at = walk(r, 0, at + 1)
    assert got == want

    written.clear()
    stops = spark.createDataFrame([("a2",), ("k11",), ("t3",), ("absent",)], "uid string")
    near = hierarchy.absorb(t, stops, count=True).collect()
    assert sum(written) < 3.5 * len(par)
    for r in near:
        path = _up(par, r["uid"])
        k = next((k for k, u in enumerate(path) if u in ("a2", "k11", "t3")), None)
        assert (r["stop"], r["steps"], r["last"]) == ((path[k], k, path[k]) if k is not None else (None, len(path) - 1, path[-1]))
    assert len(near) == len(par)


def test_cycle_below_tips_raises(spark):
    t = spark.createDataFrame([("a", "b"), ("b", "a"), *[(f"t{i}", "a") for i in range(20)]], "uid string, par_id string")
    for ask in (folds.sizes, hierarchy.depths):
        with pytest.raises(ValueError, match="cycle"):
            ask(t)


def test_barren_sorts_nothing(spark):
    old = spark.createDataFrame([("g1", None, "genus"), ("g2", None, "genus"), ("s1", "g2", "species"), ("s9", None, "species"), ("x", None, None)], "uid string, par_id string, rank string")
    new = spark.createDataFrame([("g1", None, "genus"), ("g2", None, "genus"), ("g3", None, "genus"), ("s1", "g3", "species")], "uid string, par_id string, rank string")
    out = diff.barren(old, new)
    assert {tuple(r) for r in out.collect()} == {("g1", "oldly_barren"), ("g2", "newly_barren")}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan  # several sorts of all rows in one task
    assert out.filter(F.col("uid").isNull()).isEmpty()


def test_ranks_in_order_need_no_fold(spark, monkeypatch):
    """Where every taxon's number tops its children's, only the unranked ones are folded; a child of its parent's rank lifts those above."""
    folded, plain = [], hierarchy.fold_up
    monkeypatch.setattr(hierarchy, "fold_up", lambda taxa, *more: folded.append(taxa.count()) or plain(taxa, *more))
    rows = [("r", None, "no rank"), ("g", "r", "genus"), ("h", "g", "subgenus")] + [(f"s{i}", "g" if i % 2 else "h", "species") for i in range(50)]
    best = lambda rows: {r["uid"]: r["best"] for r in hierarchy.best_ranks(spark.createDataFrame(rows, "uid string, par_id string, rank string")).collect()}
    got = best(rows)
    assert got == {"r": 72, "g": 70, "h": 60} | {f"s{i}": 30 for i in range(50)} and sum(folded) == 1
    folded.clear()
    got = best([*rows, ("x", "h", "genus"), ("y", "x", "no rank")])
    assert got == {"r": 73, "g": 72, "h": 71, "x": 70, "y": 0} | {f"s{i}": 30 for i in range(50)} and sum(folded) == 2 + 3
