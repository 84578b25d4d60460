import random

from cladeworks.operators import diff


def test_edits_look_at_changed_taxa_only(spark, monkeypatch):
    rng = random.Random(3)
    old = [(f"t{i}", None if i < 2 else "nowhere" if i % 37 == 0 else f"t{rng.randrange(i)}", None if i % 11 == 0 else f"n{i}", "x") for i in range(150)]
    new = [(u, f"t{rng.randrange(150)}" if i % 13 == 5 else p, "other" if i % 17 == 0 else n, None if i % 29 == 0 else r) for i, (u, p, n, r) in enumerate(old) if i % 19]
    new += [("s1", "t3", "a", "x"), ("s2", "s1", None, "x"), ("s3", None, "c", "x")]
    a, b = (spark.createDataFrame(t, "uid string, par_id string, name string, rank string") for t in (old, new))
    want = {r["uid"]: r["status"] for r in diff.statuses(a, b).collect() if r["status"] != "UNCHANGED"}
    moves = {r["par_id"]: (r["took_from"], r["lost_to"]) for r in diff.child_transfers(a, b).collect()}

    def never(_):
        raise AssertionError("tips of whole releases sought")

    monkeypatch.setattr(diff, "leaves", never)
    got = {r["uid"]: r for r in diff.edits(a, b).collect()}
    before, now = {r[0]: r for r in old}, {r[0]: r for r in new}
    assert {u: r["status"] for u, r in got.items() if r["status"] != "UNCHANGED"} == want
    for u, r in got.items():
        assert (r["previous"], r["current"]) == (before.get(u), now.get(u))
        assert (r["took_from"], r["lost_to"]) == tuple(moves.get(u, ([], [])))
    assert {u for u in moves if u in before or u in now} <= set(got)
