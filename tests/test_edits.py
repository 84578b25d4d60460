"""The edit log: references by id, records once, and no edit before those that it refers to."""

import json
import random

from cladeworks.operators import diff


def _release(rng, n):
    par = {f"n{i}": f"n{rng.randrange(max(0, i - 6), i)}" if i else None for i in range(n)}
    return {u: (p, f"name {u}", "no rank") for u, p in par.items()}


def _later(rng, old):
    """Taxa dropped with what is below, moved elsewhere without making a cycle, renamed, added."""
    new = dict(old)
    for u in rng.sample(sorted(old), 40):
        p, name, rank = new[u]
        new[u] = (p, name + "!", rank)
    for u in rng.sample(sorted(old), 40):
        below, up = {u}, True
        while up:
            up = {x for x, (p, *_) in new.items() if p in below} - below
            below |= up
        if (to := [x for x in sorted(new) if x not in below]) and new[u][0] is not None:
            new[u] = (rng.choice(to), *new[u][1:])
    for k in range(20):
        new[f"x{k}"] = (rng.choice(sorted(new)), f"new {k}", "species")
    for u in [x for x in sorted(new) if x not in {p for p, *_ in new.values()}][:10]:
        del new[u]
    return new


def test_every_edit_once_and_after_what_it_uses(spark):
    rng = random.Random(12)
    old = _release(rng, 150)
    new = _later(rng, old)
    frame = lambda t: spark.createDataFrame([(u, *v) for u, v in t.items()], "uid string, par_id string, name string, rank string").repartition(3)
    rows = sorted(diff.edit_log(frame(old), frame(new)).collect(), key=lambda r: (r["level"], r["edit_id"]))
    log = [json.loads(r["edit"]) for r in rows]
    assert len({e["edit_id"] for e in log}) == len(log)
    changed = {u for u in old.keys() | new.keys() if old.get(u) != new.get(u)}
    parents = {t[u][0] for u in changed for t in (old, new) if u in t and (u not in old or u not in new or old[u][0] != new[u][0])} - {None}
    assert {r["uid"] for r in rows} == changed | {p for p in parents if p in old or p in new}
    seen, given = set(), set()
    for r, e in zip(rows, log, strict=True):
        u = r["uid"]
        kids = {x for x in new if new[x][0] == u and (x not in old or old[x][0] != u)}
        assert {c.split(":")[1] for c in e.get("new_children", [])} == kids and set(e.get("new_children", [])) <= seen
        assert e.get("took_from", []) == sorted({old[x][0] for x in kids if x in old} - {None}) and e.get("lost_to", []) == sorted({new[x][0] for x in old if old[x][0] == u and x in new and new[x][0] != u})
        for side, t in (("previous", old), ("current", new)):
            assert (side in e) == (u in t) and (u not in t or (e[side].get("par_id"), e[side]["name"]) == t[u][:2])
        if (p := new.get(u, (None,))[0]) is not None:
            assert e["parent"]["uid"] == p
            in_full = "name" in e["parent"]
            assert in_full == (p not in {x["uid"] for x in rows} and p not in given)
            given |= {p}
        seen.add(e["edit_id"])
    assert max(r["level"] for r in rows) >= 2


def test_nothing_changed(spark):
    t = spark.createDataFrame([("a", None, "a", "x"), ("b", "a", "b", "x")], "uid string, par_id string, name string, rank string")
    assert diff.edit_log(t, t).collect() == [] and diff.edit_log(t.limit(0), t.limit(0)).collect() == []
