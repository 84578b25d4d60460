import random

import pytest

from cladeworks.operators import compare, folds, hierarchy

ROWS = "res_id string, fragment string, uid string, par_id string, name string, rank string"


def _forests(rows):
    """Every forest walked by hand."""
    out = []
    for f in {r[:2] for r in rows}:
        own = [r for r in rows if r[:2] == f]
        ids, kids = {r[2] for r in own}, {}
        for r in own:
            kids.setdefault(r[3] if r[3] in ids else None, []).append(r)
        walk, place = [(r, 0) for r in sorted(kids[None], key=lambda r: (r[4], r[2]), reverse=True)], 0
        while walk:
            r, depth = walk.pop()
            place += 1
            out.append((*f, place, "    " * depth + r[4]))
            walk += [(k, depth + 1) for k in sorted(kids.get(r[2], []), key=lambda r: (r[4], r[2]), reverse=True)]
    return sorted(out)


@pytest.mark.parametrize("most", [100_000, 3])
def test_forests_by_hand(spark, monkeypatch, most):
    rng = random.Random(most)
    rows = []
    for res in ("a", "b"):
        for i in range(150):  # parents in other fragments, parents that are nowhere, wide and narrow ones
            par = None if i < 3 else rng.choice([f"t{rng.randrange(max(0, i - 40), i)}", f"t{i // 30}", "nowhere"][: 3 if i % 20 == 0 else 2])
            rows.append((res, rng.choice("fff:g"[:4]), f"t{i}", par, rng.choice(["x", "y", f"n{i}"]), "no rank"))
    ranges = []
    monkeypatch.setattr(folds, "GROUP_ROWS", most)
    monkeypatch.setattr(folds, "sums_before", lambda *a, by=folds.sums_before: ranges.append(a) or by(*a))
    got = compare.forests(spark.createDataFrame(rows, ROWS))
    assert sorted(tuple(r) for r in got.collect()) == _forests(rows)
    assert bool(ranges) == (most == 3)  # siblings are dealt to sorted ranges only where one parent has too many


def test_nearest_is_absorb(spark):
    rng = random.Random(5)
    taxa = spark.createDataFrame([(f"t{i}", None if i < 2 else "gone" if i % 31 == 0 else f"t{rng.randrange(max(0, i - 9), i)}", i) for i in range(120)], "uid string, par_id string, n int")
    stops = taxa.filter("n % 7 = 3").select("uid")
    got = {(r["uid"], r["n"], r["stop"]) for r in hierarchy.nearest(taxa, stops).collect()}
    assert got == {(r["uid"], r["n"], r["stop"]) for r in taxa.join(hierarchy.absorb(taxa, stops), "uid").collect()}
