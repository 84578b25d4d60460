"""Edges of some predicates only: the same as those of all, and made without parsing names."""

from cladeworks.operators import compare


def test_some_predicates(spark):
    rows = [("m", "f", "1", None, "Aus", "genus"), ("m", "f", "2", "1", "Aus bus L., 1758", "species"), ("r", "f", "1", None, None, "genus"), ("r", "g", "3", "1", "Aus (Cus) bus", None)]
    t = spark.createDataFrame(rows, "res_id string, fragment string, uid string, par_id string, name string, rank string")
    some = compare.graphs(t, ("rank", "verbatim", "genus"))
    want = [r for r in compare.graphs(t).collect() if r["predicate"] in ("rank", "verbatim", "genus")]
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, want)) and want
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" in plan(compare.graphs(t)) and "aggregate(" not in plan(compare.graphs(t, ("rank", "verbatim")))
