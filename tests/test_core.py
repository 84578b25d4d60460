"""The hierarchy engine on small random forests, and its queries against SQL."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cladeworks import model
from cladeworks.functions import names
from cladeworks.operators import diff, hierarchy, normalize, partition, reconcile, semgraph, separators

DATA = Path("/root/testdata/sf0.001")


def _tree(spark, n=120, seed=1):
    rng = random.Random(seed)
    rows = [("n0", None)] + [(f"n{i}", f"n{rng.randrange(max(0, i - 15), i)}") for i in range(1, n)]
    df = spark.createDataFrame([(u, p, u, "no rank") for u, p in rows], "uid string, par_id string, name string, rank string")
    return dict(rows), df


def _up(par, u):
    out = []
    while u is not None:
        out.append(u)
        u = par.get(u)
    return out


def test_closure_depth_tips_and_walk(spark):
    par, t = _tree(spark)
    assert {tuple(r) for r in hierarchy.closure(t).collect()} == {(a, u, d) for u in par for d, a in enumerate(_up(par, u))}
    assert {r["uid"]: r["depth"] for r in hierarchy.depths(t).collect()} == {u: len(_up(par, u)) - 1 for u in par}
    leaves = set(par) - set(par.values())
    assert {r["uid"]: r["n_tips"] for r in hierarchy.tips_below(t).collect()} == {a: sum(a in _up(par, x) for x in leaves) for a in par}
    kids = {}
    for u, p in par.items():
        kids.setdefault(p, []).append(u)
    order = []

    def walk(u):
        order.append(u)
        for c in sorted(kids.get(u, [])):
            walk(c)

    walk("n0")
    got = {r["uid"]: r["preorder_idx"] for r in hierarchy.preorder(t).collect()}
    assert [u for u, _ in sorted(got.items(), key=lambda x: x[1])] == order and sorted(got.values()) == list(range(1, len(par) + 1))


def test_deep_chain_and_cycle(spark):
    chain = spark.range(300).select(F.concat(F.lit("c"), "id").alias("uid"), F.when(F.col("id") > 0, F.concat(F.lit("c"), F.col("id") - 1)).alias("par_id"), F.lit("x").alias("name"), F.lit("").alias("rank"))
    assert hierarchy.depths(chain).agg(F.max("depth")).first()[0] == 299
    loop = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "b"), ("d", None)], "uid string, par_id string")
    for f in (hierarchy.closure, hierarchy.depths):
        with pytest.raises(ValueError, match="cycle"):
            f(loop).collect()


def test_partition_invariants(spark):
    par, t = _tree(spark, seed=4)
    marks = {"n3": "A", "n20": "B", "n50": "C"}
    roots = spark.createDataFrame(list(marks.items()), "uid string, fragment string")
    parts = partition.staged_assignment(t, roots)
    want = {u: next((marks[a] for a in _up(par, u) if a in marks), "__misc__") for u in par}
    assert {r["uid"]: r["fragment"] for r in parts.collect()} == want
    none = spark.createDataFrame([], model.SYNONYMS)
    assert all(r["n_violations"] == 0 for r in partition.validity(parts, none, roots).unionByName(partition.completeness(t, parts)).collect())
    broken = parts.withColumn("fragment", F.when(F.col("uid") == "n60", "Z").otherwise(F.col("fragment")))
    assert {r["check_name"]: r["n_violations"] for r in partition.validity(broken, none, roots).collect()}["unmarked_border"] > 0


def test_chains_of_synonyms_and_cycles(spark):
    f = spark.createDataFrame([("a", "b"), ("b", "c"), ("x", "y"), ("y", "z"), ("z", "x"), ("t", "x")], "old_id string, new_id string")
    out = {r["old_id"]: r["new_id"] for r in normalize.resolve_chain(f).collect()}
    assert out["a"] == out["b"] == "c" and {out[k] for k in "xyzt"} == {"x"}


def test_collapse_nested_containers(spark):
    t = spark.createDataFrame([("r", None, "R"), ("a", "r", "unclassified R"), ("b", "a", "unclassified b"), ("c", "b", "C x D"), ("d", "a", "D")], "uid string, par_id string, name string").withColumn("rank", F.lit("no rank"))
    out = normalize.collapse(t, t.filter("name like 'unclassified%'"))
    assert {(r["uid"], r["par_id"], tuple(r["flags"])) for r in out.collect()} == {("r", None, ()), ("c", "r", ("hybrid", "incertae_sedis")), ("d", "r", ("incertae_sedis",))}


def test_rank_guesses(spark):
    t = spark.createDataFrame([("a", None, "family"), ("b", "a", "no rank"), ("c", "b", "genus"), ("d", "c", "no rank"), ("e", "d", "species"), ("f", "d", "no rank")], "uid string, par_id string, rank string").withColumn("name", F.col("uid"))
    got = {r["uid"]: (r["low"], r["high"], r["best"]) for r in hierarchy.rank_ranges(t).collect()}
    assert got == {"a": (110, 110, 110), "b": (72, 109, 72), "c": (70, 70, 70), "d": (32, 69, 32), "e": (30, 30, 30), "f": (0, 68, 0)}
    assert {r["uid"]: r["specimen_typed"] for r in hierarchy.specimen_typed(t).collect()}["e"] is True


def test_names(spark):
    rows = ["Ajuga pyramidalis L.", "Foo bar Putnam, 1972", "Foo bar Putnam 1972", "Entero phage PA-2", "Aus (Bus) cus Smith, 1901", "Aus bus cus", "Aus sp. X12", "Aus x bus", "Aus"]
    df = spark.createDataFrame([(r,) for r in rows], "n string").select("n", names.canonical(F.col("n")).alias("c"), names.parsed(F.col("n")).alias("p")).collect()
    got = {r["n"]: r for r in df}
    assert [got[r]["c"] for r in rows[:5]] == ["Ajuga pyramidalis", "Foo bar", "Foo bar Putnam 1972", "Entero phage PA-2", "Aus cus"]
    assert got["Aus bus cus"]["p"]["apparent_rank"] == "infraspecies" and got["Aus sp. X12"]["p"]["specimen_code"] == "X12" and got["Aus x bus"]["p"]["hybrid"]
    assert got["Aus"]["p"]["clade_name"] == "Aus"
    a = spark.range(1).select(names.authority(F.lit("(L., 1758)")).alias("a")).first()["a"]
    assert (a["authors"], a["year"], a["is_basionym"]) == ("L.", "1758", True)


def test_mapping_classes(spark):
    edges = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "2"), ("d", "3"), ("d", "4"), ("e", "5"), ("e", "6"), ("f", "6")], "main string, ref string")
    classes = reconcile.map_classes(edges)
    assert {(r["main"], r["class"]) for r in classes.collect()} == {("a", "unique"), ("b", "merge"), ("c", "merge"), ("d", "split"), ("e", "snarl"), ("f", "snarl")}
    assert [r["members"] for r in reconcile.snarls(classes).collect()] == [["e", "f"]]


def test_strict_inputs_raise(spark):
    with pytest.raises(Exception, match="unknown synonym type"):
        reconcile.synonyms(spark.createDataFrame([("1", "x", "nonsense")], "uid string, name string, syn_type string")).collect()
    with pytest.raises(Exception, match="malformed source"):
        spark.range(1).select(model.parse_sources(F.lit("a:b:c"))).collect()
    with pytest.raises(Exception, match="unknown flag"):
        semgraph.claim_flags(spark.createDataFrame([("1", ["what"])], "id string, flags array<string>")).collect()


def test_releases_and_separators(spark):
    par, t = _tree(spark, n=200, seed=7)
    moved = t.withColumn("par_id", F.when(F.col("uid") == "n30", "n1").otherwise(F.col("par_id")))
    log = diff.edit_log(t, moved).collect()
    assert {r["uid"] for r in log} == ({"n30", "n1", par["n30"]} if par["n30"] != "n1" else set())
    found = separators.candidates(t)
    top = {r["uid"] for r in separators.confirmed(t, found).collect()}
    assert not any(a in top for u in top for a in _up(par, u)[1:])


@pytest.mark.skipif(not DATA.exists(), reason="driver tables")
@pytest.mark.parametrize("name", ["tx_partition", "tx_preorder", "tx_incertae", "align_cascade", "diff_status", "map_partition", "path_explode"])
def test_queries_agree_with_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    from cladeworks.plans.catalogue import ORACLES, QUERIES

    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    want = con.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    text = lambda rows: sorted(tuple(str(x) for x in r) for r in rows)
    assert text(QUERIES[name](spark, str(DATA)).select(*columns).collect()) == text(want.fetchall())


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
