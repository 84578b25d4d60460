"""Partitions on disk, the registry of resources, paths upward, and the queries of look-ups against their SQL."""

import json

import pytest

from cladeworks.operators import hierarchy, normalize, partition
from cladeworks.plans.catalogue import ORACLES, QUERIES
from cladeworks.sources import catalog, writers

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["tx_with_parents", "tx_merge_lists", "resource_maps", "syn_part_lines", "tx_path_to_root", "tx_keep_ancestors"])
def test_queries_against_sql(spark, name):
    import __spark_entry__  # noqa: F401  (registers all queries)

    con = pytest.importorskip("duckdb").connect()
    for t in ("region", "nation", "customer", "orders", "lineitem", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    rows = sorted((tuple(r) for r in QUERIES[name](spark, SF).select(*columns).collect()), key=str)
    assert rows and rows == sorted(want.fetchall(), key=str)


def test_written_fragments_are_found_and_cleaned(spark, tmp_path):
    path = str(tmp_path / "parts")
    assert partition.fragments(spark, path).collect() == [] and not partition.exists(spark, path, "A")
    rows = [("1", "A"), ("2", "A/B"), ("3", "C: d")]
    partition.write(spark.createDataFrame(rows, "uid string, fragment string"), path)
    assert {r[0] for r in partition.fragments(spark, path).collect()} == {"A", "A/B", "C: d"}
    partition.clean(spark, path, "A/B")
    partition.clean(spark, path, "never there")
    assert partition.exists(spark, path, "C: d") and not partition.exists(spark, path, "A/B")
    partition.clean(spark, path)
    assert partition.fragments(spark, path).collect() == []


def test_registry(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"x": {"base": None, "aliases": ["y"]}, "z": {"base": "x"}}, indent=1))
    (tmp_path / "b.json").write_text("{}")
    (tmp_path / "all.json").write_text(json.dumps({"x": {}}))
    found = {r["id"]: json.loads(r["body"]) for r in catalog.registry(spark, str(tmp_path), ("all.json",)).collect()}
    assert found == {"x": {"base": None, "aliases": ["y"]}, "z": {"base": "x"}}
    with pytest.raises(ValueError, match="repeated: x"):
        catalog.registry(spark, str(tmp_path))


def test_part_synonyms_in_known_order(spark, tmp_path):
    syn = spark.createDataFrame([("b", "n1", "synonym"), ("a", "n2", "synonym"), ("c", "n3", "synonym"), ("b", "n0", "synonym")], "uid string, name string, syn_type string")
    order = spark.createDataFrame([("c", 1), ("b", 2), ("gone", 3)], "uid string, place int")
    path = str(tmp_path / "lines")
    writers.write_part_lines(writers.part_synonym_lines(syn, order), path)
    assert [r[0].split("\t")[0] + r[0].split("\t")[2] for r in spark.read.text(path).collect()] == ["cn3", "bn0", "bn1", "an2"]


def test_upward(spark):
    chain = [(str(i), str(i - 1) if i else None) for i in range(37)] + [("x", "5"), ("y", "not there")]
    taxa = spark.createDataFrame(chain, "uid string, par_id string")
    start = spark.createDataFrame([("20",), ("x",), ("y",), ("none",), ("x",)], "uid string")
    found = {r["uid"]: r["dist"] for r in hierarchy.upward(taxa, start).collect()}
    assert found == {**{str(i): 20 - i for i in range(6, 21)}, **{str(i): 6 - i for i in range(6)}, "x": 0, "y": 0}
    kept = {r["uid"]: r["par_id"] for r in normalize.keep_with_ancestors(taxa, start).collect()}
    assert set(kept) == set(found) and kept["y"] is None and kept["x"] == "5"
    assert hierarchy.upward(taxa, start.limit(0)).collect() == [] and hierarchy.upward(taxa.limit(0), start).collect() == []
    loop = spark.createDataFrame([("a", "b"), ("b", "a"), ("c", None)], "uid string, par_id string")
    with pytest.raises(ValueError, match="cycle"):
        hierarchy.upward(loop, start)
