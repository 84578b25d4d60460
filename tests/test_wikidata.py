import json

import pytest

from cladeworks.plans import formats
from cladeworks.plans.catalogue import ORACLES, QUERIES
from cladeworks.sources import readers


def _claim(value, rank="normal", snak="value", **more):
    main = {"snaktype": snak} | ({"datavalue": {"value": value}} if snak == "value" else {})
    return {"mainsnak": main, "rank": rank, **more}


def _snak(value):
    return {"snaktype": "value", "datavalue": {"value": value}}


def _dump(tmp_path, *entities):
    lines = ["["] + [e if isinstance(e, str) else json.dumps(e) + "," for e in entities] + ["]"]
    (tmp_path / "dump.json").write_text("\n".join(lines))
    return str(tmp_path / "dump.json")


TAXON = _claim({"id": "Q16521"})


def test_statements(spark, tmp_path):
    year = {"time": "+1758-00-00T00:00:00Z"}
    name = _claim("Aus", qualifiers={"P405": [_snak({"id": "Q1"}), {"snaktype": "somevalue"}], "P574": [_snak(year)]}, references=[{"snaks": {"P248": [_snak({"id": "Q9"})], "P304": [_snak("12")]}}])
    path = _dump(tmp_path, {"id": "Q5", "claims": {"P225": [name], "P171": [_claim(None, snak="novalue")]}}, '{"broken', {"no": "id"}, {"id": "Q6", "claims": {}}, {"id": "Q7"}, "")
    got = {(r["uid"], r["property"]): r for r in readers.wikidata_statements(spark, path).collect()}
    assert set(got) == {("Q5", "P225"), ("Q5", "P171")}
    r = got["Q5", "P225"]
    assert (r["value"], r["snak"], r["rank"], r["place"]) == ("Aus", "value", "normal", 0)
    assert {tuple(q) for q in r["qualifiers"]} == {("P405", "Q1"), ("P574", "+1758-00-00T00:00:00Z")} and {tuple(q) for q in r["references"]} == {("P248", "Q9"), ("P304", "12")}
    assert got["Q5", "P171"]["value"] is None and got["Q5", "P171"]["snak"] == "novalue"


def test_taxa(spark, tmp_path):
    path = _dump(
        tmp_path,
        {"id": "Q5", "claims": {"P31": [TAXON], "P225": [_claim("Old", "deprecated"), _claim("Aus")], "P105": [_claim({"id": "Q34740"}), _claim({"id": "Q7432"}, "preferred")], "P171": [_claim({"id": "Q1"}), _claim({"id": "Q2"})]}},
        {"id": "Q6", "claims": {"P31": [_claim({"id": "Q5"})], "P225": [_claim("no taxon")]}},
        {"id": "Q7", "claims": {"P31": [TAXON], "P105": [_claim({"id": "Q0"})], "P846": [_claim("8"), _claim("9")], "P225": [_claim("Bus", qualifiers={"P574": [_snak({"time": "+1900-01-01"}), _snak({"time": "+1900-05-01"})], "P1135": [_snak({"id": "Q749462"})]})]}},
    )
    got = sorted(tuple(r) for r in readers.wikidata_taxa(readers.wikidata_statements(spark, path)).collect())
    assert got == [("Q5", "Q2", "Aus", "species", "", "", "", ""), ("Q7", None, "Bus", "", "", "1900", "replacement name", "gbif:8,gbif:9")]
    bad = _dump(tmp_path, {"id": "Q5", "claims": {"P31": [TAXON], "P225": [_claim("Aus", qualifiers={"P1135": [_snak({"id": "Q0"})]})]}})
    with pytest.raises(Exception, match="unknown nomenclatural status: Q0"):
        readers.wikidata_taxa(readers.wikidata_statements(spark, bad)).collect()


def test_odd_lines_keep_their_sound_statements(spark, tmp_path):
    quantity = _claim({"unit": "1", "amount": "+5"}, qualifiers=[])
    looks = _claim('{"b":1,"a":2}', references=[{}])
    path = _dump(tmp_path, {"id": "Q1", "claims": {"P1": [5, {"mainsnak": "bad"}, _claim("ok")], "P2": [quantity, looks]}}, {"id": "Q2", "claims": []}, '{"id":"Q3","claims":{"P1":[{"mainsnak":{"snaktype":"val')
    got = {(r["uid"], r["property"], r["place"]): r["value"] for r in readers.wikidata_statements(spark, path).collect()}
    assert got == {("Q1", "P1", 0): None, ("Q1", "P1", 1): None, ("Q1", "P1", 2): "ok", ("Q1", "P2", 0): '{"amount":"+5","unit":"1"}', ("Q1", "P2", 1): '{"b":1,"a":2}'}


def test_the_dump_is_read_once(spark, tmp_path):
    path = _dump(tmp_path, {"id": "Q5", "claims": {"P31": [TAXON], "P225": [_claim("Aus")]}})
    plan = readers.wikidata_taxa(readers.wikidata_statements(spark, path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and plan.count("from_json(") <= 3


def test_taxa_of_a_dump_need_no_shuffle(spark, tmp_path):
    name = _claim("Aus", qualifiers={"P405": [_snak({"id": "Q1"}), {"snaktype": "somevalue"}], "P574": [_snak({"time": "+1758-00-00"})], "P1135": [_snak({"id": "Q749462"})]}, references=[{"snaks": {}}])
    path = _dump(
        tmp_path,
        {"id": "Q5", "claims": {"P31": [TAXON], "P225": [_claim("Old", "deprecated"), name], "P105": [_claim({"id": "Q34740"}), _claim({"id": "Q7432"}, "preferred")], "P171": [_claim({"id": "Q1"}), _claim(None, snak="novalue")]}},
        {"id": "Q6", "claims": {"P31": [_claim({"id": "Q5"})], "P225": [name]}},
        {"id": "Q7", "claims": {"P31": [TAXON], "P1": 5, "P171": None, "P685": [7, {"mainsnak": "bad"}, _claim("3")], "P846": [_claim("9"), _claim("8")], "P225": [{"mainsnak": _snak('{"b":1}')}]}},
        {"id": "Q8", "claims": []}, {"id": "Q9"}, {"id": "Q10", "claims": {"P31": [TAXON]}}, '{"broken', "",
    )
    found = readers.wikidata_dump_taxa(spark, path)
    got = sorted(tuple(r) for r in found.collect())
    assert got == [("Q5", "Q1", "Aus", "species", "Q1", "1758", "replacement name", ""), ("Q7", None, '{"b":1}', "", "", "", "", "gbif:9,gbif:8,ncbi:3")]
    assert got == sorted(tuple(r) for r in readers.wikidata_taxa(readers.wikidata_statements(spark, path)).collect())
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    bad = _dump(tmp_path, {"id": "Q5", "claims": {"P31": [TAXON], "P225": [_claim("Aus", qualifiers={"P1135": [_snak({"id": "Q0"})]})]}})
    with pytest.raises(Exception, match="unknown nomenclatural status: Q0"):
        readers.wikidata_dump_taxa(spark, bad).collect()


def test_the_query_packs_its_dump(spark, tmp_path, monkeypatch):
    duckdb = pytest.importorskip("duckdb")
    d = str(tmp_path / "tables")
    # the first order comes twice
    tables = {
        "region": ([(0, "AFRICA")], "r_regionkey int, r_name string"), "nation": ([(0, "N0", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(c, f"C{c}", 0) for c in range(20)], "c_custkey int, c_name string, c_nationkey int"), "orders": ([(i, i % 20) for i in range(3000)] + [(0, 7)], "o_orderkey int, o_custkey int"),
    }
    con = duckdb.connect()
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{d}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{d}/{name}.parquet/*.parquet')")
    shared = tmp_path / "shared"
    monkeypatch.setattr(formats, "shared_root", lambda _: str(shared))
    found = QUERIES["read_wikidata_statements"](spark, d)
    want = con.execute(ORACLES["read_wikidata_statements"])
    columns = [c[0] for c in want.description]
    assert sorted((tuple(r) for r in found.select(*columns).collect()), key=str) == sorted(want.fetchall(), key=str)
    # plain lines of the dump take over 1000 bytes a taxon
    written = sum(f.stat().st_size for f in shared.rglob("*") if f.is_file())
    assert 0 < written < 100 * (1 + 1 + 1 + 20 + 3001)
