import json

import pytest
from pyspark.sql import functions as F

from cladeworks.operators import partition
from cladeworks.sources import store

SCHEMA = "uid string, par_id string, name string, rank string, fragment string"


def _taxa(spark, n, name="x"):
    return spark.createDataFrame([(f"t{k}", f"t{k // 2}" if k else None, f"{name} {k}", "genus", f"F{k % 3}") for k in range(n)], SCHEMA)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_failed_write_leaves_the_old_version(spark, tmp_path, monkeypatch):
    s = store.Store(spark, str(tmp_path / "store"))
    assert s.manifest() is None and s.broken() == []
    with pytest.raises(ValueError, match="no table"):
        s.read("taxa")
    old, syn = _taxa(spark, 20), spark.createDataFrame([("t1", "old name")], "uid string, name string")
    s.write({"taxa": old, "synonyms": syn}, {"tips": 10})
    assert s.manifest()["details"] == {"tips": 10} and s.manifest()["tables"]["taxa"]["rows"] == 20 and s.broken() == []
    held = s.read("taxa")

    bad = _taxa(spark, 30, "new").withColumn("name", F.when(F.col("uid") == "t29", F.raise_error(F.lit("broken row")).cast("string")).otherwise(F.col("name")))
    for tables in ({"taxa": bad}, {"taxa": _taxa(spark, 30, "new"), "synonyms": syn.withColumn("name", F.raise_error(F.lit("broken row")).cast("string"))}):
        with pytest.raises(Exception, match="broken row"):
            s.write(tables)
        assert _rows(s.read("taxa")) == _rows(old) and _rows(s.read("synonyms")) == _rows(syn) and s.broken() == []
    monkeypatch.setattr(store.Store, "_switch", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        s.write({"taxa": _taxa(spark, 30, "new")})
    monkeypatch.undo()
    assert _rows(s.read("taxa")) == _rows(old)

    s.write({"taxa": _taxa(spark, 30, "new")})
    assert s.read("taxa").count() == 30 and _rows(held) == _rows(old)  # a reader keeps its version
    s.drop_old()
    assert s.read("taxa").count() == 30 and s.broken() == [] and len([p for p in (tmp_path / "store").iterdir() if p.name.startswith("v-")]) == 1


def test_damage_is_seen(spark, tmp_path):
    s = store.Store(spark, str(tmp_path / "store"))
    version = s.write({"taxa": _taxa(spark, 12), "none": _taxa(spark, 12).limit(0)})["version"]
    assert s.broken() == [] and s.read("none").columns == SCHEMA.replace(" string", "").split(", ")
    next((tmp_path / "store" / version / "taxa").glob("fragment=F1/*.parquet")).unlink()
    assert s.broken() == ["taxa"]


def test_order_of_lines(spark, tmp_path):
    """Known ids first and in their order, then the rest, in each fragment, over several files."""
    taxa = _taxa(spark, 300).repartition(5)
    known = [f"t{k}" for k in (250, 3, 60, 7, 100, 31, 90)]
    order = spark.createDataFrame([(u, k) for k, u in enumerate(known)] + [("absent", 99)], "uid string, place int")
    store.write_ordered(store.part_lines(taxa, order), str(tmp_path / "lines"), 8)
    files = 0
    for k in range(3):
        found = sorted((tmp_path / "lines" / f"fragment=F{k}").glob("part-*"))
        files += len(found)
        got = [line.split("\t|\t")[0] for f in found for line in f.read_text().splitlines()]
        mine = [f"t{i}" for i in range(300) if i % 3 == k]
        assert got == [u for u in known if u in mine] + sorted(u for u in mine if u not in known)
    assert files > 3


def test_maps_and_deseparation(spark):
    maps = spark.createDataFrame([("ncbi", "B", ["2", "1"]), ("ncbi", "A", ["9"]), ("gbif", "A", [])], "src string, fragment string, ids array<string>")
    assert {r["src"]: json.loads(r["json"]) for r in store.map_json(maps).collect()} == {"ncbi": {"A": ["9"], "B": ["1", "2"]}, "gbif": {"A": []}}
    taxa = spark.createDataFrame([("1", "A"), ("2", "A/b"), ("3", "A/b"), ("3", "A")], "uid string, fragment string")
    syn = spark.createDataFrame([("2", "s", "A/b"), ("2", "t", "A/b"), ("3", "u", "A"), ("3", "u", "A/b")], "uid string, name string, fragment string")
    up = spark.createDataFrame([("A/b", "A")], "fragment string, parent_fragment string")
    left, moved = partition.deseparate_with_synonyms(taxa, syn, up)
    assert _rows(left.select("uid", "fragment")) == [("1", "A"), ("2", "A"), ("3", "A")] and _rows(moved) == [("2", "s", "A"), ("2", "t", "A"), ("3", "u", "A")]
