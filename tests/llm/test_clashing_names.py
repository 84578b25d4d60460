"""Columns named like those that operators use themselves are kept, or give way where the docstring says so."""

import pytest
from llm_prose import prose

from cladeworks.llm import decontam, line_dedup, mixing, quality, workspace

NAMES = ["__rid", "__gone", "__k", "__shared", "__row", "__hit", "__tokens", "__p", "__s", "__e", "__words", "__copy", "TEXT", "column_0"]


@pytest.fixture(scope="module")
def clashing(spark):
    run = f"{prose(1, 12)}\n{prose(2, 12)}"
    rows = [(1, run), (2, f"x\n{run}\ny"), (3, prose(9, 40)), (None, None), (4, ""), (4, "")]
    schema = ", ".join(["doc_id long", "text string", *(f"{n} string" for n in NAMES)])
    data = [(i, t, *(f"{n} of {i}" for n in NAMES)) for i, t in rows]
    return spark.createDataFrame(data, schema).repartition(2), data


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_dedup_lines(clashing):
    docs, data = clashing
    out = line_dedup.dedup_lines(docs)
    assert out.columns == ["doc_id", "text", *(n for n in NAMES if n != "__shared"), "__n_lines", "__n_deleted", "__shared"]
    found = {r[0]: tuple(r) for r in out.collect()}
    assert found[1][1] == data[0][1] and found[2][1] == "x\ny" and found[2][2] == "__rid of 2" and found[2][-3:] == (4, 2, 2)
    assert out.count() == len(data) and _rows(line_dedup.dedup_lines(docs.limit(0))) == []


@pytest.mark.parametrize("bound", [1 << 20, 0])
@pytest.mark.parametrize("mode", ["documents", "spans"])
def test_clean(spark, clashing, bound, mode):
    docs, data = clashing
    items = spark.createDataFrame([(1, prose(9, 40))], "item_id long, text string")
    out = decontam.clean(docs, items, mode=mode, broadcast_bytes=bound)
    assert out.columns == docs.columns and _rows(out) == sorted((r for r in data if r[0] != 3), key=str)


def test_mix(spark, clashing):
    docs, data = clashing
    labelled = spark.createDataFrame([(1, "a"), (3, "b")], "doc_id long, domain string")
    out = mixing.mix(docs, labelled, {"a": 0.5, "b": 0.5})
    assert out.columns == docs.columns and set(_rows(out)) <= set(data)
    assert _rows(mixing.mix(docs, labelled.limit(0), {"a": 1.0})) == sorted(data, key=str)
    assert _rows(mixing.mix(docs.limit(0), labelled, {"a": 1.0})) == []
    none, domains = mixing.rates(docs, labelled.limit(0), {"a": 1.0})
    assert domains == [] and none.columns == ["doc_id", "__tokens", "__p", "__rate", "__copies"] and none.count() == len(data)


def test_keep_good(spark, clashing):
    docs, data = clashing
    out = quality.keep_good(docs, spark.createDataFrame([], "doc_id long, quality int"))
    assert out.columns == docs.columns and _rows(out) == sorted(data, key=str)


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://there:7077")
    if spark.conf.get("spark.checkpoint.dir", None) is None and spark.sparkContext.getConf().get("spark.checkpoint.dir") is None:
        with pytest.raises(ValueError, match=r"spark.checkpoint.dir"):
            workspace.shared_root(spark)
