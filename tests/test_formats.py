"""Every reader's query against its SQL on the smallest tables."""

from pathlib import Path

import pytest

from cladeworks.plans import catalogue, formats, relations  # noqa: F401

DATA = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not DATA.is_dir(), reason="no tables")
@pytest.mark.parametrize("name", [n for n in catalogue.QUERIES if n.startswith("read_")])
def test_reader(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    got = catalogue.QUERIES[name](spark, str(DATA))
    want = con.execute(catalogue.ORACLES[name])
    at = [[c[0] for c in want.description].index(c) for c in got.columns]
    want = sorted(repr(tuple(r[k] for k in at)) for r in want.fetchall())
    assert want and sorted(repr(tuple(r)) for r in got.collect()) == want


@pytest.mark.skipif(not DATA.is_dir(), reason="no tables")
@pytest.mark.parametrize("name", ["tx_indented", "tx_rank_indented", "sem_concepts", "sem_canonical_names", "sem_synonym_kinds", "names_by_rank", "align_fragments", "tx_moved_roots"])
def test_trees_names_and_fragments(spark, name):
    test_reader(spark, name)
