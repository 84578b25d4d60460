"""Queries that read whole tables, on tiny tables of their own, against SQL and by hand."""

import pytest

from cladeworks.plans.catalogue import ORACLES, QUERIES


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("tables")

    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{d}/{name}.parquet")

    write("region", [(0, "AFRICA"), (1, "ASIA")], "r_regionkey int, r_name string")
    write("nation", [(0, "N0", 0), (1, "N1", 0), (2, "N2", 1)], "n_nationkey int, n_name string, n_regionkey int")
    # two large customers in the first nation, one in the second, a small one in the third
    write("customer", [(0, "C0", 0), (1, "C1", 0), (2, "C2", 1), (3, "C3", 2)], "c_custkey int, c_name string, c_nationkey int")
    write("orders", [(100 * c + i, c) for c in range(3) for i in range(20)] + [(900, 3)], "o_orderkey int, o_custkey int")
    rows = [(50, "red bolt", "B1", "T1", 1), (51, "red bolt", "B2", "T1", 7), (52, "old nut", "B3", "T2", 3), (53, "old nut", "B3", "T3", 4), (54, "new cog", "B4", "T4", 10)]
    write("part", rows, "p_partkey int, p_name string, p_brand string, p_type string, p_size int")
    return str(d)


def _rows(spark, tables, name):
    """The query's rows, which must be those of its SQL."""
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "orders", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tables}/{t}.parquet/*.parquet')")
    want = con.execute(ORACLES[name])
    columns = [c[0] for c in want.description]
    got = sorted((tuple(r) for r in QUERIES[name](spark, tables).select(*columns).collect()), key=str)
    assert got == sorted(want.fetchall(), key=str)
    return got


def test_map_partition_reads_all_of_part(spark, tables):
    assert _rows(spark, tables, "map_partition_all") == [("B1", "T1", "merge"), ("B2", "T1", "merge"), ("B3", "T2", "split"), ("B3", "T3", "split"), ("B4", "T4", "unique")]
    assert _rows(spark, tables, "map_snarls_all") == []


def test_homonyms_of_all_sizes(spark, tables):
    assert _rows(spark, tables, "sem_homonyms") == [("new cog", "new cog", "B4"), ("old nut", "old nut", "B3"), ("red bolt|B1", "red bolt", "B1"), ("red bolt|B2", "red bolt", "B2")]


def test_terminal_resource_of_every_taxon(spark, tables):
    found = dict(_rows(spark, tables, "resource_terminal"))
    assert len(found) == 1 + 2 + 3 + 4 + 61
    assert found["life"] == found["r1"] == found["n2"] == found["c3"] == found["o900"] == "o900"
    assert found["r0"] == found["n1"] == "o219" and found["n0"] == "o119" and found["c0"] == "o9"


def test_nested_separators_of_every_rank(spark, tables):
    # the customers of the first nation stay; the only one of the second goes, and the only kingdom that is large has no parent
    assert _rows(spark, tables, "sep_nested") == [("c0", "n0"), ("c1", "n0"), ("n0", "r0"), ("n1", "r0"), ("r0", None)]
