"""Rows that share a doc_id, or have none, are judged one by one."""

from llm_prose import prose

from cladeworks.llm import decontam, jaccard


def test_keep_one_judges_rows(spark):
    near = lambda t: " ".join([*t.split()[:-1], "changed"])
    a, b, c = prose(1, 80), prose(2, 80), prose(4, 80)
    rows = [(1, a), (5, near(a)), (5, b), (5, b), (5, None), (6, near(b)), (None, c), (None, near(c)), (None, ""), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    left = sorted([tuple(r) for r in jaccard.keep_one(docs, jaccard.Likeness(5, 80)).collect()], key=str)
    kept = [r for r in left if r[1] not in (c, near(c))]
    assert kept == sorted([(1, a), (5, b), (5, None), (None, ""), (None, None)], key=str)
    assert len(left) == len(kept) + 1  # of the near copies without an id


def test_clean_judges_rows_of_large_benchmarks(spark):
    passage = prose(9, 20)
    rows = [(1, passage), (1, prose(11, 60)), (None, f"{passage} more"), (None, prose(12, 60)), (2, f"{prose(13, 300)} , {passage} ; end"), (3, None)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, id string").repartition(3)
    table = spark.createDataFrame([(1, passage)], "item_id long, text string")
    for mode in ("documents", "spans"):
        want, got = ([tuple(r) for r in decontam.clean(docs, table, mode=mode, share=10, broadcast_bytes=bound).collect()] for bound in (1 << 20, 0))
        assert sorted(got, key=str) == sorted(want, key=str) and len(got) == 4
    assert any(r[1] and r[1].endswith(" ,  ; end") for r in got)
