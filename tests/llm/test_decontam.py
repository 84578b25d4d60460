import hashlib
import re

import pytest

from cladeworks.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def _brute(rows, items, window=13, share=20):
    grams = []
    for item, text in items:
        w = WORD.findall(_lower(text))
        if w:
            m = min(window, len(w))
            grams += [(str(item), tuple(w[i : i + m])) for i in range(len(w) - m + 1)]
    out = []
    for doc, text in rows:
        w = WORD.findall(_lower(text))
        hit, ids = set(), set()
        for item, g in grams:
            for i in range(len(w) - len(g) + 1):
                if tuple(w[i : i + len(g)]) == g:
                    hit |= set(range(i, i + len(g)))
                    ids.add(item)
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit) and share * len(hit) >= len(w)))
    return sorted(out, key=str)


@pytest.fixture
def benchmark(spark, odd_rows):
    long = next(t for i, t in odd_rows if i == 8)
    passage = " ".join(long.split()[10:30])
    items = [(1, passage.upper() + "!"), (10, "one"), (2, None), (3, "..."), (4, "Two, words"), (5, "never seen " * 9), (1, "second text of item one")]
    return items, spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("bound", [1 << 20, 0])
def test_matches_brute_force(odd_docs, odd_rows, benchmark, bound):
    items, table = benchmark
    got = sorted([tuple(r) for r in decontam.report(odd_docs, table, broadcast_bytes=bound).collect()], key=str)
    assert got == _brute(odd_rows, items)
    assert any(r[-1] for r in got)


def test_clean(odd_docs, odd_rows, benchmark):
    items, table = benchmark
    bad = {r[0] for r in _brute(odd_rows, items) if r[-1]}
    for bound in (1 << 20, 0):
        left = decontam.clean(odd_docs, table, broadcast_bytes=bound)
        assert left.columns == odd_docs.columns
        assert sorted([(r["doc_id"], r["text"]) for r in left.collect()], key=str) == sorted([r for r in odd_rows if r[0] not in bad], key=str)


def test_spans(spark):
    table = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x1 " * 70 + "A, b; C! tail"), (2, None)], "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in decontam.clean(docs, table, mode="spans").collect()}
    assert out == {1: "x1 " * 70 + "! tail", 2: None}


def test_empty(no_docs, odd_docs, benchmark):
    assert decontam.report(no_docs, benchmark[1]).count() == 0
    assert all(not r["contaminated"] for r in decontam.report(odd_docs, benchmark[1].limit(0)).collect())
