import pytest
from llm_prose import prose


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Copies, near copies, nulls, blanks, repeated rows, a long text, and columns whose names operators use themselves."""
    rows = [(i, prose(i, 40 + 7 * i)) for i in range(12)]
    base = prose(77, 120).split()
    rows += [(20, " ".join(base)), (21, " ".join(base)), (22, " ".join([*base[:-1], "changed"])), (23, " ".join(["Changed", *base[1:]]))]
    rows += [(30, None), (31, ""), (32, "  \n\t "), (33, "one"), (34, "one"), (35, "Two words"), (None, prose(3, 50)), (None, None)]
    rows += [(40, prose(40, 30)), (40, prose(40, 30)), (41, "é" * 50 + " " + prose(41, 6000)), (42, "a\nb\n" + prose(5, 20) + "\nc"), (43, "x\n" + prose(5, 20) + "\nd\nc")]
    schema = "doc_id long, text string, lang string, k string, node long, rank string, gone int, bucket int, key string"
    return spark.createDataFrame([(i, t, "en" if (i or 0) % 2 else "fr", "k", 1, "r", 2, 3, "x") for i, t in rows], schema).repartition(3)


@pytest.fixture(scope="session")
def odd_rows(odd_docs):
    return [(r["doc_id"], r["text"]) for r in odd_docs.collect()]


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
