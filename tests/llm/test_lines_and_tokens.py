import random

import pytest
from pyspark.sql import functions as F

from cladeworks.llm import line_dedup, token_counts

VOCABULARY = {bytes([i]): i for i in range(256)} | {b"th": 256, b"the": 257, b" the": 258, b"in": 259, b" a": 260}


def _brute_lines(rows, min_lines=2, min_words=10):
    docs = sorted({(i, t) for i, t in rows if t is not None}, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, gone, shared, place = set(), {}, {}, {}
    for n, (i, t) in enumerate(docs):
        lines = [x.strip(" ") for x in t.split("\n")]
        cut = set()
        for a in range(len(lines)):
            for k in [1, 2, 4, 8, 16]:
                run = tuple(lines[a : a + k])
                if len(run) == k and all(run):
                    place.setdefault(run, []).append(n)
            one, run = (lines[a],), tuple(lines[a : a + min_lines])
            if lines[a] and one in seen and len(lines[a].split()) >= min_words:
                cut.add(a)
            if len(run) == min_lines and all(run) and run in seen:
                cut |= set(range(a, a + min_lines))
            seen |= {one, run}
        gone[(i, t)] = cut
    for run, where in place.items():
        if len(where) > 1:
            for n in where:
                shared[docs[n]] = max(shared.get(docs[n], 0), len(run))
    out = []
    for i, t in rows:
        if t is None:
            out.append((i, None, 0, 0, 0))
        else:
            cut = gone[(i, t)]
            lines = t.split("\n")
            out.append((i, "\n".join(x for n, x in enumerate(lines) if n not in cut), len(lines), len(cut), shared.get((i, t), 0)))
    return sorted(out, key=str)


def _found(docs):
    return sorted([(r["doc_id"], r["text"], r["__n_lines"], r["__n_deleted"], r["__shared"]) for r in line_dedup.dedup_lines(docs).collect()], key=str)


def test_lines_match_brute_force(spark):
    rng = random.Random(9)
    stock = [f"line number {i}" for i in range(12)] + ["a long line of more than ten words that is seen here and there"] + ["", "  "]
    rows = [(i, "\n".join(rng.choice(stock) for _ in range(rng.randint(1, 14)))) for i in range(40)]
    rows += [(50, rows[0][1]), (51, rows[0][1]), (3, rows[3][1]), (60, None), (61, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert _found(docs) == _brute_lines(rows)


def test_lines_edge_cases(odd_docs, odd_rows, no_docs):
    out = line_dedup.dedup_lines(odd_docs)
    assert out.columns[: len(odd_docs.columns)] == odd_docs.columns and out.count() == len(odd_rows)
    assert line_dedup.dedup_lines(no_docs).count() == 0
    assert line_dedup.runs(odd_docs).filter("length = 1").count() > 0


def test_edits_agree_with_counting_anew():
    counter = token_counts.Counter(VOCABULARY)
    rng = random.Random(4)
    parts = ["a", "the", " the", "  ", "\n", "\n\n", "12", "!", "'s", "é", "in", " in a", "'", "\t"]
    for _ in range(400):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 300)))
        doc = token_counts.Document(text, counter)
        for _ in range(5):
            a = rng.randint(0, len(text))
            b, new = min(len(text), a + rng.randint(0, 9)), "".join(rng.choice(parts) for _ in range(rng.randint(0, 5)))
            text = text[:a] + new + text[b:]
            doc.replace(a, b, new)
            assert doc.text == text and doc.tokens == len(counter.encode(text)) and doc.root.chars == len(text)


def test_an_edit_encodes_its_region_only():
    doc = token_counts.Document("some words in a row " * 2000, token_counts.Counter(VOCABULARY))
    doc.replace(20_000, 20_005, "new")
    assert doc.encoded < 12 and doc.root.count > 9000


def test_counts(spark, odd_docs, odd_rows, no_docs):
    out = token_counts.count_tokens(token_counts.sample_edits(odd_docs), VOCABULARY).collect()
    encode = token_counts.Counter(VOCABULARY).encode
    assert sorted((str(r["doc_id"]), r["n_chars"], r["n_tokens"]) for r in out) == sorted((str(i), len(t or ""), len(encode(t or ""))) for i, t in odd_rows)

    def edited(t):
        n = len(t)
        for at, size, new in ((n // 3, 0, " newly added"), (n // 2, 7, ""), (2 * n // 3, 12, "Other words.\n\n")):
            t = t[:at] + new + t[at + size :]
        return t

    assert sorted((str(r["doc_id"]), r["edited_chars"], r["edited_tokens"]) for r in out) == sorted((str(i), len(edited(t or "")), len(encode(edited(t or "")))) for i, t in odd_rows)
    assert token_counts.count_tokens(no_docs, VOCABULARY).count() == 0


def test_edit_tables(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, None), (3, "x")], "doc_id long, text string")
    edits = spark.createDataFrame([(1, 2, 0, 3, "1"), (1, 1, 4, 99, "2"), (2, 1, 5, None, "new"), (3, 1, None, 1, "y")], "doc_id long, seq int, start long, end long, new string")
    out = {r["doc_id"]: r["edited_chars"] for r in token_counts.count_tokens(token_counts.with_edits(docs, edits), VOCABULARY).collect()}
    assert out == {1: 3, 2: 3, 3: 1}


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken"])
def test_public_vocabulary(name):
    tokenizers = pytest.importorskip("public_tokenizers")
    counter = token_counts.Counter(token_counts.read_ranks(tokenizers.path(name)), tokenizers.PATTERN)
    text = "It's 12 o'clock;  naïve\n\n words they'll   re-count. "
    assert token_counts.Document(text, counter).tokens == len(counter.encode(text))


def test_intervals_are_in_suffix_order(spark):
    docs = spark.createDataFrame([(1, "a\nb\nc"), (2, "a\nb\nd"), (3, "b\nc")], "doc_id long, text string")
    out = line_dedup.runs(docs).groupBy("length").agg(F.count("rank").alias("n"), F.countDistinct("rank").alias("r")).orderBy("length").collect()
    assert [(r["length"], r["n"], r["r"]) for r in out] == [(1, 3, 3), (2, 2, 2)]


def test_runs_of_any_length(spark):
    """Runs of three and five lines count where that many are asked for; shorter ones stay."""
    from cladeworks.llm import line_dedup

    rows = [(1, "a\nb\nc\nd\ne"), (2, "x\na\nb\nc\ny"), (3, "a\nb\nz"), (4, "b\nc\nd"), (5, "a\nb\nc\nd\ne\nw")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    left = lambda n: {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(docs, min_lines=n, min_words=0).collect()}
    assert left(3) == {1: "a\nb\nc\nd\ne", 2: "x\ny", 3: "a\nb\nz", 4: "", 5: "w"}
    assert left(5) == {1: "a\nb\nc\nd\ne", 2: "x\na\nb\nc\ny", 3: "a\nb\nz", 4: "b\nc\nd", 5: "w"}
