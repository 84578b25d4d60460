import zlib

import numpy as np
import pytest

from cladeworks.llm import mixing, quality, toxicity

from llm_prose import prose


@pytest.fixture(scope="module")
def labelled(spark):
    rows, labels = [], []
    for i in range(240):
        junk, rude = i % 5 == 0, i % 3 == 0
        text = prose(i, 60) + f" only{i * 7919 % 1000}x"
        if junk:
            text = " | ".join(text.split()) if i % 2 else " ".join(["spam"] * 80)
        if rude:
            words = text.split()
            words.insert(20, f"grobl{'abcdefgh'[i % 8]}")
            text = " ".join(words)
        rows.append((i, text, "de" if i % 4 == 0 else "en"))
        labels.append((i, int(not junk), int(rude)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def _fold(i, n):
    return zlib.crc32(("" if i is None else str(i)).encode()) % n


def test_quality_on_held_out_rows(labelled):
    docs, labels = labelled
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    out = quality.score(docs, labels).collect()
    held = [r for r in out if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if _fold(i, 4) == 2}
    assert all(r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in out)
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) >= 0.95


def test_quality_never_learns_held_out_labels(labelled, spark):
    docs, labels = labelled
    from pyspark.sql import functions as F

    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = ({r["doc_id"]: round(r["score"], 6) for r in quality.score(docs, x).collect()} for x in (labels, flipped))
    assert a == b


def test_quality_edge_cases(labelled, odd_docs, odd_rows, no_docs):
    _, labels = labelled
    out = quality.score(odd_docs, labels.limit(0)).collect()
    assert len(out) == len(odd_rows) and {r["score"] for r in out} == {0.5}
    assert quality.score(no_docs, labels).count() == 0
    left = quality.keep_good(odd_docs, labels.limit(0))
    assert left.columns == odd_docs.columns and left.count() == len(odd_rows)


def test_cholesky_scores_agree_with_densities():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, len(quality.FEATURES)))
    y = (rng.random(200) < 0.4).astype(int)
    x[y == 1] = x[y == 1] * 0.5 + 1
    model = quality.fit(np.array([(y == c).sum() for c in (0, 1)], float), np.array([x[y == c].sum(0) for c in (0, 1)]), np.array([x[y == c].T @ x[y == c] for c in (0, 1)]))
    for c in (0, 1):
        cov = np.linalg.inv(model.factors[c].T @ model.factors[c])
        d = x[:5] - model.means[c]
        part = np.log((y == c).mean()) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d)
        mine = model.logs[c] - 0.5 * ((d @ model.factors[c].T) ** 2).sum(axis=1)
        assert np.allclose(part, mine)


def test_toxicity_on_held_out_rows(labelled):
    docs, labels = labelled
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    out = toxicity.score(docs, labels).collect()
    held = [r for r in out if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if _fold(i, 5) == 0}
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) >= 0.95


def test_toxicity_grammar():
    lexicon = toxicity.Lexicon({"idiot": 4.0}, {"grob": 5.0})
    got = lambda t: list(toxicity.clauses(toxicity.words_of(t), lexicon.symbols(set(toxicity.words_of(t)))))
    assert got("You idiot.") == [{"aimed": 4.0}]
    assert got("the idiot, the grobian!") == [{"plain": 9.0}]
    assert got("that is not an idiot") == [{"negated": 4.0}]
    assert got("he said idiot") == [{"reported": 4.0}]
    assert got('the "idiot" here') == [{"reported": 4.0}]
    assert got("I will kill you") == [{"threat": 2.0}]
    assert got("never kill") == [] and got("") == [] and got("quiet words") == []
    plain, negated = (toxicity._default().score(t) for t in ("an idiot", "not an idiot"))
    assert plain > 0.5 > negated


def test_toxicity_edge_cases(labelled, odd_docs, odd_rows, no_docs):
    _, labels = labelled
    out = toxicity.score(odd_docs, labels.limit(0)).collect()
    assert len(out) == len(odd_rows) and all(r["predicted"] == 0 for r in out)
    assert toxicity.score(no_docs, labels).count() == 0


def test_mixing_matches_targets(spark):
    german = "der die das und nicht mit wasser berg haus ist".split()
    rows = [(i, " ".join(german[(i + j * j) % 10] for j in range(30)) if i % 4 == 0 else prose(i, 30), "de" if i % 4 == 0 else "en") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    known = docs.filter("doc_id % 3 = 0").select("doc_id", docs["lang"].alias("domain"))
    out = mixing.report(docs, known, {"de": 0.6, "en": 0.4}).toPandas()
    assert (out.domain == ["de" if i % 4 == 0 else "en" for i in out.doc_id]).mean() > 0.99
    mass = {d: (out.n_tokens * out[f"p_{d}"] * out.rate).sum() for d in ("de", "en")}
    assert abs(mass["de"] / sum(mass.values()) - 0.6) < 0.005 and abs(sum(mass.values()) / out.n_tokens.sum() - 1) < 0.01
    assert (out.rate >= 0).all() and ((out.copies - out.rate).abs() < 1).all()
    copies = mixing.mix(docs, known, {"de": 0.6, "en": 0.4}).groupBy("doc_id").count().toPandas().set_index("doc_id")["count"].to_dict()
    assert copies == {d: c for d, c in zip(out.doc_id, out.copies, strict=True) if c}


def test_mixing_steps_agree_with_numpy(spark):
    from pyspark.sql import functions as F

    p = [[1.0, 0.0], [0.25, 0.75], [0.0, 1.0]]
    steps = [[0.5, -0.2], [3.0, 0.1], [-0.4, 0.3]]
    rows = spark.createDataFrame([(x,) for x in p], "p array<double>").select(mixing._rate(F.col("p"), steps, 0.5, 0.001).alias("r"))
    r = np.ones(3)
    for e in steps:
        r = np.maximum(0, r - 0.5 * (np.array(p) @ np.array(e) + 0.001 * (r - 1)))
    assert np.allclose([x["r"] for x in rows.collect()], r)


def test_mixing_edge_cases(odd_docs, odd_rows, no_docs):
    known = odd_docs.select("doc_id", odd_docs["lang"].alias("domain"))
    out = mixing.report(odd_docs, known, {"fr": 0.5, "en": 0.5, "xx": 3}).collect()
    assert len(out) == len(odd_rows)
    assert mixing.report(no_docs, known, {"fr": 1}).count() == 0
    none = mixing.report(odd_docs, known.limit(0), {"fr": 1}).collect()
    assert {r["rate"] for r in none} == {1.0}
    assert mixing.mix(odd_docs, known, {"fr": 0.5, "en": 0.5}).columns == odd_docs.columns
    assert mixing.mix(no_docs, known, {"fr": 1}).count() == 0
