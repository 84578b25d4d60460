"""The pipeline's five stages in a row over small tables."""

from llm_prose import prose


def test_run_end_to_end(spark, tmp_path):
    import corpus_pipeline

    base, passage = prose(50, 80), prose(9, 30)
    rows = [(i, prose(100 + i, 40 + i), "en") for i in range(8)]
    rows += [(20, base, "en"), (21, base, "fr"), (22, " ".join([*base.split()[:-1], "changed"]), "en")]  # one of them stays
    rows += [(30, passage, "en"), (31, f"{prose(60, 400)} end", "en"), (40, None, "en"), (41, "", "fr")]
    docs = [(i, t, lang, "src", len(t or "")) for i, t, lang in rows]
    write = lambda name, data, schema: spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    write("documents", docs, "doc_id long, text string, lang string, source string, n_chars long")
    write("labels", [], "doc_id long, quality int, toxic int")  # nothing is rejected, and every rate is 1
    write("benchmark", [(1, passage), (2, None)], "item_id long, text string")
    out = corpus_pipeline.run(spark, str(tmp_path))
    got = {r["doc_id"]: r for r in out.collect()}
    assert out.count() == len(got) and sorted(got) == [*range(8), 20, 31, 40, 41]
    assert all(0 <= r["shard"] < 8 for r in got.values())
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights", "sharding",
    ]


def test_run_with_labels(spark, tmp_path):
    """Junk goes, clean documents stay, copies of the rest are one, and the mix moves the languages towards their targets."""
    import corpus_pipeline
    from cladeworks.llm.queries import MIX

    junk = lambda i: " ".join(f"CLICK {i * k % 97}!!! $$$ http://x{k}.biz BUY" for k in range(30))
    lang = lambda i: ("en", "en", "en", "en", "fr", "de", "es")[i % 7]
    rows = [(i, junk(i) if i % 6 == 5 else f"{lang(i)}word {lang(i)}term " * 8 + prose(i, 60), lang(i)) for i in range(420)]
    rows += [(1000 + i, rows[i][1], rows[i][2]) for i in range(30)]  # copies
    docs = [(i, t, language, "src", len(t)) for i, t, language in rows]
    labels = [(i, int(i % 6 != 5), 0) for i in range(420) if i % 3]
    write = lambda name, data, schema: spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    write("documents", docs, "doc_id long, text string, lang string, source string, n_chars long")
    write("labels", labels, "doc_id long, quality int, toxic int")
    write("benchmark", [(1, prose(7, 40))], "item_id long, text string")

    frame, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, frame, str(tmp_path)).write.parquet(f"{tmp_path}/out-{name}")
        frame = spark.read.parquet(f"{tmp_path}/out-{name}")
        kept[name] = [r["doc_id"] for r in frame.collect()]
    good = {i for i, t, _ in rows if "CLICK" not in t}
    assert set(kept["quality classifier"]) == good
    alone = set(kept["n-gram Jaccard join"])
    assert alone == {i for i in good if i < 1000} and len(kept["n-gram Jaccard join"]) == len(alone)
    assert set(kept["benchmark decontamination"]) == alone - {7}  # its text ends with the item
    mixed = spark.read.parquet(f"{tmp_path}/out-mixing sources to target weights").groupBy("lang").count().collect()
    share = {r["lang"]: r["count"] / sum(x["count"] for x in mixed) for r in mixed}
    before = {k: sum(lang(i) == k for i in alone) / len(alone) for k in MIX}
    assert all(abs(share[k] - MIX[k]) < max(0.06, abs(before[k] - MIX[k])) for k in MIX)
    assert set(kept["sharding"]) <= alone and {r["shard"] for r in frame.select("shard").distinct().collect()} <= set(range(8))
