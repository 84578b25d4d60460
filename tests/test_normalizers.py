import pytest

from cladeworks.sources import catalog, normalizers, readers


def _rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_one_call_for_every_format(spark, tmp_path):
    sep = "\t|\t"
    (tmp_path / "interim").mkdir()
    (tmp_path / "interim/taxonomy.tsv").write_text(sep.join(("uid", "parent_uid", "name", "rank", "")) + "\n" + sep.join(("1", "", "life", "no rank", "")) + "\n")
    found = normalizers.normalize(spark, "interim", str(tmp_path / "interim") + "/")
    assert _rows(found.taxa, "uid", "par_id", "name") == [("1", None, "life")] and found.synonyms.count() == found.forwards.count() == 0  # neither file is there
    (tmp_path / "interim/forwards.tsv").write_text("id\treplacement\n9\t1\n")
    (tmp_path / "interim/synonyms.tsv").write_text(sep.join(("name", "uid", "type", "")) + "\n" + sep.join(("old life", "1", "", "")) + "\n")
    found = normalizers.normalize(spark, "interim", str(tmp_path / "interim"))
    assert _rows(found.forwards, "old_id", "new_id") == [("9", "1")] and _rows(found.synonyms, "uid", "name") == [("1", "old life")]

    (tmp_path / "t.tre").write_text("(a,b)genus=X;")
    assert _rows(normalizers.normalize(spark, "newick", str(tmp_path / "t.tre")).taxa, "uid", "par_id", "name", "rank") == [("0", None, "X", "genus"), ("1", "0", "a", "no rank"), ("2", "0", "b", "no rank")]

    (tmp_path / "w.json").write_text('{"id":"Q5","claims":{"P31":[{"mainsnak":{"snaktype":"value","datavalue":{"value":{"id":"Q16521"}}},"rank":"normal"}],"P225":[{"mainsnak":{"snaktype":"value","datavalue":{"value":"Aus"}},"rank":"normal"}]}}\n')
    assert _rows(normalizers.normalize(spark, "wikidata", str(tmp_path / "w.json")).taxa, "uid", "name") == [("Q5", "Aus")]


def test_formats_of_sources():
    assert normalizers.schema_of("gbif", "anything") == "darwin core" and normalizers.schema_of("mine", "newick") == "newick"
    for schema in (None, "html"):
        with pytest.raises(ValueError, match="no normaliser"):
            normalizers.schema_of("mine", schema)


def test_no_synonym_file_and_the_later_alias(spark, tmp_path):
    assert readers.synonyms(spark, str(tmp_path / "absent.tsv")).collect() == []
    rows = [("b", 1, ["x", "y"]), ("a", 2, ["x"])]
    r = spark.createDataFrame(rows, "id string, place int, aliases array<string>")
    assert _rows(catalog.aliases(r), "alias", "id") == [("x", "a"), ("y", "b")] and _rows(catalog.aliases(r.drop("place")), "alias", "id") == [("x", "b"), ("y", "b")]
