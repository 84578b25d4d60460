import pytest
from pyspark.sql import functions as F

from cladeworks.sources import catalog, readers, writers


def _rows(df, *cols):
    return sorted([tuple(r) for r in df.select(*cols).collect()], key=str)


def test_interim_taxonomy(spark, tmp_path):
    sep = "\t|\t"
    text = ["uid parent_uid name rank sourceinfo uniqname flags".split() + [""], ["1", "", "life", "no rank", "", "", "", ""], ["2", "1", 'Al"pha', "genus", "ncbi:10,gbif:20", "Alpha (genus)", "hybrid,extinct", ""], ["3", "2", "x", "species"]]
    (tmp_path / "t.tsv").write_text("".join(sep.join(r) + "\n" for r in text))
    out = readers.taxonomy(spark, str(tmp_path / "t.tsv"))
    assert _rows(out, "uid", "par_id", "name", F.array_join("flags", ",")) == [("1", None, "life", ""), ("2", "1", 'Al"pha', "extinct,hybrid"), ("3", "2", "x", "")]
    assert readers.one_taxon(out, "2").first()["src"][1]["id"] == "20"
    (tmp_path / "s.tsv").write_text(f"name{sep}uid{sep}type{sep}\nOld{sep}3{sep}{sep}\n")
    assert _rows(readers.synonyms(spark, str(tmp_path / "s.tsv")), "uid", "name", "syn_type") == [("3", "Old", "synonym")]
    assert readers.synonyms(spark, None).count() == 0
    lines = [r["value"] for r in writers.taxonomy_lines(out, out.filter("uid = '3'")).orderBy("preorder_idx").collect()]
    assert lines[0].startswith("uid\t|\tparent_uid") and lines[3] == "3\t|\t2\t|\tx\t|\tspecies\t|\textinct\t|\t"
    assert [r["line"] for r in writers.indented(out).orderBy("preorder_idx").collect()] == ["life", "    Alpha (genus)", "        x"]


def test_ncbi(spark, tmp_path):
    (tmp_path / "nodes.dmp").write_text("1\t|\t1\t|\tno rank\t|\n2\t|\t1\t|\tgenus\t|\n3\t|\t2\t|\tsubgenus\t|\n4\t|\t1\t|\tfamily\t|\n5\t|\t4\t|\tfamily\t|\n6\t|\t5\t|\tspecies\t|\n")
    (tmp_path / "names.dmp").write_text("1\t|\troot\t|\t\t|\tscientific name\t|\n2\t|\tAus\t|\t\t|\tscientific name\t|\n2\t|\tOld\t|\t\t|\tsynonym\t|\n2\t|\tPart\t|\t\t|\tin-part\t|\n3\t|\tAus\t|\tAus <series>\t|\tscientific name\t|\n4\t|\tBus\t|\t\t|\tscientific name\t|\n5\t|\tBus\t|\t\t|\tscientific name\t|\n6\t|\tenvironmental samples\t|\t\t|\tscientific name\t|\n5\t|\tC\t|\t\t|\tsynonym\t|\n")
    (tmp_path / "merged.dmp").write_text("9\t|\t2\t|\n")
    taxa, syn, forwards = readers.ncbi(spark, str(tmp_path))
    assert ("3", "2", "Aus series", "subgenus") in _rows(taxa, "uid", "par_id", "name", "rank") and ("1", None, "root", "no rank") in _rows(taxa, "uid", "par_id", "name", "rank")
    assert _rows(syn, "uid", "name") == [("2", "Old"), ("5", "C")] and _rows(forwards, "old_id", "new_id") == [("9", "2")]
    clean, moved = readers.ncbi_clean(taxa, syn)
    assert ("6", "4", "Bus environmental samples") in _rows(clean, "uid", "par_id", "name") and "5" not in [r["uid"] for r in clean.collect()]
    assert _rows(moved, "uid", "name") == [("2", "Old"), ("4", "C")]


def test_darwin_core(spark, tmp_path):
    terms = "parentNameUsageID acceptedNameUsageID scientificName taxonRank taxonomicStatus nameAccordingTo".split()
    meta = '<archive xmlns="http://rs.tdwg.org/dwc/text/"><core><files><location>t.txt</location></files><id index="0"/>' + "".join(f'<field index="{i + 1}" term="http://rs.tdwg.org/dwc/terms/{t}"/>' for i, t in enumerate(terms)) + "</core></archive>"
    (tmp_path / "t.txt").write_text("1\t\t\tAnimalia\tkingdom\taccepted\tA\n2\t1\t\tAus bus (L., 1758)\tspecies\taccepted\tA\n3\t1\t2\tOld name Smith, 1900\tspecies\tsynonym\tA\n4\t1\t\tGone\tgenus\tdoubtful\tA\n5\t1\t\tOut\tgenus\taccepted\tB\n")
    taxa, syn = readers.darwin_core(spark, str(tmp_path), meta, dropped_sources=("B",))
    assert _rows(taxa, "uid", "name") == [("1", "Animalia"), ("2", "Aus bus")] and _rows(syn, "uid", "name", "syn_id") == [("2", "Old name", "3")]


def test_darwin_core_defaults(spark, tmp_path):
    meta = '<archive><core><files><location>t.txt</location></files><id index="0"/>' + "".join(f'<field index="{i + 1}" term="x/{t}"/>' for i, t in enumerate(("parentNameUsageID", "scientificName", "taxonRank", "taxonomicStatus", "nameAccordingTo"))) + "</core></archive>"
    (tmp_path / "t.txt").write_text("1\t\tAus\tgenus\taccepted\tThe Paleobiology Database\n2\t1\tAus bus\tvariety\taccepted\tA\n3\t2\tAus bus cus\tspecies\taccepted\tA\n2391100\t1\tMicropterus\tgenus\tdoubtful\tA\n5\t1\tOut\tgenus\taccepted\tThe IRMNG Homonym list\n")
    taxa, _ = readers.darwin_core(spark, str(tmp_path), meta)
    assert _rows(taxa, "uid", "par_id", "fossil") == [("1", None, True), ("2391100", "1", False), ("3", "1", False)]


def test_silva_fasta_plants(spark, tmp_path):
    (tmp_path / "m.tsv").write_text("primaryAccession\tstart\tstop\tpath\torganism_name\ttaxid\nB\t1\t9\tBacteria;Aus;\tx\t1\nA\t1\t9\tBacteria;Aus;\ty\t1\n")
    out = readers.silva(spark, str(tmp_path / "m.tsv"))
    assert _rows(out, "uid", "par_id", "name") == [("A.1.9", "A.1.9/#2", "y"), ("A.1.9/#1", None, "Bacteria"), ("A.1.9/#2", "A.1.9/#1", "Aus"), ("B.1.9", "A.1.9/#2", "x")]
    (tmp_path / "f.fa").write_text(">AB.12.34 Life;Aus;bus\nACGT\n")
    assert _rows(readers.fasta_headers(spark, str(tmp_path / "f.fa")), "acc", "start", "stop", "path", "name") == [("AB", "12", "34", "Life;Aus", "bus")]
    (tmp_path / "p.csv").write_text("id,a,family,b,genus,hyb,species,ir,ie,c,status\n1,,Fam,,Aus,,bus,,,,Accepted\n2,,Fam,,Aus,,bus,var.,cus,,Accepted\n3,,Fam,,Dus,,eus,,,,Synonym\n")
    taxa, other = readers.plant_list(spark, str(tmp_path / "p.csv"))
    assert _rows(taxa, "uid", "par_id", "rank") == [("1", "auto:Aus", "species"), ("2", "1", "varietas"), ("auto:Aus", None, "genus")] and other.count() == 1


def test_wikidata(spark, tmp_path):
    claim = lambda v: '[{"mainsnak":{"datavalue":{"value":%s}}}]' % v
    (tmp_path / "w.json").write_text('[\n{"id":"Q5","claims":{"P31":%s,"P171":%s,"P225":%s}},\n{"id":"Q6","claims":{"P31":%s}}\n]\n' % (claim('{"id":"Q16521"}'), claim('{"id":"Q4"}'), claim('"Aus"'), claim('{"id":"Q1"}')))
    assert _rows(readers.wikidata_entities(spark, str(tmp_path / "w.json")), "uid", "par_id", "name") == [("Q5", "Q4", "Aus")]


def test_wikidata_properties(spark):
    taxa = spark.createDataFrame([("Q1", None, "Aus", "genus"), ("Q2", "Q1", "Aus bus", "species"), ("Q3", "Q1", "Aus old", "species"), ("Q4", "Q1", "Aus bus", "species")], "uid string, par_id string, name string, rank string")
    rows = [("Q3", "P12763", "Q2"), ("Q2", "P1420", "Q4"), ("Q2", "P1420", "Q99"), ("Q2", "P427", "Q1"), ("Q2", "P2093", "L."), ("Q99", "P0", "Q1")]
    told = readers.wikidata_properties(spark.createDataFrame(rows, "Entity string, Predicate string, Object string"), taxa)
    assert _rows(told, "uid", "name", "kind", "other") == [("Q2", "Aus bus", "object_is_synonym", "Q4"), ("Q2", "Aus old", "entity_is_synonym", "Q3"), ("Q2", "L.", "author", "L.")]
    with pytest.raises(ValueError, match="P0"):
        readers.wikidata_properties(spark.createDataFrame([("Q2", "P0", "Q1")], "Entity string, Predicate string, Object string"), taxa)
    valid, syn = readers.wikidata(taxa, told)
    assert _rows(valid, "uid", "par_id") == [("1", None), ("2", "1")] and _rows(syn, "uid", "name", "syn_id") == [("2", "Aus bus", "4"), ("2", "Aus old", "3")]


def test_catalogue(spark):
    res = spark.createDataFrame([("a", None, "GPL", ["x"], "tsv"), ("a1", "a", None, [], None), ("a2", "a", "CC0", ["y"], None)], "id string, base string, licence string, aliases array<string>, schema string")
    assert _rows(catalog.inherited(res, ["licence", "schema"]), "id", "licence", "schema") == [("a", "GPL", "tsv"), ("a1", "GPL", "tsv"), ("a2", "CC0", "tsv")]
    assert _rows(catalog.terminal(res), "id", "terminal") == [("a", "a2"), ("a1", "a1"), ("a2", "a2")]
    assert _rows(catalog.aliases(res), "alias", "id") == [("x", "a"), ("y", "a2")]
    assert _rows(catalog.licences(res).filter("id = 'a2'"), "licence", "place") == [("CC0", 1), ("GPL", 2)]
