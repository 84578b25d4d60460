"""Readers of the source formats.

Each gives (taxa, synonyms) with the canonical columns, or the table it names.
Files are read by Spark; only a manifest (meta.xml) or a header line is looked at
on the driver.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import model
from ..functions.names import canonical
from ..operators import normalize
from ..operators.folds import intervals, sums_before
from ..staging import staged

SEP = "\t|\t"


def json_triples(rows: DataFrame, key: str, column: str) -> DataFrame:
    """key, predicate, object of the top-level members of a JSON column."""
    members = F.from_json(column, "map<string,string>")
    return rows.select(key, F.explode(members).alias("predicate", "object"))


def html_links(pages: DataFrame) -> DataFrame:
    """page_id, link of every quoted href."""
    return pages.select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1))).alias("link"))


def _csv(spark: SparkSession, path: str, sep: str, header: bool = True, quote: str = "", columns: list[str] | None = None) -> DataFrame:
    """All columns as strings; columns that only a trailing separator makes are dropped."""
    reader = spark.read.option("sep", sep).option("header", header).option("quote", quote).option("inferSchema", False).option("mode", "PERMISSIVE")
    if columns:
        return reader.schema(", ".join(f"`{c}` string" for c in columns)).csv(path)
    df = reader.csv(path)
    return df.select(*[c for c in df.columns if not (header and c.startswith("_c"))])


def _have(df: DataFrame, name: str) -> Column:
    return F.nullif(F.col(name), F.lit("")) if name in df.columns else F.lit(None).cast("string")


def there(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """The interim taxonomy in any of its headers (told by their column names); short rows are filled with nulls.

    ``uid`` is a string (see model.uid_number); an empty parent is null.  Two
    different rows of one uid raise; equal ones count once.
    """
    raw = _csv(spark, path, SEP).dropDuplicates()
    out = raw.select(
        F.trim("uid").alias("uid"), F.nullif(F.trim(_have(raw, "parent_uid")), F.lit("")).alias("par_id"), _have(raw, "name").alias("name"), _have(raw, "rank").alias("rank"),
        model.parse_flags(_have(raw, "flags")).alias("flags"),
        F.coalesce(model.parse_sources(_have(raw, "sourceinfo")), F.array().cast("array<struct<src:string,id:string>>")).alias("src"),
        _have(raw, "uniqname").alias("uniqname"),
        *[model.parse_flags(_have(raw, c)).alias(c) for c in ("aut_id", "aut_yr_id", "nom_status") if c in raw.columns],
    )
    twice = normalize.duplicate_ids(out).limit(1).collect()
    if twice:
        raise ValueError(f"different rows of uid {twice[0]['uid']}")
    return out


def synonyms(spark: SparkSession, path: str | None) -> DataFrame:
    """uid, name, syn_type, syn_id, columns found by name in any order; no path, or nothing at the path: no rows."""
    if path is None or not there(spark, path):
        return spark.createDataFrame([], model.SYNONYMS)
    raw = _csv(spark, path, SEP)
    kind = F.coalesce(_have(raw, "type"), F.lit("synonym"))
    return raw.select(F.trim("uid").alias("uid"), "name", kind.alias("syn_type"), _have(raw, "syn_id").alias("syn_id"))


def headerless(spark: SparkSession, path: str, columns: list[str], sep: str = "\t") -> DataFrame:
    """All columns as strings of a file that has the interim taxonomy's columns, but no header line or other separators."""
    return _csv(spark, path, sep, header=False, columns=columns)


def id_names(taxa: DataFrame) -> DataFrame:
    return taxa.select("uid", "name")


def one_taxon(taxa: DataFrame, uid: str) -> DataFrame:
    return taxa.filter(F.col("uid") == uid).limit(1)


def ncbi(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """taxa, synonyms, forwards of nodes.dmp, names.dmp and merged.dmp; the root is its own parent there."""
    nodes = spark.read.text(f"{folder}/nodes.dmp").select(F.split(F.regexp_replace("value", r"\t\|$", ""), r"\t\|\t").alias("f"))
    nodes = nodes.select(F.trim(F.col("f")[0]).alias("uid"), F.trim(F.col("f")[1]).alias("par_id"), F.trim(F.col("f")[2]).alias("rank"))
    names = spark.read.text(f"{folder}/names.dmp").select(F.split("value", r"\t\|\t?").alias("f"))
    names = names.select(*[F.trim(F.col("f")[i]).alias(c) for i, c in enumerate(("uid", "name", "unique_name", "kind"))])
    # a series is told from what it is named after, a subgroup has its name in the unique name; both in every class of names
    series = F.when(F.col("unique_name").contains("<series>"), F.concat("name", F.lit(" series"))).otherwise(F.col("name"))
    fixed = F.when(F.col("unique_name").contains("subgroup <"), F.translate("unique_name", "<>", "")).otherwise(series)
    names = names.withColumn("name", fixed).filter("kind <> 'in-part'")
    taxa = nodes.join(names.filter("kind = 'scientific name'").select("uid", "name"), "uid", "left")
    taxa = taxa.select("uid", F.when(F.col("par_id") != F.col("uid"), F.col("par_id")).alias("par_id"), "name", "rank")
    other = names.filter("kind <> 'scientific name'").select("uid", "name", F.col("kind").alias("syn_type"), F.lit(None).cast("string").alias("syn_id"))
    merged = spark.read.text(f"{folder}/merged.dmp").select(F.split("value", r"\t\|\t?").alias("f")).select(F.trim(F.col("f")[0]).alias("old_id"), F.trim(F.col("f")[1]).alias("new_id"))
    return taxa, other, merged


def ncbi_clean(taxa: DataFrame, syn: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Samples named after their parents, children named like their parents resolved."""
    return normalize.fix_same_names(normalize.prefix_with_parent(taxa), syn)


def darwin_core_fields(meta_xml: str) -> tuple[str, dict[str, int]]:
    """File name and term -> column of the one core of a manifest."""
    root = ET.fromstring(meta_xml)
    local = lambda e: e.tag.rsplit("}", 1)[-1]
    cores = [e for e in root if local(e) == "core"]
    if len(cores) != 1:
        raise ValueError(f"{len(cores)} core files")
    places = {}
    location = ""
    for e in cores[0].iter():
        if local(e) == "id":
            places["id"] = int(e.get("index"))
        elif local(e) == "field" and e.get("index"):
            places[e.get("term").rsplit("/", 1)[-1]] = int(e.get("index"))
        elif local(e) == "location":
            location = (e.text or "").strip()
    return location, places


# Ids that are kept although doubtful, sources that are dropped and sources of fossils (by a part of their name
# or their id), ranks that are left out.
DOUBTFUL_KEPT = ("8407745", "2391100")
DROPPED_SOURCES = ("IRMNG Homonym", "Interim Register of Marine", "International Plant Names Index", "d9a4eedb-e985-4456-ad46-3df8472e00e8")
FOSSIL_SOURCES = ("Paleobiology Database", "c33ce2f2-c3cc-43a5-a380-fe4526d63650")
IGNORED_RANKS = ("form", "variety", "subspecies", "infraspecificname")


def _from(source: Column, parts: tuple[str, ...]) -> Column:
    test = F.lit(False)
    for x in parts:
        test = test | F.coalesce(source.contains(x), F.lit(False))
    return test


def darwin_core(
    spark: SparkSession, folder: str, meta_xml: str, dropped_sources: tuple[str, ...] = DROPPED_SOURCES, strict: bool = False, ignored_ranks: tuple[str, ...] = IGNORED_RANKS
) -> tuple[DataFrame, DataFrame]:
    """taxa (``fossil``: from a fossil source) and synonyms of an archive.

    Names get their canonical form; rows of dropped sources go, and so do taxa
    of ignored ranks, whose children move to the nearest taxon that stays.
    ``strict`` raises on a status that is not known.
    """
    location, places = darwin_core_fields(meta_xml)
    raw = spark.read.text(f"{folder}/{location}").select(F.split("value", "\t", -1).alias("f"))
    at = lambda term: F.nullif(F.trim(F.get("f", F.lit(places[term]))), F.lit("")) if term in places else F.lit(None).cast("string")
    rows = raw.select(
        at("id").alias("uid"), at("parentNameUsageID").alias("par_id"), at("acceptedNameUsageID").alias("accepted"), canonical(at("scientificName")).alias("name"),
        F.lower(at("taxonRank")).alias("rank"), F.lower(at("taxonomicStatus")).alias("status"), at("nameAccordingTo").alias("source"),
    ).filter(F.col("uid").isNotNull() & (F.col("uid") != "taxonID"))
    rows = rows.filter(~_from(F.col("source"), dropped_sources)).withColumn("fossil", _from(F.col("source"), FOSSIL_SOURCES))
    status = F.coalesce("status", F.lit("accepted"))
    is_syn = F.col("accepted").isNotNull() & (F.col("accepted") != F.col("uid"))
    syn = rows.filter(is_syn | status.contains("synonym")).filter("accepted is not null")
    kept = rows.filter(~is_syn & ~status.contains("synonym") & ((status != "doubtful") | F.col("uid").isin(*DOUBTFUL_KEPT)))
    if strict:
        bad = F.raise_error(F.concat(F.lit("status "), status)).cast("string")
        kept = kept.withColumn("uid", F.when(status.isin("accepted", "doubtful", "provisionally accepted"), F.col("uid")).otherwise(bad))
    taxa = kept.select("uid", "par_id", "name", "rank", "fossil")
    low = taxa.filter(F.col("rank").isin(*ignored_ranks))
    taxa = normalize.collapse(taxa, low).drop("flags") if ignored_ranks else taxa
    return taxa, syn.select(F.col("accepted").alias("uid"), "name", F.lit("synonym").alias("syn_type"), F.col("uid").alias("syn_id"))


def irmng(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """taxa and synonyms of the 18-column file: species names are assembled, the authority is cut off, placeholders go."""
    raw = spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    waiting = F.exists(F.array(*[F.coalesce(F.lower(c), F.lit("")) for c in raw.columns]), lambda x: x.contains("awaiting allocation"))
    own = F.when(F.lower("TAXONRANK") == "species", F.concat_ws(" ", "GENUS", "SPECIFICEPITHET"))
    plain = F.col("SCIENTIFICNAME")
    cut = F.when(F.col("SCIENTIFICNAMEAUTHORSHIP").isNotNull() & plain.endswith(F.concat(F.lit(" "), F.col("SCIENTIFICNAMEAUTHORSHIP"))), F.expr("substr(SCIENTIFICNAME, 1, length(SCIENTIFICNAME) - length(SCIENTIFICNAMEAUTHORSHIP) - 1)")).otherwise(plain)
    rows = raw.filter(~waiting).select(F.col("TAXONID").alias("uid"), F.col("PARENTNAMEUSAGEID").alias("par_id"), F.coalesce(own, cut).alias("name"), F.lower("TAXONRANK").alias("rank"), F.col("ACCEPTEDNAMEUSAGEID").alias("accepted"))
    is_syn = F.col("accepted").isNotNull() & (F.col("accepted") != F.col("uid"))
    chain = normalize.resolve_chain(rows.filter(is_syn).select(F.col("uid").alias("old_id"), F.col("accepted").alias("new_id")))
    syn = rows.filter(is_syn).join(chain, F.col("uid") == F.col("old_id")).select(F.col("new_id").alias("uid"), "name", F.lit("synonym").alias("syn_type"), F.col("old_id").alias("syn_id"))
    taxa = normalize.reparent_by_forwards(rows.filter(~is_syn).select("uid", "par_id", "name", "rank"), chain)
    return taxa, syn


def irmng_extinct(spark: SparkSession, path: str, taxa: DataFrame, living: tuple[str, ...] = ()) -> DataFrame:
    """uid of the known taxa that the profile file marks extinct, without the ids listed as living."""
    rows = spark.read.option("header", True).option("quote", '"').csv(path).filter(F.upper("ISEXTINCT") == "TRUE").select(F.col("TAXONID").alias("uid"))
    return rows.join(taxa.select("uid"), "uid", "left_semi").filter(~F.col("uid").isin(*living)) if living else rows.join(taxa.select("uid"), "uid", "left_semi")


def silva(spark: SparkSession, path: str, preferred: DataFrame | None = None) -> DataFrame:
    """uid, par_id, name, prefix: a taxon for each path prefix, its id the preferred one or the smallest."""
    raw = spark.read.option("sep", "\t").option("header", True).csv(path)
    rows = raw.select(F.concat_ws(".", "primaryAccession", "start", "stop").alias("acc"), F.concat(F.regexp_replace("path", ";$", ""), F.lit(";"), F.col("organism_name")).alias("path"), "primaryAccession")
    parts = normalize.path_prefixes(rows)
    wanted = preferred.select(F.col("uid").alias("id"), F.lit(True).alias("preferred")) if preferred is not None else None
    parts = parts.join(wanted, "id", "left") if wanted is not None else parts.withColumn("preferred", F.lit(False))
    chosen = normalize.preferred_id(parts.select(F.col("prefix").alias("key"), "id", F.col("acc").alias("line"), F.coalesce("preferred", F.lit(False)).alias("preferred")))
    tree = normalize.path_parents(chosen.select(F.col("key").alias("prefix"), "id"))
    return tree.select(F.col("id").alias("uid"), "par_id", F.element_at(F.split("prefix", ";"), -1).alias("name"), "prefix")


def id_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("uid")).filter("uid <> ''")


def accessions_under(rows: DataFrame, prefixes: tuple[str, ...]) -> DataFrame:
    """acc of the rows (acc, path) whose path starts with any prefix."""
    test = F.lit(False)
    for p in prefixes:
        test = test | F.col("path").startswith(p)
    return rows.filter(test).select("acc")


def fasta_headers(spark: SparkSession, path: str) -> DataFrame:
    """acc, start, stop, path, name of the header lines ``>acc.start.stop path;name``."""
    pattern = r"^>(\S+)\.(\d+)\.(\d+) (.*);([^;]*)$"
    rows = spark.read.text(path).filter(F.col("value").startswith(">"))
    return rows.select(*[F.regexp_extract("value", pattern, i + 1).alias(c) for i, c in enumerate(("acc", "start", "stop", "path", "name"))])


def plant_list(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """taxa (with genera and species that names ask for) and the rows that are not accepted."""
    columns = [f"c{i}" for i in range(11)]
    raw = spark.read.option("header", True).option("quote", '"').schema(", ".join(f"{c} string" for c in columns)).csv(path)
    name = F.concat_ws(" ", *[F.nullif(F.trim(c), F.lit("")) for c in ("c4", "c5", "c6", "c8")])
    rank = F.when(F.trim("c8") != "", F.when(F.lower("c7").isin("var.", "var"), "varietas").when(F.lower("c7").isin("f.", "f"), "forma").otherwise("subspecies")).when(F.trim("c6") != "", "species").otherwise("genus")
    rows = raw.select(F.col("c0").alias("uid"), F.col("c2").alias("family"), name.alias("name"), rank.alias("rank"), F.lower("c10").alias("status"))
    good = rows.filter("status = 'accepted' or rank = 'genus'")
    made = normalize.auto_parents(good.select("uid", "name"))
    both = good.select("uid", "name", "rank", "family").unionByName(made.select("uid", "name", "rank", F.lit(None).cast("string").alias("family")))
    words = F.split("name", " ")
    above = F.when(F.size(words) >= 3, F.concat_ws(" ", words[0], words[1])).when(F.size(words) == 2, words[0])
    ids = both.groupBy("name").agg(F.min("uid").alias("par_id")).withColumnRenamed("name", "above")
    taxa = both.withColumn("above", above).join(ids, "above", "left").select("uid", F.coalesce("par_id", F.concat(F.lit("family:"), "family")).alias("par_id"), "name", "rank")
    return taxa, rows.filter("not (status = 'accepted' or rank = 'genus')")


_MARKS = r"'(?:[^']|'')*'|\[[^\]]*\]|[();]|:[^(),;\[]*|[^(),;:\[\]\s'](?:[^(),;:\[\]']*[^(),;:\[\]\s'])?"


def newick(spark: SparkSession, path: str) -> DataFrame:
    """tree, uid (preorder index from 0), par_id, name, rank of trees whose labels are ``name`` or ``rank=name``.

    Each file below ``path`` is one tree and is read in byte ranges, cut at its
    commas.  A label in quotes may hold commas and brackets; lengths and
    comments in square brackets (without commas or quotes) are left out.  Depth
    is a prefix sum of the brackets over ranges of the text; a node's parent is
    the next label one level up, found by counting these labels.  A node
    without a label, and brackets that do not match, raise; no file, no rows.
    """
    raw = spark.read.option("lineSep", ",").text(path).select("value", F.col("_metadata.file_path").alias("tree"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    raw = raw.withColumn("quotes", F.length("value") - F.length(F.replace("value", F.lit("'"))))
    cut = staged(sums_before(raw, "tree", ["block", "at"], {"before": "quotes"}))
    inside = F.col("before") % 2 == 1
    if not cut.filter(inside).isEmpty():  # commas within quotes: the pieces of a label go together again
        numbered = sums_before(cut.withColumn("begins", (~inside).cast("long")), "tree", ["block", "at"], {"begun": "begins"})
        pieces = numbered.groupBy("tree", (F.col("begun") + F.col("begins")).alias("piece")).agg(F.sort_array(F.collect_list(F.struct("block", "at", "value"))).alias("p"))
        cut = pieces.select("tree", F.col("p")[0]["block"].alias("block"), F.col("p")[0]["at"].alias("at"), F.array_join(F.col("p.value"), ",").alias("value"))
    marks = F.filter(F.regexp_extract_all("value", F.lit(_MARKS), F.lit(0)), lambda m: ~m.startswith(":") & ~m.startswith("["))
    kinds = F.array_join(F.transform("marks", lambda m: F.when(m.isin("(", ")", ";"), m).otherwise("L")), "")
    checked = F.when(kinds.rlike(r"^\(*L(\)L)*;?$"), F.col("marks")).otherwise(F.raise_error(F.concat(F.lit("a node without a label, or with two, near: "), F.substring("value", 1, 60))).cast("array<string>"))
    flat = cut.withColumn("marks", marks).select("tree", "block", "at", F.posexplode(checked).alias("i", "m"))
    step = F.when(F.col("m") == "(", 1).when(F.col("m") == ")", -1).otherwise(0).cast("long")
    is_label = (~F.col("m").isin("(", ")", ";")).cast("long")
    placed = sums_before(flat.withColumns({"step": step, "is_label": is_label}), "tree", ["block", "at", "i"], {"depth": "step", "place": "is_label"})
    nodes = staged(placed.filter("is_label = 1").select("tree", "depth", "place", F.replace(F.regexp_replace("m", "^'|'$", ""), F.lit("''"), F.lit("'")).alias("label")))
    odd = nodes.groupBy("tree").agg(F.count_if(F.col("depth") == 0).alias("roots"), F.min("depth").alias("least")).filter("roots <> 1 or least < 0").limit(1).collect()
    if odd:
        raise ValueError(f"brackets do not match in {odd[0]['tree']}")
    # labels come after their children's: the parent is the first label one level up that is yet to come
    level = lambda d, v: nodes.select(F.struct("tree", (F.col("depth") + d).alias("depth")).alias("level"), "place", F.lit(v).cast("long").alias("answers"))
    counted = staged(sums_before(level(-1, 0).unionByName(level(0, 1)), "level", ["place"], {"nth": "answers"}))
    up = counted.filter("answers = 0").join(counted.filter("answers = 1").select("level", "nth", F.col("place").alias("parent")), ["level", "nth"])
    key = lambda place: F.struct("tree", place)
    edges = up.select(F.struct("level.tree", "place").alias("uid"), F.struct("level.tree", F.col("parent").alias("place")).alias("par_id"))
    tree = staged(nodes.select(key("place").alias("uid"), "tree", "label").join(edges, "uid", "left"))
    walk = intervals(tree.select("uid", "par_id")).select("uid", "first")
    start = walk.groupBy("uid.tree").agg(F.min("first").alias("start"))
    walk = staged(walk.select("uid", F.col("uid.tree").alias("tree"), "first").join(start, "tree").select("uid", (F.col("first") - F.col("start")).cast("string").alias("id")))
    named = tree.join(walk, "uid").join(walk.select(F.col("uid").alias("par_id"), F.col("id").alias("pid")), "par_id", "left")
    ranked = F.col("label").contains("=")
    name = F.when(ranked, F.trim(F.substring_index("label", "=", -1))).otherwise(F.col("label"))
    return named.select("tree", F.col("id").alias("uid"), F.col("pid").alias("par_id"), name.alias("name"), F.when(ranked, F.trim(F.substring_index("label", "=", 1))).otherwise("no rank").alias("rank"))


# Predicates of the additional properties by what they say.
ENTITY_IS_SYNONYM = ("P12763", "P12764", "P694")
OBJECT_IS_SYNONYM = ("P1420", "P1403")
HYBRID, AUTHOR = ("P1531",), ("P2093",)
IGNORED = ("P12765", "P12766", "P13177", "P13478", "P427", "P5304", "P1137")


def wikidata_properties(rows: DataFrame, taxa: DataFrame) -> DataFrame:
    """uid, name, kind, other of the triples (Entity, Predicate, Object) about known taxa.

    A synonym's row is that of the valid taxon, with the synonym's name and its
    id as ``other``.  Entities that are no known taxon are skipped, an unknown
    predicate of any other raises; an object that is a synonym must be known.
    """
    p = F.col("Predicate")
    kind = F.when(p.isin(*ENTITY_IS_SYNONYM), "entity_is_synonym").when(p.isin(*OBJECT_IS_SYNONYM), "object_is_synonym").when(p.isin(*HYBRID), "hybrid").when(p.isin(*AUTHOR), "author").when(p.isin(*IGNORED), "ignored").otherwise("unknown")
    known = rows.join(taxa.select(F.col("uid").alias("Entity")), "Entity", "left_semi").withColumn("kind", kind).filter("kind <> 'ignored'")
    # asked for beforehand: raise_error in the plan would also be tried on rows that the join leaves out
    unknown = known.filter("kind = 'unknown'").limit(1).collect()
    if unknown:
        raise ValueError(f"unknown predicate {unknown[0]['Predicate']}")
    swap = F.col("kind") == "entity_is_synonym"
    told = known.select(F.when(swap, F.col("Object")).otherwise(F.col("Entity")).alias("uid"), F.when(swap, F.col("Entity")).otherwise(F.col("Object")).alias("other"), "kind")
    named = told.join(taxa.select(F.col("uid").alias("other"), "name"), "other", "left").filter("kind <> 'object_is_synonym' or name is not null")
    return named.select("uid", F.coalesce("name", "other").alias("name"), "kind", "other")


def wikidata(taxa: DataFrame, properties: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Taxa that are no synonym of a known one, and the synonyms; Q prefixes are cut off."""
    syn = properties.filter("kind in ('entity_is_synonym', 'object_is_synonym')").join(taxa.select("uid"), "uid", "left_semi")
    gone = syn.select(F.col("other").alias("uid"))
    number = lambda c: F.substring(c, 2, 1000)
    rows = taxa.join(gone, "uid", "left_anti")
    return (
        rows.select(number(F.col("uid")).alias("uid"), number(F.col("par_id")).alias("par_id"), "name", "rank"),
        syn.select(number(F.col("uid")).alias("uid"), "name", F.lit("synonym").alias("syn_type"), number(F.col("other")).alias("syn_id")),
    )


# Classes whose instances are taxa.
TAXON_CLASSES = (
    "Q16521", "Q23038290", "Q47487597", "Q713623", "Q310890", "Q15458879", "Q68947", "Q210958", "Q763978",
    "Q857968", "Q21397852", "Q962530", "Q7883954", "Q19862317", "Q855769", "Q98961713", "Q124477390",
)


def wikidata_entities(spark: SparkSession, path: str, taxon_classes: tuple[str, ...] = TAXON_CLASSES) -> DataFrame:
    """uid, par_id, name, rank_id of the taxa in a line-delimited entity dump (enclosing brackets and commas allowed)."""
    claim = "array<struct<mainsnak:struct<datavalue:struct<value:string>>>>"
    schema = f"id string, claims struct<P31:{claim},P171:{claim},P225:{claim},P105:{claim}>"
    rows = spark.read.text(path).select(F.from_json(F.regexp_replace("value", r",\s*$", ""), schema).alias("e")).filter("e.id is not null")
    values = lambda p: F.transform(F.col(f"e.claims.{p}"), lambda c: c["mainsnak"]["datavalue"]["value"])
    ids = lambda p: F.transform(values(p), lambda v: F.get_json_object(v, "$.id"))
    taxa = rows.filter(F.arrays_overlap(ids("P31"), F.array(*map(F.lit, taxon_classes))))
    return taxa.select("e.id", *[F.get(x, F.lit(0)).alias(n) for n, x in (("par_id", ids("P171")), ("name", values("P225")), ("rank_id", ids("P105")))]).withColumnRenamed("id", "uid")


# What items of nomenclatural status and of taxon ranks are called, and prefixes of ids elsewhere by property.
NOMENCLATURAL_STATUS = {
    "Q1093954": "nomen illegitimum", "Q30349290": "nomen invalidum", "Q15149791": "nomen utique rejiciendum", "Q941227": "nomen conservandum",
    "Q922448": "nomen dubium", "Q29995613": "superfluous name", "Q51165454": "typus conservandus", "Q68455470": "protected name",
    "Q28597224": "needing care", "Q51165361": "orthographia conservanda", "Q23038368": "nomen rejiciendum propositum",
    "Q17276482": "nomen rejiciendum", "Q749462": "replacement name", "Q15708833": "nomen conservandum propositum", "Q844326": "nomen nudum",
    "Q122735442": "nomen praeoccupatum", "Q130297303": "not validly published name", "Q15708837": "nomen utique rejiciendum propositum",
    "Q901847": "nomen oblitum", "Q70573632": "nomen approbatum", "Q2372065": "nomen correctum", "Q123561351": "ineditus",
    "Q17134993": "validly published name", "Q17487588": "unavailable combination", "Q7882332": "unavailable name", "Q15709300": "nomen protectum",
    "Q28549151": "preoccupied name", "Q1040689": "synonym", "Q42106": "synonym", "Q3766304": "species inquirenda", "Q17276484": "later homonym",
    "Q2491016": "orthographical variant", "Q18912752": "disputed", "Q17086880": "valid", "Q14594740": "recombination",
    "Q67943587": "genus neutrum conservandum",
}
RANK_ITEMS = {
    "Q113015256": "ichnospecies", "Q1153785": "subphylum", "Q1306176": "nothospecies", "Q13198444": "subseries", "Q14817220": "supertribe",
    "Q164280": "subfamily", "Q19858692": "superkingdom", "Q2007442": "infraclass", "Q21061204": "subterclass", "Q21074316": "hyporder",
    "Q2111790": "superphylum", "Q2136103": "superfamily", "Q227936": "tribe", "Q2361851": "infraphylum", "Q2455704": "subfamily",
    "Q2752679": "subkingdom", "Q279749": "form", "Q2889003": "infraorder", "Q2981883": "cohort", "Q3025161": "series", "Q3181348": "section",
    "Q3238261": "subgenus", "Q334460": "division", "Q34740": "genus", "Q3504061": "superclass", "Q35409": "family", "Q36602": "order",
    "Q36732": "kingdom", "Q37517": "class", "Q3825509": "forma specialis", "Q38348": "phylum", "Q3965313": "subtribe", "Q4150646": "cultivar group",
    "Q4886": "cultivar", "Q5867051": "subclass", "Q5867959": "suborder", "Q5868144": "superorder", "Q5998839": "subsection", "Q630771": "subvariety",
    "Q6311258": "parvorder", "Q6541077": "subcohort", "Q68947": "subspecies", "Q713623": "clade", "Q7432": "species", "Q7506274": "mirorder",
    "Q767728": "variety", "Q10861375": "subsection", "Q3491997": "subdivision", "Q21061732": "series", "Q6045742": "nothogenus",
    "Q6054535": "infralegion", "Q6054637": "sublegion", "Q7504331": "legion", "Q6054795": "superlegion", "Q10861426": "section",
    "Q3150876": "infrakingdom", "Q23760204": "superdivision", "Q59779184": "nothovariety", "Q146481": "domain", "Q59772023": "nothosubspecies",
    "Q6462265": "grandorder", "Q5469884": "form", "Q112082101": "ichnogenus", "Q1972414": "pathovar", "Q62075839": "realm",
    "Q7574964": "species group", "Q30093105": "subdivision", "Q6054237": "magnorder", "Q1993179": "supersection", "Q23759835": "infradivision",
    "Q3491996": "subdomain", "Q30093070": "division", "Q23759960": "nanorder", "Q38829": "breed", "Q3798630": "infratribe", "Q4226087": "infracohort",
    "Q123575881": "group of subspecies", "Q1297859": "species aggregate", "Q60445775": "megacohort", "Q26857882": "parvkingdom", "Q855769": "strain",
    "Q6054425": "supercohort", "Q100900625": "supersubtribe", "Q60533422": "subseries", "Q1972080": "biovar", "Q10296147": "epifamily",
    "Q26197587": "parvclass", "Q22666877": "superdomain", "Q60922428": "megaclass",
}
OTHER_IDS = {"P9157": "ott", "P846": "gbif", "P10585": "col", "P685": "ncbi", "P5055": "irmng"}


# main values stay variants, so that an object is told from a text that looks like one
_SNAKS = "map<string, array<struct<datavalue:struct<value:string>>>>"
_CLAIM = f"struct<mainsnak:struct<snaktype:string,datavalue:struct<value:variant>>,rank:string,qualifiers:{_SNAKS},references:array<struct<snaks:{_SNAKS}>>>"
_PAIRS = "array<struct<property:string,value:string>>"


def _wikidata_lines(spark: SparkSession, path: str) -> tuple[DataFrame, Column]:
    """A row for each entity's line with the uid, and its claims: by property the array of its statements."""
    line = F.rtrim(F.col("value"), F.lit(", \t\r\n"))
    # one pass of the parser a line
    parsed = F.from_json("value", f"id string, claims map<string, array<{_CLAIM}>>, odd string", {"columnNameOfCorruptRecord": "odd"})
    # through a generator, so that filters do not parse the line again
    rows = spark.read.text(path).select(line.alias("value")).select(F.explode(F.array(parsed)).alias("e"))
    rows = rows.filter("e.id is not null and (e.odd is null or json_object_keys(e.odd) is not null)")
    # where anything in a line is out of form, its statements are taken one by one
    each = F.transform_values(F.from_json("e.odd", "claims map<string, variant>")["claims"], lambda _, v: F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda s: F.from_json(s.cast("string"), _CLAIM)))
    return rows.withColumn("uid", F.col("e.id")), F.when(F.col("e.odd").isNull(), F.col("e.claims")).otherwise(each)


def _snak_pairs(found: Column) -> Column:
    """(property, value) of the snaks, null values left out."""

    def value(v: Column) -> Column:
        # only an object has fields to ask for
        return F.when(v.startswith("{"), F.coalesce(F.get_json_object(v, "$.id"), F.get_json_object(v, "$.time"), F.get_json_object(v, "$.text"), v)).otherwise(v)

    flat = F.flatten(F.transform(F.map_entries(found), lambda e: F.transform(e["value"], lambda x: F.struct(e["key"].alias("property"), value(x["datavalue"]["value"]).alias("value")))))
    return F.coalesce(F.filter(flat, lambda x: x["value"].isNotNull()), F.array().cast(_PAIRS))


def _statement(st: Column) -> dict[str, Column]:
    """rank, snak, value, qualifiers of a statement as it is parsed."""
    get = lambda path: F.try_variant_get(st["mainsnak"]["datavalue"]["value"], path, "string")
    value = F.coalesce(get("$.id"), get("$.time"), get("$.text"), get("$"))
    return {"rank": F.coalesce(st["rank"], F.lit("normal")), "snak": st["mainsnak"]["snaktype"], "value": value, "qualifiers": _snak_pairs(st["qualifiers"])}


def wikidata_statements(spark: SparkSession, path: str) -> DataFrame:
    """uid, property, place, rank, snak, value, qualifiers, references: the statements of a line-delimited entity dump.

    place is the statement's among those of its property, from 0.  snak says
    whether there is a value.  A value is the item's id, else the time, else
    the text itself.  qualifiers and references are arrays of (property,
    value), null values left out.  Lines that are no entities (brackets, broken
    JSON) are skipped; an entity without statements has no rows.
    """
    lines, claims = _wikidata_lines(spark, path)
    rows = lines.select("uid", F.explode(claims).alias("property", "found"))
    statements = rows.select("uid", "property", F.posexplode("found").alias("place", "st"))
    told = F.flatten(F.transform("st.references", lambda r: _snak_pairs(r["snaks"])))
    return statements.select("uid", "property", "place", *[c.alias(n) for n, c in _statement(F.col("st")).items()], F.coalesce(told, F.array().cast(_PAIRS)).alias("references"))


def truthy(statements: DataFrame) -> DataFrame:
    """The statements that count: the preferred ones of a property, or else its normal ones; never deprecated ones."""
    from pyspark.sql import Window

    best = F.max(F.col("rank") == "preferred").over(Window.partitionBy("uid", "property"))
    return statements.filter("rank <> 'deprecated'").withColumn("__best", best).filter((F.col("rank") == "preferred") | ~F.col("__best")).drop("__best")


# what taxa are made of
_TAXON_PROPERTIES = ("P31", "P171", "P225", "P105", *OTHER_IDS)
_SAID = f"array<struct<property:string,place:int,preferred:boolean,told:boolean,value:string,qualifiers:{_PAIRS}>>"


def _said(property: Column, place: Column, st: dict[str, Column]) -> Column:
    return F.struct(property, place, st["rank"] == "preferred", st["snak"] == "value", st["value"], F.when(property == "P225", st["qualifiers"]))


def wikidata_taxa(statements: DataFrame, taxon_classes: tuple[str, ...] = TAXON_CLASSES) -> DataFrame:
    """uid, par_id, name, rank, aut_id, aut_yr_id, nom_status, src of the taxa among the entities of ``statements``.

    rank and nom_status are names (comma-joined where there are several;
    unknown rank items are left out, an unknown status raises); the authors,
    years and status are those of the name's qualifiers; of several parents or
    names the last counts; src lists ids elsewhere as ``prefix:id``.
    """
    wanted = statements.filter(F.col("property").isin(*_TAXON_PROPERTIES) & (F.col("rank") != "deprecated"))
    said = _said(F.col("property"), F.col("place"), {c: F.col(c) for c in ("rank", "snak", "value", "qualifiers")})
    return _taxa_of(wanted.groupBy("uid").agg(F.sort_array(F.collect_list(said)).cast(_SAID).alias("all")), taxon_classes)


def wikidata_dump_taxa(spark: SparkSession, path: str, taxon_classes: tuple[str, ...] = TAXON_CLASSES) -> DataFrame:
    """``wikidata_taxa`` of a line-delimited entity dump, where an entity is one line.

    Its statements are put together within the line, so nothing is shuffled; an
    id on two lines has two rows.
    """
    lines, claims = _wikidata_lines(spark, path)
    wanted = F.filter(F.map_entries(claims), lambda e: e["key"].isin(*_TAXON_PROPERTIES) & e["value"].isNotNull())
    kept = lambda e: F.filter(F.transform(e["value"], lambda st, i: F.struct(i.alias("i"), st.alias("st"))), lambda x: F.coalesce(x["st"]["rank"], F.lit("normal")) != "deprecated")
    said = F.flatten(F.transform(wanted, lambda e: F.transform(kept(e), lambda x: _said(e["key"], x["i"], _statement(x["st"])))))
    # through a generator, so that filters do not take the statements out again
    return _taxa_of(lines.select("uid", F.explode(F.array(F.sort_array(said.cast(_SAID)))).alias("all")), taxon_classes)


def _taxa_of(own: DataFrame, taxon_classes: tuple[str, ...]) -> DataFrame:
    """Taxa from uid and ``all``, the statements of an entity in order; all is done within its row."""
    codes = lambda table: F.create_map(*[F.lit(x) for kv in table.items() for x in kv])  # noqa: E731  fixed tables
    beaten = lambda s: ~s["preferred"] & F.exists("all", lambda o: o["preferred"] & (o["property"] == s["property"]))
    used = F.filter("all", lambda s: F.coalesce(s["told"], F.lit(False)) & ~beaten(s))
    # through a generator, so that filters do not choose again
    used = own.select("uid", F.explode(F.array(used)).alias("s"))
    of = lambda p: F.filter("s", lambda x: x["property"] == p)
    values = lambda found: F.transform(found, lambda x: x["value"])
    taxa = used.filter(F.exists("s", lambda x: (x["property"] == "P31") & x["value"].isin(*taxon_classes)))
    taxa = taxa.filter(F.exists("s", lambda x: x["property"] != "P31")).select("uid", *[of(p).alias(n) for p, n in (("P171", "parents"), ("P225", "names"), ("P105", "ranks"))], F.filter("s", lambda x: x["property"].isin(*OTHER_IDS)).alias("ids"))
    ranks = F.transform("ranks", lambda x: F.try_element_at(codes(RANK_ITEMS), x["value"]))
    ids = F.array_sort(F.transform("ids", lambda x: F.struct(F.try_element_at(codes(OTHER_IDS), x["property"]).alias("prefix"), x["place"].alias("place"), x["value"].alias("value"))))

    # what the qualifiers of the last name say
    taxa = taxa.withColumn("q", F.try_element_at("names", F.lit(-1))["qualifiers"])
    listed = lambda p: values(F.filter("q", lambda x: x["property"] == p))
    status = F.transform(listed("P1135"), lambda v: F.coalesce(F.try_element_at(codes(NOMENCLATURAL_STATUS), v), F.raise_error(F.concat(F.lit("unknown nomenclatural status: "), v)).cast("string")))
    joined = lambda texts: F.coalesce(F.array_join(texts, ","), F.lit(""))
    return taxa.select(
        "uid", *[F.try_element_at(values(F.col(c)), F.lit(-1)).alias(n) for c, n in (("parents", "par_id"), ("names", "name"))], joined(F.filter(ranks, lambda x: x.isNotNull())).alias("rank"),
        joined(listed("P405")).alias("aut_id"), joined(F.array_distinct(F.transform(listed("P574"), lambda v: F.substring(v, 2, 4)))).alias("aut_yr_id"), joined(status).alias("nom_status"),
        joined(F.transform(ids, lambda x: F.concat_ws(":", x["prefix"], x["value"]))).alias("src"),
    )


# What tells the kind of a wiki page.
PAGE_MARKS = {"redirect": "#REDIRECT", "author": "{{Taxon Authorities}}", "taxon": "{{Taxonav"}


def wikispecies(spark: SparkSession, path: str) -> DataFrame:
    """title, kind of the pages of an XML dump."""
    pages = spark.read.format("xml").option("rowTag", "page").schema("title string, revision struct<text:string>").load(path)
    text, kind = F.coalesce("revision.text", F.lit("")), F.lit("other")
    for name, mark in reversed(PAGE_MARKS.items()):
        kind = F.when(F.upper(text).contains(mark.upper()), name).otherwise(kind)
    return pages.select("title", kind.alias("kind"))


def col_rows(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """taxa and synonyms of a tab file with quoted line breaks, told apart by the accepted id."""
    raw = spark.read.option("sep", "\t").option("header", True).option("multiLine", True).csv(path)
    own = raw.select(F.col("taxonID").alias("uid"), F.col("acceptedNameUsageID").alias("accepted"), F.col("parentNameUsageID").alias("par_id"), F.col("scientificName").alias("name"), F.lower("taxonRank").alias("rank"))
    return own.filter("accepted is null").drop("accepted"), own.filter("accepted is not null").select(F.col("accepted").alias("uid"), "name", F.lit("synonym").alias("syn_type"), F.col("uid").alias("syn_id"))

