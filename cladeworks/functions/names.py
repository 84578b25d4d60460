"""Scientific names: canonical form, parts, apparent rank."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..model import GENUS, SPECIES

# Letters of names and authors, prefixes of authors, the year rule.
LOWER = "a-záåäàãçëéèïíøöóü'×?"
UPPER = "A-ZÄÁÅÁÁÇČÐĎĐÉÉÎİŁŘŠŚŞȘÔØÖÔÓÜÚŽ"
YEAR = r"^.*, [12][0-9][0-9][0-9?]\)?"

_PREFIXED = ("von", "van", "de", "dem", "der", "da", "del", "di", "le", "f.")  # author prefixes that stand as a word
_GENUS_WORD, _EPITHET_WORD = f"^[A-ZÖ{LOWER}-]+$", f"^[{LOWER}0-9.-]+$"


def canonical(name: Column) -> Column:
    """The name without authorship, and without a subgenus where authorship follows.

    The authorship begins at the first later word that looks like an author's:
    a prefix with a word after it, or a capital or bracket with more than one
    character, or a dot, behind it.  Only a first word of letters and up to
    three epithets may stand before it.  Phages and viruses keep their name,
    and so do names with a digit but no year after a comma.
    """
    bypass = name.contains(" phage ") | name.endswith(" phage") | name.contains(" virus ") | name.endswith(" virus")
    unsure = name.rlike("[0-9]") & ~name.rlike(YEAR)

    def stripped(words: Column) -> Column:
        rest = lambda i: F.array_join(F.slice(words, i + 1, F.size(words)), " ")

        def begins(i: Column) -> Column:
            word, tail = F.get(words, i), rest(i)
            joined = word.isin(*_PREFIXED) & F.substring(tail, F.length(word) + 2, 10**6).rlike(r"^(?s)(?:..|\.)")
            return joined | tail.rlike(r"^d'(?s)(?:..|\.)") | tail.rlike(rf"^[({UPPER}](?s)(?:..|\.)")

        def cut(first: Column) -> Column:
            """The words from ``first`` on before an author's, null if there is none or other words stand between."""
            at = F.get(F.filter(F.sequence(F.lit(1), F.size(words)), lambda i: (i >= first) & begins(i)), F.lit(0))
            between = F.filter(F.slice(words, first + 1, F.greatest(at - first, F.lit(0))), lambda w: w != "")
            fits = at.isNotNull() & (F.size(between) <= 3) & F.forall(between, lambda w: w.rlike(_EPITHET_WORD))
            return F.when(fits, F.slice(words, first + 1, at - first))

        head, second = F.get(words, F.lit(0)), F.get(F.filter(F.sequence(F.lit(1), F.size(words)), lambda i: F.get(words, i) != ""), F.lit(0))
        in_brackets = F.get(words, second).rlike(rf"^\([A-ZÖ{LOWER}-]+\)$")
        without_sub = F.when(in_brackets, cut(second + 1))
        plain = cut(F.lit(1))
        short = F.when(without_sub.isNotNull(), F.concat_ws(" ", head, F.nullif(F.trim(F.array_join(without_sub, " ")), F.lit("")))).when(plain.isNotNull(), F.rtrim(F.concat_ws(" ", head, F.array_join(plain, " "))))
        return F.when(head.rlike(_GENUS_WORD) & (F.size(words) > 1), short)

    words = F.split(name, " ")
    return F.when(bypass | unsure, name).otherwise(F.coalesce(F.get(F.transform(F.array(words), stripped), F.lit(0)), name))


# Marks of ranks below species and of subgenera, of open names, words that join authors.
RANK_MARKS = ("subsp.", "ssp.", "subsp", "ssp", "var.", "var", "subvar.", "f.", "fo.", "forma", "subf.", "convar.", "cv.", "nothosubsp.", "nothovar.")
SUBGENUS_MARKS = ("subgen.", "subg.", "subgenus")
SPECIES_MARKS, COMPARED_MARKS = ("sp.", "sp", "spp.", "spec."), ("cf.", "cf", "aff.", "aff", "nr.")
JOINING, PREFIXES = ("ex", "et", "in", "and", "&", "emend."), ("von", "van", "de", "dem", "der", "den", "da", "del", "di", "du", "la", "le", "zu", "ter")

_TOKEN = r"[(),&]|[^\s(),&]+"
_STATE = "struct<phase:int,first:string,subgenus:string,species:string,infra:string,mark:string,infra_mark:string,inner:string,authors:string,original:string,year:string,original_year:string,open:string,code:string>"


def _kind(t: Column) -> Column:
    """The class of a token: brackets and commas are their own; else a letter."""
    return (
        F.when(t.isin("(", ")", ","), t)
        .when(t.isin(*RANK_MARKS), "R").when(t.isin(*SUBGENUS_MARKS), "G").when(t.isin(*SPECIES_MARKS), "S").when(t.isin(*COMPARED_MARKS), "F")
        .when(t.isin(*JOINING) | t.isin(*PREFIXES) | t.startswith("d'"), "J")
        .when(t.rlike(r"^[12][0-9]{2}[0-9?][a-z]?$"), "Y")
        .when(t.rlike(r"^\p{Lu}[\p{Ll}'-]+(?:-\p{Lu}?\p{Ll}+)*$"), "U")
        .when(t.rlike(r"^\p{Ll}[\p{Ll}-]+$"), "L")
        .when(t.rlike(r"^\p{Lu}[\p{L}.'-]*$"), "I")
        .otherwise("N")
    )


def _step(s: Column, x: Column) -> Column:
    """The automaton's move.  Phases: 0 start, 1 after the genus, 2 in brackets there, 3 after an epithet, 4 authors, 5 authors in brackets, 6 what follows an open name's mark."""
    t, k, phase = x["t"], x["k"], s["phase"]
    join = lambda a: F.concat_ws(" ", a, t)
    at, is_ = lambda *p: phase.isin(*p), lambda *c: k.isin(*c)
    author = is_("U", "I", "J", "N")
    lone = s["inner"].rlike(r"^\p{Lu}[\p{Ll}-]+$")
    closes = at(2) & is_(")")
    third = at(3) & s["species"].isNotNull() & s["infra"].isNull()
    epithet = is_("L") & ((at(1) & s["species"].isNull()) | third | (at(3, 4) & s["mark"].isNotNull() & s["infra"].isNull()))
    as_species = epithet & at(1)
    as_infra = epithet & ~at(1)
    named = F.coalesce(is_("U") & at(1) & (s["mark"] == "G"), F.lit(False))
    to = (
        F.when(at(6), 6).when(at(0), F.when(is_("U", "I"), 1).when(is_("L", "N", "J"), 6).otherwise(0))
        .when(closes, F.when(lone, 1).otherwise(4)).when(at(2), 2).when(at(5), F.when(is_(")"), 4).otherwise(5))
        .when(is_("S", "F"), 6).when(epithet, 3).when(is_("R", "G"), phase).when(named, 1)
        .when(is_("("), F.when(at(1) & s["subgenus"].isNull(), 2).otherwise(5)).when(author | is_("Y", ","), 4).otherwise(phase)
    )
    in_authors = ~epithet & ~named & at(1, 3, 4) & author
    tail = at(6) | (at(1, 3, 4) & is_("L") & ~epithet)
    moved = {
        "phase": to,
        "first": F.when(at(0) & (to != 0), t).otherwise(s["first"]),
        "subgenus": F.when(closes & lone, s["inner"]).when(named, t).otherwise(s["subgenus"]),
        "species": F.when(as_species, t).otherwise(s["species"]),
        "infra": F.when(as_infra, t).otherwise(s["infra"]),
        "mark": F.when(is_("R") & at(3, 4), t).when(is_("G") & at(1), "G").when(epithet | named | author | is_("Y", "("), None).otherwise(s["mark"]),
        "infra_mark": F.when(as_infra, s["mark"]).otherwise(s["infra_mark"]),
        "inner": F.when(at(2) & ~is_(")"), join(s["inner"])).otherwise(s["inner"]),
        # authors of the species go when those of a part of it follow
        "authors": F.when(epithet, None).when(in_authors, join(s["authors"])).otherwise(s["authors"]),
        "original": F.when(epithet, None).when(closes & ~lone, s["inner"]).when(at(5) & author, join(s["original"])).otherwise(s["original"]),
        "year": F.when(epithet, None).when(at(1, 3, 4) & is_("Y"), t).otherwise(s["year"]),
        "original_year": F.when(epithet, None).when(at(5) & is_("Y"), t).otherwise(s["original_year"]),
        "open": F.when(is_("S", "F") & at(1, 3, 4), F.when(is_("S"), "sp.").otherwise("cf.")).otherwise(s["open"]),
        "code": F.when(tail, join(F.nullif(s["code"], F.lit("")))).otherwise(s["code"]),
    }
    return F.struct(*[v.alias(n) for n, v in moved.items()]).cast(_STATE)


def parsed(name: Column) -> Column:
    """A struct of the parts of a name, found by an automaton over the classes of its tokens.

    genus, subgenus, sp_epithet, infra_epithet, higher_group_name,
    specimen_code, undescribed, hybrid, combination, apparent_rank, clade_name;
    infra_mark, authors, year and original_authors, original_year (those in
    brackets, of the basionym), hybrid_parts (the names around the marks of a
    formula, which has no other parts).  A single capitalised word in brackets
    after the genus is a subgenus.  Viruses and phages, and names without a
    word, have their whole text as higher_group_name.  Null gives nulls, with
    undescribed and hybrid false.
    """
    none = F.lit(None).cast("string")

    def finish(text: Column) -> Column:
        whole = text.rlike(r"(?i)(?:^| )(?:\w*virus|phage|\w*phage|viroid)(?: |$)") | ~text.rlike(r"\p{L}")
        hybrid = text.rlike(r"(?:^| )[xX×](?: |$)|×")
        tokens = F.regexp_extract_all(F.regexp_replace(text, "^Candidatus ", ""), F.lit(_TOKEN), F.lit(0))
        classed = F.transform(tokens, lambda t: F.struct(t.alias("t"), _kind(t).alias("k")))
        start = F.struct(F.lit(0).alias("phase"), *[none.alias(f.split(":")[0]) for f in _STATE[len("struct<phase:int,"):-1].split(",")]).cast(_STATE)
        return F.transform(F.array(F.when(~whole & ~hybrid, F.aggregate(classed, start, _step))), lambda s: built(s, text, whole, hybrid))[0]

    def built(s: Column, text: Column, whole: Column, hybrid: Column) -> Column:
        open_name = s["open"].isNotNull()
        has_genus = s["species"].isNotNull() | s["subgenus"].isNotNull() | open_name
        genus = F.when(has_genus, s["first"])
        higher = F.when(whole, text).when(~has_genus, s["first"])
        rank = F.when(hybrid, none).when(s["infra"].isNotNull(), "infraspecies").when(s["species"].isNotNull(), "species").when(text.isNotNull(), "clade")
        clade = F.when(rank == "clade", F.coalesce(s["subgenus"], genus, higher))
        inner_author = s["inner"].isNotNull() & s["subgenus"].isNull()
        bracket_year = F.when(inner_author, F.nullif(F.regexp_extract(s["inner"], r"([12][0-9]{2}[0-9?])", 1), F.lit("")))
        original = F.trim(F.regexp_replace(s["original"], r"\s*,?\s*[12][0-9]{2}[0-9?].*$", ""))
        parts = {
            "genus": genus, "subgenus": s["subgenus"], "sp_epithet": s["species"], "infra_epithet": s["infra"], "higher_group_name": higher, "specimen_code": s["code"],
            "undescribed": F.coalesce(open_name, F.lit(False)) & ~F.coalesce(hybrid, F.lit(False)), "hybrid": F.coalesce(hybrid & ~whole, F.lit(False)),
            "combination": F.when(rank.isin("species", "infraspecies"), F.concat_ws(" ", genus, s["species"], s["infra_mark"], s["infra"])), "apparent_rank": rank, "clade_name": clade,
            "infra_mark": s["infra_mark"], "authors": F.when((s["mark"] == "f.") & (s["phase"] == 4), F.concat_ws(" ", s["authors"], F.lit("f."))).otherwise(s["authors"]), "year": s["year"], "original_authors": F.nullif(original, F.lit("")), "original_year": F.coalesce(s["original_year"], bracket_year),
            "hybrid_parts": F.when(hybrid & ~whole, F.filter(F.transform(F.split(text, r"(?:^| )[xX×](?: |$)|×"), lambda p: F.trim(p)), lambda p: p != "")),
        }
        return F.struct(*[v.alias(k) for k, v in parts.items()])

    return F.transform(F.array(F.trim(F.regexp_replace(name, r"\s+", " "))), finish)[0]


def by_rank(name: Column, rank_num: Column) -> Column:
    """``parsed`` with a uninomial of the genus group moved from higher_group_name to genus."""
    p = parsed(name)
    group = (rank_num > SPECIES) & (rank_num <= GENUS)
    return F.struct(
        F.when(group, F.coalesce(p["genus"], p["higher_group_name"])).otherwise(p["genus"]).alias("genus"),
        F.when(~F.coalesce(group, F.lit(False)), p["higher_group_name"]).alias("higher_group_name"),
        *[p[k].alias(k) for k in ("sp_epithet", "infra_epithet", "apparent_rank", "undescribed", "hybrid")],
    )


def authority(text: Column) -> Column:
    """authors, year, is_basionym of an authorship such as ``(L., 1758)``."""
    inner = F.trim(F.regexp_replace(text, r"[()]", ""))
    year = F.nullif(F.regexp_extract(inner, r"([12][0-9]{3})", 1), F.lit(""))
    authors = F.nullif(F.trim(F.regexp_replace(inner, r",? *[12][0-9]{3}.*$", "")), F.lit(""))
    return F.struct(authors.alias("authors"), year.alias("year"), text.rlike(r"^\(.*\)").alias("is_basionym"))


# Words and flags of names and taxa that do not enter the name graph.
SKIPPED_FLAGS = ("not_otu", "was_container", "barren")


def semanticizable(name: Column, flags: Column) -> Column:
    bad = F.lower(name).contains("environmental sample") | name.rlike("^BOLD:[A-Z0-9]+")
    return ~bad & ~F.coalesce(F.arrays_overlap(flags, F.array(*map(F.lit, SKIPPED_FLAGS))), F.lit(False))


def ascii_fold(s: Column) -> Column:
    """Common accented letters without their accents; other non-ASCII characters become ``?``."""
    plain = F.translate(s, "áàâäãåéèêëíìîïóòôöõøúùûüçñýÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕØÚÙÛÜÇÑÝ", "aaaaaaeeeeiiiioooooouuuucnyAAAAAAEEEEIIIIOOOOOOUUUUCNY")
    return F.regexp_replace(plain, r"[^\x00-\x7F]", "?")
