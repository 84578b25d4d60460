"""License scans by ordered signature rules, with DataFrame functions only.

A text is brought to lower-case words with single spaces.  A rule is a regex
over these words; it is tried only on texts that hold all its keywords (a
broadcast join by one of them, then a test of the others).  Detections are
intervals of words.  They are resolved in order: one that lies within another
whose rule has the same or a better priority is suppressed, of equal intervals
with one priority the earlier rule's stays.  Base rules' places always stay and
suppress nothing.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``regex`` is matched at word bounds; ``words`` must all be in the text.  A base rule has priority None."""

    label: str
    regex: str
    words: tuple[str, ...]
    priority: int | None
    weight: float


# Phrases and labels whose places are always reported.
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

# Families of licenses: label, names as words, versions.
FAMILIES: tuple[tuple[str, tuple[str, ...], tuple[str, ...]], ...] = (
    ("gpl", ("gnu general public licen[cs]e", "gnu gpl", "gpl"), ("1.0", "2.0", "3.0")),
    ("lgpl", ("gnu (?:lesser|library) general public licen[cs]e", "gnu lgpl", "lgpl"), ("2.0", "2.1", "3.0")),
    ("agpl", ("(?:gnu )?affero general public licen[cs]e", "gnu agpl", "agpl"), ("1.0", "3.0")),
    ("gfdl", ("gnu free documentation licen[cs]e", "gfdl"), ("1.1", "1.2", "1.3")),
    ("apache", ("apache licen[cs]e", "apache software licen[cs]e", "apache public licen[cs]e"), ("1.0", "1.1", "2.0")),
    ("mpl", ("mozilla public licen[cs]e", "mpl"), ("1.0", "1.1", "2.0")),
    ("epl", ("eclipse public licen[cs]e", "epl"), ("1.0", "2.0")),
    ("cddl", ("common development and distribution licen[cs]e", "cddl"), ("1.0", "1.1")),
    ("cpl", ("common public licen[cs]e",), ("0.5", "1.0")),
    ("eupl", ("european union public licen[cs]e", "eupl"), ("1.0", "1.1", "1.2")),
    ("afl", ("academic free licen[cs]e",), ("1.1", "1.2", "2.0", "2.1", "3.0")),
    ("osl", ("open software licen[cs]e",), ("1.0", "1.1", "2.0", "2.1", "3.0")),
    ("artistic", ("artistic licen[cs]e",), ("1.0", "2.0")),
    ("zpl", ("zope public licen[cs]e",), ("1.1", "2.0", "2.1")),
    ("lppl", ("latex project public licen[cs]e", "lppl"), ("1.0", "1.1", "1.2")),
    ("ofl", ("sil open font licen[cs]e", "open font licen[cs]e"), ("1.0", "1.1")),
    ("bsl", ("boost software licen[cs]e",), ("1.0",)),
    ("busl", ("business source licen[cs]e",), ("1.0", "1.1")),
    ("sspl", ("server side public licen[cs]e", "sspl"), ("1.0",)),
    ("elastic", ("elastic licen[cs]e",), ("1.0", "2.0")),
    ("odbl", ("open database licen[cs]e", "odbl"), ("1.0",)),
    ("odc-by", ("open data commons attribution licen[cs]e",), ("1.0",)),
    ("pddl", ("public domain dedication and licen[cs]e", "pddl"), ("1.0",)),
    ("cdla-permissive", ("community data licen[cs]e agreement permissive",), ("1.0", "2.0")),
    ("cdla-sharing", ("community data licen[cs]e agreement sharing",), ("1.0",)),
    ("ogl-uk", ("open government licen[cs]e",), ("1.0", "2.0", "3.0")),
    ("cc0", ("cc0", "creative commons zero"), ("1.0",)),
    ("cc-by", ("cc by", "creative commons attribution"), ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-sa", ("cc by sa", "creative commons attribution share ?alike"), ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc", ("cc by nc", "creative commons attribution non ?commercial"), ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nd", ("cc by nd", "creative commons attribution no ?deriv(?:ative)?s?"), ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc-sa", ("cc by nc sa", "creative commons attribution non ?commercial share ?alike"), ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("cc-by-nc-nd", ("cc by nc nd", "creative commons attribution non ?commercial no ?deriv(?:ative)?s?"), ("1.0", "2.0", "2.5", "3.0", "4.0")),
    ("php", ("php licen[cs]e",), ("3.0", "3.01")),
    ("psf", ("python software foundation licen[cs]e", "psf licen[cs]e"), ("2.0",)),
    ("ncsa", ("university of illinois ncsa open source licen[cs]e", "ncsa licen[cs]e"), ()),
    ("mit", ("mit licen[cs]e", "expat licen[cs]e", "x11 licen[cs]e"), ()),
    ("mit-0", ("mit no attribution",), ()),
    ("isc", ("isc licen[cs]e",), ()),
    ("zlib", ("zlib licen[cs]e", "zlib libpng licen[cs]e"), ()),
    ("bsd-2-clause", ("bsd 2 clause(?: licen[cs]e)?", "2 clause bsd(?: licen[cs]e)?", "simplified bsd licen[cs]e", "freebsd licen[cs]e"), ()),
    ("bsd-3-clause", ("bsd 3 clause(?: licen[cs]e)?", "3 clause bsd(?: licen[cs]e)?", "(?:new|modified|revised) bsd licen[cs]e"), ()),
    ("bsd-4-clause", ("bsd 4 clause(?: licen[cs]e)?", "4 clause bsd(?: licen[cs]e)?", "original bsd licen[cs]e"), ()),
    ("bsd", ("bsd licen[cs]e", "bsd style licen[cs]e"), ()),
    ("0bsd", ("zero clause bsd(?: licen[cs]e)?", "bsd zero clause(?: licen[cs]e)?"), ()),
    ("ms-pl", ("microsoft public licen[cs]e",), ()),
    ("ms-rl", ("microsoft reciprocal licen[cs]e",), ()),
    ("postgresql", ("postgresql licen[cs]e",), ()),
    ("openssl", ("openssl licen[cs]e",), ()),
    ("wtfpl", ("wtfpl", "do what the fuck you want to public licen[cs]e"), ()),
    ("unlicense", ("unlicense licen[cs]e", "the unlicense"), ()),
    ("cecill", ("cecill(?: [bc])? licen[cs]e", "cecill free software licen[cs]e agreement"), ("1.0", "2.0", "2.1")),
    ("openrail", ("creativeml open rail m(?: licen[cs]e)?", "openrail m(?: licen[cs]e)?", "bigscience rail licen[cs]e"), ()),
    ("llama", ("llama 2 community licen[cs]e", "llama 3 community licen[cs]e", "llama 3 [123] community licen[cs]e"), ()),
)

# Sentences of license texts: label, regex over words.
SENTENCES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies"),
    ("mit", "the software is provided as is without warranty of any kind express or implied"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "neither the name of (?:[^ ]+ ){1,12}nor the names of (?:its|their|other) contributors may be used to endorse"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("isc", "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("gpl", "you should have received a copy of the gnu general public license along with this program"),
    ("agpl", "you should have received a copy of the gnu affero general public license along with this program"),
    ("apache-2.0", "you may not use this file except in compliance with the license"),
    ("apache-2.0", "distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("bsl-1.0", "distributed under the boost software license version 1 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("ofl-1.1", "this font software is licensed under the sil open font license version 1 1"),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("psf", "psf is making python available to licensee on an as is basis"),
    ("cc0-1.0", "the person who associated a work with this deed has dedicated the work to the public domain"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution share ?alike"),
    ("cc-by", "this work is licensed under a creative commons attribution"),
    ("public-domain", "this work (?:is|has been released) (?:in|into) the public domain"),
)

# Hosts of license pages as words, by the start of the label ("": any other).
PAGES = {"cc-": "creativecommons org licenses", "gpl": "gnu org licenses", "lgpl": "gnu org licenses", "agpl": "gnu org licenses", "gfdl": "gnu org licenses", "apache": "apache org licenses license", "": "opensource org licenses?"}

SPDX, GRANT, NAMED, NAME = 0, 1, 2, 3
#: Words too frequent to be a keyword of a rule.
_PLAIN = frozenset("a an and any as at be by for in is it its not of on or the this to under use used with without you your may no do what want".split())
_GRANT = "(?:re)?(?:licensed|licenced|released|distributed|available|published|provided|offered|usable|used|shared) under (?:(?:the|an?) )?(?:(?:terms|conditions)(?: and conditions)? of )?(?:(?:the|an?) )?"


def _needed(regex: str) -> tuple[str, ...]:
    """The words that each match of a regex holds."""
    bare = re.sub(r"\[cs\]", "?", regex)
    while (less := re.sub(r"\((?:\?:)?[^()]*\)(?:\{[^}]*\}|[?*+])?", " * ", bare)) != bare:
        bare = less
    return tuple(dict.fromkeys(w for w in bare.split() if re.fullmatch("[a-z0-9]{2,}", w) and w not in _PLAIN))


def _version(version: str) -> str:
    major, minor = version.split(".")
    number = f"{major}(?: 0)?" if minor == "0" else f"{major} {minor}"
    return f"(?: licen[cs]e)?(?: international| unported)? (?:version |ver |v |v)?{number}"


def signatures() -> list[Rule]:
    """The rules in order: base phrases, SPDX tags, sentences and grants, named versions and pages, names."""
    out = [Rule(label, phrase, tuple(phrase.split()), None, 0.6) for phrase, label in BASE]

    def rule(label: str, regex: str, priority: int, weight: float) -> None:
        out.append(Rule(label, regex, _needed(regex), priority, weight))

    base = {phrase for phrase, _ in BASE}
    for label, regex in SENTENCES:
        rule(label, regex, GRANT, 0.9)
    for label, names, versions in FAMILIES:
        words = label.replace("-", " ")
        later = "(?: only)?" if label not in ("gpl", "lgpl", "agpl", "gfdl") else ""
        rule(label, f"spdx license identifier {words}{later}", SPDX, 1.0)
        for v in versions:
            number = v.replace(".", " ")
            rule(f"{label}-{v}", f"spdx license identifier {words} {number}(?: only)?", SPDX, 1.0)
            if label in ("gpl", "lgpl", "agpl", "gfdl"):
                rule(f"{label}-{v}-or-later", f"spdx license identifier {words} {number} or later", SPDX, 1.0)
            start = next(p for p in PAGES if label.startswith(p))
            stem = "" if start == "apache" else f" {words.removeprefix('cc ')}"
            rule(f"{label}-{v}", f"{PAGES[start]}{stem} {number}", NAMED, 0.9)
        for name in names:
            rule(label, f"{_GRANT}{name}", GRANT, 0.95)
            for v in versions:
                rule(f"{label}-{v}", f"{_GRANT}{name}{_version(v)}", GRANT, 0.95)
                rule(f"{label}-{v}", f"{name}{_version(v)}", NAMED, 0.8)
                if label in ("gpl", "lgpl", "agpl", "gfdl"):
                    rule(f"{label}-{v}-or-later", f"{name}{_version(v)} or (?:at your option )?(?:any )?later(?: version)?", GRANT, 0.95)
            if name.replace("[cs]", "s") not in base:
                rule(label, name, NAME, 0.5)
    return out


def rules_frame(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """(rule, label, regex, words, priority, weight, key); key is the word by which a text finds the rule, the one that the fewest rules have."""
    often: dict[str, int] = {}
    for r in rules:
        if not r.words:
            raise ValueError(f"no keyword in {r.regex}")
        for w in set(r.words):
            often[w] = often.get(w, 0) + 1
    rows = [(k, r.label, f"(?<= )(?:{r.regex})(?= )", list(r.words), r.priority, r.weight, min(r.words, key=lambda w: (often[w], w))) for k, r in enumerate(rules)]
    return spark.createDataFrame(rows, "rule int, label string, regex string, words array<string>, priority int, weight double, key string")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def plain_words(text: Column) -> Column:
    """A-Z lower-cased, words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ with one space between them; null is empty."""
    low = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)
    return F.trim(F.regexp_replace(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" ")))


def _hits(text: Column, regex: Column) -> Column:
    """For each match the spaces between it and the one before, and those in it."""
    mark = "\x01"  # no word and no space
    pieces = F.split(F.regexp_replace(text, regex, F.lit(f"{mark}$0{mark}")), mark)
    spaces = F.transform(pieces, _spaces)
    pairs = F.transform(F.sequence(F.lit(1), F.size(spaces) - 1, F.lit(2)), lambda i: F.struct(F.get(spaces, i - 1).alias("gap"), F.get(spaces, i).alias("inner")))
    return F.when(F.size(pieces) > 1, pairs)


def detections(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """row, doc_id, n_words, rule, label, priority, weight, first, last (words from 0, last exclusive), kept.

    One row for each place, and one with a null rule for each document.  row
    tells documents apart whose doc_id is null or repeated.  A null or empty
    text has no words; other columns are ignored; no documents, no rows.
    """
    table = rules_frame(docs.sparkSession, rules)
    every = sorted({w for r in rules for w in r.words})
    texts = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), plain_words(F.col("text")).alias("plain"))
    words = F.split("plain", " ")
    texts = texts.select(
        "doc_id", "row", F.when(F.col("plain") == "", 0).otherwise(F.size(words)).cast("long").alias("n_words"),
        F.array_intersect(F.array(*map(F.lit, every)), words).alias("present"), F.concat(F.lit(" "), "plain", F.lit(" ")).alias("plain"),
    )
    # the empty key is the document's own row
    keyed = texts.withColumn("key", F.explode(F.concat(F.array(F.lit("")), "present")))
    tried = keyed.join(F.broadcast(table), "key", "left")  # the rules are a fixed table
    fits = (F.col("key") == "") | (F.col("rule").isNotNull() & (F.size(F.array_except("words", "present")) == 0))
    tried = tried.filter(fits).withColumn("hits", F.when(F.col("rule").isNotNull(), _hits(F.col("plain"), F.col("regex"))))
    found = tried.filter("key = '' or hits is not null").select("row", "doc_id", "n_words", "rule", "label", "priority", "weight", F.posexplode_outer("hits").alias("k", "hit"))
    found = found.select("*", F.col("hit.gap").alias("gap"), F.col("hit.inner").alias("inner")).drop("hit").repartition("row")

    along = Window.partitionBy("row", "rule").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.sum(F.col("gap") + F.col("inner")).over(along) - F.col("inner") - 1
    placed = found.withColumn("first", first).withColumn("last", F.col("first") + F.col("inner") + 1)
    # those that start earlier, or there and end later, come first; then the better priority, then the earlier rule
    before = Window.partitionBy("row").orderBy("first", F.desc("last"), "priority", "rule").rowsBetween(Window.unboundedPreceding, -1)
    reach = [F.max(F.when(F.col("priority") <= p, F.col("last"))).over(before).alias(f"reach{p}") for p in (SPDX, GRANT, NAMED, NAME)]
    swept = placed.select("*", *reach)
    furthest = F.coalesce(*[F.when(F.col("priority") == p, F.col(f"reach{p}")) for p in (SPDX, GRANT, NAMED, NAME)], F.lit(-1))
    kept = F.col("rule").isNotNull() & (F.col("priority").isNull() | (furthest < F.col("last")))
    return swept.select("row", "doc_id", "n_words", "rule", "label", "priority", "weight", "first", "last", kept.alias("kept"))


def report(docs: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for every document.

    n_base counts all places of base rules, first_word and last_word are their
    smallest and largest start (null without any).  labels are those of base
    rules' places and of the detections that are left; both lists are distinct,
    sorted and joined by commas.  score is the largest weight of what is left,
    0 without any.
    """
    found = detections(docs, signatures() if rules is None else rules)
    base, kept = F.col("rule").isNotNull() & F.col("priority").isNull(), F.col("kept")
    names = lambda test: F.array_join(F.array_sort(F.collect_set(F.when(test, F.col("label")))), ",")
    return found.groupBy("row", "doc_id", "n_words").agg(
        F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("first"))).cast("long").alias("first_word"), F.max(F.when(base, F.col("first"))).cast("long").alias("last_word"),
        names(base).alias("base_labels"), names(kept).alias("labels"), F.coalesce(F.max(F.when(kept, F.col("weight"))), F.lit(0.0)).alias("score"),
    ).drop("row")
