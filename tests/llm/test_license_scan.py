import random
import re

import pytest
from llm_prose import prose

from cladeworks.llm import license_scan as ls

RULES = ls.signatures()
LICENCES = [
    "This work is licensed under the GNU General Public License, version 3.", "Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "licensed under the Apache License, Version 2.0",
    "SPDX-License-Identifier: GPL-3.0-or-later", "see https://creativecommons.org/licenses/by-sa/4.0/", "GNU General Public License version 2 or (at your option) any later version",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "neither the name of the University of X nor the names of its contributors may be used to endorse",
    "MIT License MIT license", "cc by cc by cc by", "CC-BY", "GNU LGPL v2.1", "Mozilla Public Licence 2.0", "the unlicense",
]
CLEAN = ["Permission was granted by the mit.", "The license of the apache pilot", "by cc, public and general", "An open road, free software of 2 0", "licenses"]


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def _brute(rows):
    out = []
    for doc, text in rows:
        words = _words(text)
        base = [(label, i) for phrase, label in ls.BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
        found = []
        line = " " + " ".join(words) + " "
        for k, r in enumerate(RULES):
            if r.priority is not None:
                for m in re.finditer(f"(?<= )(?:{r.regex})(?= )", line):
                    found.append((line[: m.start()].count(" ") - 1, line[: m.end()].count(" "), r.priority, k))
        worse = lambda d, e: e != d and e[0] <= d[0] and e[1] >= d[1] and (e[2] < d[2] or e[2] == d[2] and (e[:2] != d[:2] or e[3] < d[3]))
        kept = [d for d in found if not any(worse(d, e) for e in found)]
        weights = [RULES[k].weight for *_, k in kept] + [0.6] * bool(base)
        places = [i for _, i in base]
        labels = sorted({x for x, _ in base} | {RULES[k].label for *_, k in kept})
        out.append((doc, len(words), len(base), min(places, default=None), max(places, default=None), ",".join(sorted({x for x, _ in base})), ",".join(labels), max(weights, default=0.0)))
    return sorted(out, key=str)


def _frame(spark, rows):
    more = ("r", "l", "k", "p", 1)
    return spark.createDataFrame([(*r, *more) for r in rows], "doc_id long, text string, rule string, label string, key string, plain string, row int").repartition(3)


def _got(docs):
    return sorted(map(tuple, ls.report(docs).collect()), key=str)


def test_matches_brute_force(spark):
    """Nulls, blanks, ties, repeated rows, long texts, clashing columns, phrases side by side."""
    rng = random.Random(2)
    rows = [(k, t) for k, t in enumerate([*LICENCES, *CLEAN])]
    for k in range(60):
        parts = [prose(k * 7 + i, rng.choice([0, 3, 20])) for i in range(4)] + rng.sample(LICENCES, rng.choice([0, 1, 3])) + rng.sample(CLEAN, 1)
        rng.shuffle(parts)
        rows.append((100 + k, rng.choice([" ", "\n", ", "]).join(parts)))
    rows += [(None, None), (None, "MIT License"), (7, "MIT License"), (7, "MIT License"), (8, ""), (9, " \n\t"), (10, "MITé License mit licenses xmit license"), (11, prose(5, 6000) + " CC BY 4.0 " + prose(6, 6000) + " mit license")]
    assert _got(_frame(spark, rows)) == _brute(rows)


def test_clean_texts_and_no_documents(spark):
    assert [r[6:] for r in _got(_frame(spark, list(enumerate(CLEAN))))] == [("", 0.0)] * len(CLEAN)
    assert _got(_frame(spark, [(1, "x")]).limit(0)) == []


def test_order_of_rules(spark):
    """Containment, priority and order among rules, base places stay."""
    rules = [
        ls.Rule("base", "b c", ("b", "c"), None, 0.6), ls.Rule("wide", "a b c d", ("a", "b"), 2, 0.5), ls.Rule("same", "a b c d", ("b", "a"), 2, 0.9), ls.Rule("best", "b c", ("c", "b"), 0, 0.7),
        ls.Rule("low", "c d", ("c", "d"), 3, 0.1), ls.Rule("over", "d e", ("d", "e"), 3, 0.2), ls.Rule("gated", "c d", ("c", "zz"), 0, 1.0),
    ]
    found = ls.detections(_frame(spark, [(1, "A b. C, d E")]), rules).filter("rule is not null").collect()
    assert {(r["label"], r["first"], r["last"]) for r in found if r["kept"]} == {("base", 1, 3), ("wide", 0, 4), ("best", 1, 3), ("over", 3, 5)}
    assert {r["label"] for r in found} == {"base", "wide", "same", "best", "low", "over"}
    with pytest.raises(ValueError, match="no keyword"):
        ls.detections(_frame(spark, [(1, "x")]), [ls.Rule("x", "(?:a|b)", (), 1, 0.5)])


def test_many_places_in_one_text(spark):
    rows = [(1, "mit license " * 4000 + "cc by " * 3000)]
    assert [r[:7] for r in _got(_frame(spark, rows))] == [(1, 14000, 7000, 0, 13998, "cc-by,mit", "cc-by,mit")]


def test_each_rule_needs_its_words():
    """No rule misses a match for its keywords: whatever matches holds them."""
    for r in RULES:
        for text in LICENCES:
            line = " " + " ".join(_words(text)) + " "
            if m := re.search(f"(?<= )(?:{r.regex})(?= )", line):
                assert set(r.words) <= set(m[0].split()), r
    assert len({r.regex for r in RULES if r.priority is not None}) > 400


def test_no_python_on_the_executors(spark):
    plan = ls.report(_frame(spark, [(1, "x")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
