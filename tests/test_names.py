"""The name parser on single names, and the canonical form by its tokens."""

import pytest
from pyspark.sql import functions as F

from cladeworks.functions import names

PARSED = [
    ("Aus (Bus) cus", {"genus": "Aus", "subgenus": "Bus", "sp_epithet": "cus", "apparent_rank": "species", "combination": "Aus cus"}),
    ("Aus (Bus) cus Smith, 1901", {"subgenus": "Bus", "sp_epithet": "cus", "authors": "Smith", "year": "1901", "apparent_rank": "species"}),
    ("Aus bus ex Smith, 1901", {"sp_epithet": "bus", "infra_epithet": None, "authors": "ex Smith", "apparent_rank": "species"}),
    ("Aus (Smith)", {"subgenus": "Smith"}), ("Aus (L.)", {"subgenus": None, "original_authors": "L.", "higher_group_name": "Aus"}),
    ("Aus (Smith & Jones) Müller, 1901b", {"original_authors": "Smith & Jones", "authors": "Müller", "year": "1901b"}),
    ("Aus bus (Smith & de Vries, 1900) Jones et al., 1920", {"original_authors": "Smith & de Vries", "original_year": "1900", "authors": "Jones et al.", "year": "1920"}),
    ("Aus bus var. cus f. dus", {"infra_epithet": "cus", "infra_mark": "var.", "combination": "Aus bus var. cus"}),
    ("Aus bus cus dus", {"infra_epithet": "cus", "specimen_code": "dus"}),
    ("Aus bus-cus d'Orbigny, 1850", {"sp_epithet": "bus-cus", "authors": "d'Orbigny"}),
    ("Áus ñus Łukasz", {"genus": "Áus", "sp_epithet": "ñus", "authors": "Łukasz"}),
    ("A. bus L.", {"genus": "A.", "sp_epithet": "bus"}), ("Aus sp.", {"undescribed": True, "specimen_code": None, "genus": "Aus"}), ("Aus aff. bus strain 7", {"undescribed": True, "specimen_code": "bus strain 7"}),
    ("Aus bus x A. cus x dus", {"hybrid": True, "hybrid_parts": ["Aus bus", "A. cus", "dus"], "genus": None, "apparent_rank": None}), ("×Aus bus", {"hybrid": True, "hybrid_parts": ["Aus bus"]}),
    ("Entero phage PA-2", {"higher_group_name": "Entero phage PA-2", "apparent_rank": "clade"}), ("environmental samples", {"higher_group_name": "environmental", "specimen_code": "samples"}),
    ("uncultured", {"higher_group_name": "uncultured", "clade_name": "uncultured"}), ("", {"higher_group_name": "", "genus": None}), ("( ) , &", {"higher_group_name": "( ) , &"}), ("Aus (", {"higher_group_name": "Aus"}),
    (None, {"genus": None, "apparent_rank": None, "undescribed": False, "hybrid": False}), ("  Aus \t bus ", {"combination": "Aus bus"}),
]


def test_parsed_names(spark):
    rows = [(k, n) for k, (n, _) in enumerate(PARSED)] + [(1000, "Aus " + "bus " * 3000)]
    got = {r["k"]: r["p"] for r in spark.createDataFrame(rows, "k int, n string").select("k", names.parsed(F.col("n")).alias("p")).collect()}
    for k, (n, want) in enumerate(PARSED):
        assert {c: got[k][c] for c in want} == want, n
    assert got[1000]["infra_epithet"] == "bus" and len(got[1000]["specimen_code"]) == 4 * 2998 - 1


@pytest.mark.parametrize(
    ("name", "want"),
    [
        ("Ajuga pyramidalis L.", "Ajuga pyramidalis"), ("Foo bar Putnam, 1972", "Foo bar"), ("Foo bar Putnam 1972", "Foo bar Putnam 1972"), ("Aus bus cus dus Smith", "Aus bus cus dus"), ("Aus bus cus dus eus Smith", "Aus bus cus dus eus Smith"),
        ("Aus (Bus) cus Smith, 1901", "Aus cus"), ("Aus (Bus) cus", "Aus"), ("Aus (Bus) Smith", "Aus"), ("Aus  bus   Smith", "Aus  bus"), ("Aus de Vries", "Aus"), ("Aus de", "Aus de"), ("Aus d'Orb", "Aus"), ("Aus bus A", "Aus bus A"),
        ("Aus bus A.", "Aus bus"), ("Tobacco virus Smith", "Tobacco virus Smith"), ("Aus b5 Smith, 1901", "Aus b5"), ("", ""), (None, None), ("Aus", "Aus"),
    ],
)
def test_canonical(spark, name, want):
    assert spark.createDataFrame([(name,)], "n string").select(names.canonical(F.col("n"))).first()[0] == want
