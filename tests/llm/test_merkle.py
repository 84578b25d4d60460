import hashlib
import random
import zlib

import numpy as np
import pytest

from cladeworks.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, grp int, pos string, digest string, proof int, place int"


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row, text):
    doc, _, lang, source, chars = row
    return _h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc, source, lang, chars, text)))


def _low(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def _tree(leaves, fanout):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([_h(*levels[-1][i : i + fanout]) for i in range(0, len(levels[-1]), fanout)])
    return levels


def _path(levels, i, fanout):
    """(text before, text after) of the own digest, run by run."""
    out = []
    for level in levels[:-1]:
        first = i - i % fanout
        out.append(("".join(level[first:i]), "".join(level[i + 1 : first + fanout])))
        i //= fanout
    return out


def _brute(rows, fanout=16):
    order = lambda v: (v is not None, v.encode() if isinstance(v, str) else v or 0)
    groups = {}
    for row in rows:
        groups.setdefault(row[3], []).append(row)
    sources, out = sorted(groups, key=order), []
    trees = {}
    for s in sources:
        groups[s].sort(key=lambda r: (order(r[0]), _leaf(r, r[1])))
        trees[s] = _tree([_leaf(r, r[1]) for r in groups[s]], fanout)
    top = _tree([trees[s][-1][0] for s in sources], fanout)
    for g, s in enumerate(sources):
        for i, row in enumerate(groups[s]):
            path = _path(trees[s], i, fanout) + _path(top, g, fanout)
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            now = _leaf(row, _low(row[1]) if hit else row[1])
            for before, after in path:
                now = _h(before, now, after)
            proof = _h(*(a + b for a, b in path))
            out.append((row[0], trees[s][0][i], trees[s][-1][0], top[-1][0], proof, now, now == top[-1][0]))
    return sorted(out, key=str)


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, "p", "d", 2, 3) for r in rows], SCHEMA).repartition(4)


def _got(docs, **how):
    rows = merkle.manifest(merkle.document_leaves(docs), **how).rows.collect()
    return sorted(((r["key"], r["leaf"], r["subroot"], r["root"], hashlib.sha256(bytes(r["proof"])).hexdigest(), r["folded_root"], r["verified"]) for r in rows), key=str)


def _rows(seed, sizes):
    rng = random.Random(seed)
    rows, k = [], 0
    for s, n in sizes.items():
        for _ in range(n):
            text = rng.choice([None, "", "Plain lower", "UPPER Case é Ü", f"text {k}", "x" * rng.randrange(2000)])
            rows.append((k, text, rng.choice([None, "en", "é"]), s, rng.choice([None, 0, 12])))
            k += 1
    rows += [rows[0], rows[0], (rows[1][0], "another text", None, rows[1][3], 5), (None, "no Id", "en", rows[1][3], 1), (None, None, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("fanout", "height"), [(16, 3), (16, 1), (2, 2), (3, 1)])
def test_matches_a_plain_tree(spark, fanout, height):
    """Nulls, empty and long texts, ties, repeated rows, clashing columns; sources of one row, of whole runs and of runs with a rest."""
    rows = _rows(4, {None: 3, "": 1, "a": 16, "b": 17, "B": 33, "é": 40, "hot": 300})
    found = _got(_frame(spark, rows), fanout=fanout, height=height)
    assert found == _brute(rows, fanout)
    assert {r[-1] for r in found} == {True, False}


def test_one_row_one_source_no_rows(spark):
    one = [(5, "Text", "en", "s", 4)]
    assert _got(_frame(spark, one)) == _brute(one)
    assert _got(_frame(spark, one))[0][1] == _got(_frame(spark, one))[0][3]
    many = [(k, f"T{k}", None, "s", None) for k in range(40)]
    assert _got(_frame(spark, many), height=1) == _brute(many)
    assert _got(_frame(spark, one).limit(0)) == []


def test_a_proof_stands_alone(spark):
    """The rows' proofs are whole digests; a changed proof or place gives another root, a cut one is an error."""
    rows = [(k, f"t{k}", None, "ab"[k % 2], None) for k in range(50)]
    found = sorted(merkle.manifest(merkle.document_leaves(_frame(spark, rows))).rows.collect(), key=lambda r: r["key"])
    leaf, proof, root = found[6]["leaf"].encode(), bytes(found[6]["proof"]), found[6]["root"].encode()
    places = [(3, 25), (0, 2)]
    assert merkle.folded(leaf, proof, places, 16) == root
    assert merkle.folded(leaf, b"0" * 64 + proof[64:], places, 16) != root
    assert merkle.folded(leaf, proof, [(4, 25), (0, 2)], 16) != root
    with pytest.raises(ValueError, match="another length"):
        merkle.folded(leaf, proof[:-64], places, 16)


def test_levels_of_a_matrix():
    nodes = np.frombuffer("".join(_h(str(k)) for k in range(37)).encode(), np.uint8).reshape(-1, 64)
    texts = [row.tobytes().decode() for row in nodes]
    above = [row.tobytes().decode() for row in merkle.level_above(nodes, 16)]
    assert above == [_h(*texts[i : i + 16]) for i in (0, 16, 32)]
    for k, others in enumerate(merkle.siblings(nodes, 16)):
        first = k - k % 16
        assert others.decode() == "".join(texts[first:k] + texts[k + 1 : first + 16])


def test_a_leaf_that_is_null(spark):
    bad = spark.createDataFrame([(1, "g", None, None)], "key long, group string, leaf string, claimed string")
    with pytest.raises(Exception, match="a leaf is null"):
        merkle.manifest(bad)
