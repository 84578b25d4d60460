import random

import pytest

from cladeworks.sources import readers


def _parse(text):
    """A plain parser: (uid, par, label) in preorder."""
    at, nodes = 0, []
    stack, kids, last = [], [[]], None
    while at < len(text):
        c = text[at]
        if c == "(":
            kids.append([])
        elif c == ")":
            stack.append(kids.pop())
            last = "close"
        elif c == "'":
            end = at + 1
            while text[end] != "'" or text[end + 1 : end + 2] == "'":
                end += 2 if text[end] == "'" else 1
            label, at = text[at + 1 : end].replace("''", "'"), end
            kids[-1].append((label, stack.pop() if last == "close" else []))
            last = None
        elif c not in ",; \n":
            end = at
            while text[end] not in "(),;:[":
                end += 1
            label, at = text[at:end].strip(), end - 1
            kids[-1].append((label, stack.pop() if last == "close" else []))
            last = None
            if text[at + 1] == ":":
                while text[at + 1] not in "(),;":
                    at += 1
        at += 1
    walk = [(kids[0][0], None)]
    while walk:
        (label, below), par = walk.pop()
        uid = len(nodes)
        nodes.append((uid, par, label))
        walk += [(k, uid) for k in reversed(below)]
    return nodes


def _text(n, seed, wide):
    rng = random.Random(seed)
    par = [None] + [rng.randrange(max(0, i - wide), i) for i in range(1, n)]
    kids = {}
    for i, p in enumerate(par[1:], 1):
        kids.setdefault(p, []).append(i)
    out, work = [], [(0, False)]
    label = lambda i: rng.choice([f"t{i}", f"genus=G{i}", f"'it''s, ({i})'", f"two words {i}", f"'q {i}'", f"t{i}:0.{i}"])
    while work:
        x = work.pop()
        if isinstance(x, str):
            out.append(x)
        elif x[1] or x[0] not in kids:
            out.append(label(x[0]))
        else:
            inner = [y for k in kids[x[0]] for y in (",", (k, False))][1:]
            work += [(x[0], True), ")", *reversed(inner), "("]
    return "".join(out) + ";\n"


def _want(text):
    out = []
    for uid, par, label in _parse(text):
        rank, name = [x.strip() for x in label.split("=")] if "=" in label else ("no rank", label)
        out.append((str(uid), None if par is None else str(par), name, rank))
    return sorted(out, key=str)


def _got(out):
    return sorted(((r["uid"], r["par_id"], r["name"], r["rank"]) for r in out.collect()), key=str)


def _read(spark, path, size="128m"):
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        return readers.newick(spark, str(path))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_small_trees(spark, tmp_path):
    for k, text in enumerate(("((a,'b c')genus=X,species=d)root;", "alone;", "(a [x y]:1.5 ,\n b)'r, (s)';", "(((d)c)b)a;", "('x,y','p,q,r','''')z;")):
        (tmp_path / f"{k}.tre").write_text(text)
        want = _want(text) if "[" not in text else [("0", None, "r, (s)", "no rank"), ("1", "0", "a", "no rank"), ("2", "0", "b", "no rank")]
        assert _got(_read(spark, tmp_path / f"{k}.tre")) == want
    every = _read(spark, tmp_path)  # a file, a tree
    assert every.select("tree").distinct().count() == 5 and every.filter("par_id is null").count() == 5


@pytest.mark.parametrize(("n", "wide"), [(100_000, 50_000), (3000, 2)])
def test_large_trees_in_byte_ranges(spark, tmp_path, n, wide):
    text = _text(n, n, wide)
    (tmp_path / "t.tre").write_text(text)
    out = _read(spark, tmp_path / "t.tre", "200k" if n > 5000 else "4k")
    assert _got(out) == _want(text)
    plan = out._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan and len(plan) < 60_000


@pytest.mark.parametrize("text", ["(a,)r;", "(a,b);", "((a)b;", "(a)b)c;", "(a b,c d)(e)f;"])
def test_broken_trees(spark, tmp_path, text):
    (tmp_path / "t.tre").write_text(text)
    with pytest.raises(Exception, match="without a label|do not match"):
        readers.newick(spark, str(tmp_path / "t.tre")).collect()
