import random
import re

import numpy as np
import pyarrow as pa
import pytest

from cladeworks.llm import jaccard
from cladeworks.llm.jaccard import Likeness


def _sets(rows, k):
    out = []
    for _, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        out.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set())
    return out


def _brute(rows, like):
    sets = _sets(rows, like.words)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= like.percent * (len(a) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


@pytest.mark.parametrize("like", [Likeness(3, 90), Likeness(5, 80)])
def test_matches_brute_force(odd_docs, odd_rows, like):
    got = sorted([tuple(r) for r in jaccard.link_components(odd_docs, like).collect()], key=str)
    assert got == _brute(odd_rows, like)


def test_chains_and_clusters(spark, monkeypatch):
    """Near copies of near copies, two clusters that only meet through members, shared passages, hot shingles."""
    monkeypatch.setattr(jaccard, "HEAVY_FROM", 3)
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, passage = [], [rng.choice(vocabulary) for _ in range(40)]
    for c in range(6):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([30, 90, 200]))] + passage * (c % 2)
        for n in range(25):
            rows.append((1000 * c + n, " ".join(words)))
            if n % 3 == 2:  # drifts away from the first
                words = list(words)
                for _ in range(rng.randint(1, 2)):
                    words[rng.randrange(len(words))] = rng.choice(vocabulary)
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted([tuple(r) for r in jaccard.link_components(docs, Likeness(3, 90)).collect()], key=str)
    assert got == _brute(rows, Likeness(3, 90))


def test_list_pairs_agree_with_all_pairs():
    import numpy as np

    rng = np.random.default_rng(2)
    m = 1300
    n = np.sort(rng.integers(5, 60, m)).astype(np.int64)
    pos = rng.integers(0, 6, m)
    order = np.lexsort((pos, n))
    n, pos = n[order], pos[order]
    node, comp, radius = np.arange(m), rng.integers(0, 900, m), np.where(rng.random(m) < 0.2, 0.05, 0.0)
    want = set()
    for i in range(m):
        t = 0.9 - radius[i] - radius[:i]
        ok = (np.minimum(n[i] - pos[i], n[:i] - pos[:i]) >= t / (1 + t) * (n[i] + n[:i]) - 1e-9) & (n[:i] >= t * n[i] - 1e-9) & (comp[:i] != comp[i])
        want |= {(j, i) for j in np.flatnonzero(ok).tolist()}
    got = {(a, b) for x, y in jaccard._list_pairs(n, pos, node, comp, radius, 0.1) for a, b in zip(x.tolist(), y.tolist(), strict=True)}
    assert got == want


@pytest.mark.parametrize("percent", [80, 97, 99])
def test_families(spark, percent):
    """Families of four whose members are one to three changed words apart, at every share that a link may need."""
    rng, rows = random.Random(percent), []
    for f in range(30):
        words = [f"f{f}w{rng.randrange(900)}" for _ in range(rng.choice([60, 200, 400]))]
        for n in range(4):
            own = list(words)
            for _ in range(n):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
            rows.append((10 * f + n, " ".join(own)))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    like = Likeness(3, percent)
    assert sorted(tuple(r) for r in jaccard.link_components(docs, like).collect()) == sorted(_brute(rows, like))


def test_large_group_of_near_copies(spark, monkeypatch):
    """One group, of which some link and some do not; its lists are cut into several blocks and tasks."""
    for name, value in (("HEAVY_FROM", 3), ("_LIST", 40), ("_BLOCK", 16), ("_GATHER", 500), ("FAN", 8)):
        monkeypatch.setattr(jaccard, name, value)
    rng = random.Random(8)
    base, rows = [f"b{k}" for k in range(150)], []
    for n in range(260):
        own = list(base)
        for _ in range(n % 7):
            own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
        rows.append((n, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for like in (Likeness(3, 90), Likeness(5, 80)):
        assert sorted(tuple(r) for r in jaccard.link_components(docs, like).collect()) == sorted(_brute(rows, like))


def test_keep_one(odd_docs, odd_rows):
    """One row of each component: the first by (no id, id); rows without words all stay."""
    like = Likeness(5, 80)
    left = jaccard.keep_one(odd_docs, like)
    assert left.columns == odd_docs.columns
    sets, stays = _sets(odd_rows, 5), []
    near = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
    order = sorted(range(len(odd_rows)), key=lambda k: (odd_rows[k][0] is None, odd_rows[k][0] or 0))
    for k in order:  # components here are no longer than one step
        if not sets[k] or not any(sets[j] and near(sets[j], sets[k]) for j in stays):
            stays.append(k)
    assert sorted([(r["doc_id"], r["text"]) for r in left.collect()], key=str) == sorted([odd_rows[k] for k in stays], key=str)


def test_keep_one_with_clashing_names(spark):
    rows = [(1, "a b c d e f", 1, "x"), (2, "a b c d e f", 2, "y"), (3, None, 3, "z"), (3, None, 4, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key int, `__key` string").withColumnRenamed("__key", "KEY_")
    left = jaccard.keep_one(docs)
    assert left.columns == docs.columns
    assert sorted(r["key"] for r in left.collect()) == [1, 3, 4]


@pytest.mark.parametrize("texts", [["", "  ", None], ["one"]])
def test_blank_and_single_tables(spark, texts):
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    assert sorted(tuple(r) for r in jaccard.link_components(docs).collect()) == sorted(_brute(rows, Likeness()))
    assert jaccard.keep_one(docs).count() == len(rows)


def test_a_task_of_blanks_only(spark):
    rows = [(i, None if i < 6 else f"word{i % 2} and more of it all") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartitionByRange(2, "doc_id")
    assert sorted(tuple(r) for r in jaccard.link_components(docs).collect()) == sorted(_brute(rows, Likeness()))


def test_empty(no_docs):
    assert jaccard.link_components(no_docs).count() == 0
    assert jaccard.keep_one(no_docs).count() == 0


def test_long_lists_of_sets_too_large_for_bins():
    """Sets of over 40,000 shingles in one list: without bins only their sizes bound the overlap."""
    rng = np.random.default_rng(3)
    m = jaccard._SHORT + 8
    shared = rng.integers(0, 1 << 64, 40_000, np.uint64)
    sets = [np.sort(np.concatenate((shared, rng.integers(0, 1 << 64, 40 + k, np.uint64)))) for k in range(m)]
    small = np.sort(shared[:200])
    assert all(jaccard._bins(own) is None for own in sets) and jaccard._bins(small) is not None
    own = [*sets, small]
    rows = sorted(((len(s), k) for k, s in enumerate(own)))
    batch = pa.RecordBatch.from_pydict(
        {
            "token": [7] * len(rows), "n": [n for n, _ in rows], "pos": [0] * len(rows), "node": [k for _, k in rows], "comp": [k for _, k in rows],
            "radius": [0.0] * len(rows), "cell": [0] * len(rows), "block": [0] * len(rows), "own": [True] * len(rows), "bins": pa.array([jaccard._bins(own[k]) for _, k in rows], pa.binary()),
        }
    )
    found = {(a, b) for out in jaccard._candidates(iter([batch]), 0.1, True) for a, b in zip(out["a"].to_pylist(), out["b"].to_pylist(), strict=True)}
    assert found == {(a, b) for b in range(m) for a in range(b)}


def test_links_of_very_long_texts(spark, monkeypatch):
    """Texts of some 41,000 words that meet in lists of more than _SHORT rows, against brute force."""
    monkeypatch.setattr(jaccard, "_SHORT", 2)
    rng = random.Random(11)
    base = [rng.choice("abcdefgh") + str(rng.randrange(10**7)) for _ in range(41_000)]
    rows = []
    for c in range(9):  # each keeps all but a tenth or a hundredth of the words
        words = list(base)
        for i in range(0, len(words), 30 if c % 3 else 300):
            words[(i * 7 + 13 * c) % len(words)] = f"own{c}.{i}"
        rows.append((100 - c, " ".join(words)))
    rows.append((7, "other " * 50))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    like = Likeness(3, 80)
    assert sorted(map(tuple, jaccard.link_components(docs, like).collect()), key=str) == _brute(rows, like)


def test_groups_are_led_by_their_middle(spark, monkeypatch):
    """Groups around a text each: it leads its copies whatever the names of the sets, so they are linked through it and few pairs are left to list."""
    calls, whole, seen, listed = [], jaccard._Join.verified, [], jaccard._Join.possible
    monkeypatch.setattr(jaccard._Join, "verified", lambda self, pairs, absorb=-1.0: (calls.append(pairs.select("a").collect()), whole(self, pairs, absorb))[1])
    monkeypatch.setattr(jaccard._Join, "possible", lambda self, pairs, radii=None: (found := listed(self, pairs, radii), seen.append(found.count()))[0])
    rng, rows, middle = random.Random(4), [], set()
    for g in range(4):
        base = [f"g{g}w{k}" for k in range(150)]
        middle |= {jaccard._node(own) for own in jaccard.shingle_sets([" ".join(base)], 3)}
        for n in range(60):
            own = list(base)
            for _ in range(0 if n == 30 else 1 + n % 2 if n % 5 else 4):
                own[rng.randrange(len(own))] = f"x{rng.randrange(10**9)}"
            rows.append((1000 * g + n, " ".join(own)))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    like = Likeness(3, 90)
    assert sorted(tuple(r) for r in jaccard.link_components(docs, like).collect()) == sorted(_brute(rows, like))
    led = [r["a"] in middle for r in calls[0]]
    assert len(led) > 50 and sum(led) > 0.9 * len(led)
    assert sum(seen) < 4 * len(rows), seen
