import random

from cladeworks.operators import partition


def test_roots_roll_up(spark):
    """Random fragment trees with fragments that are not partitioned, roots whose parents are further up, elsewhere or nowhere."""
    rng = random.Random(5)
    frag = {f"f{i}": (f"f{rng.randrange(i)}" if i else None, rng.random() < 0.6) for i in range(25)}
    taxa = {f"t{i}": (f"t{rng.randrange(i)}" if i else None, f"f{rng.randrange(25)}") for i in range(200)}
    want = set()
    for u, (p, f) in taxa.items():
        home = taxa[p][1] if p else None
        if not frag[f][1] or home == f:
            continue
        at = frag[f][0]
        path = []
        while at is not None:
            if frag[at][1]:
                path.append(at)
            at = frag[at][0]
        stays = path.index(home) if home in path else None
        for k, a in enumerate(path if stays is None else path[: stays + 1]):
            want.add((a, u, p, f, k != stays))
    assigned = spark.createDataFrame([(u, *v) for u, v in taxa.items()], "uid string, par_id string, fragment string")
    tree = spark.createDataFrame([(f, *v) for f, v in frag.items()], "fragment string, parent string, partitioned boolean")
    got = [tuple(r) for r in partition.accumulated_roots(assigned, tree).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert partition.accumulated_roots(assigned.limit(0), tree).collect() == []
