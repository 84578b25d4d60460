import hashlib
from collections import Counter

import numpy as np

from cladeworks.llm import simhash


def _bits(a: bytes, b: bytes) -> int:
    return int(np.unpackbits(np.frombuffer(a, np.uint8) ^ np.frombuffer(b, np.uint8)).sum())


def test_fingerprints(odd_docs, odd_rows, no_docs):
    out = simhash.fingerprints(odd_docs, buckets=4).collect()
    rows = sorted(((i, t or "") for i, t in odd_rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        half = len(t) // 2
        new = t[: len(t) - half] + after[:half]
        a, b, c = (simhash.fingerprint(x) for x in (t, new, after))
        want.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), a.tobytes().hex(), b.tobytes().hex(), round(simhash.likeness(a, b), 9), round(simhash.likeness(a, c), 9)))
    assert Counter((r[0], r[1], r[2], r[3], r[4], round(r[5], 9), round(r[6], 9)) for r in out) == Counter(want)
    assert simhash.fingerprints(no_docs).count() == 0


def test_one_document_follows_itself(odd_docs):
    r = simhash.fingerprints(odd_docs.filter("doc_id = 5")).collect()
    assert len(r) == 1 and r[0]["near_next"] == 1.0


def test_likeness_follows_content():
    words = [f"w{i}" for i in range(300)]
    a = simhash.fingerprint(" ".join(words))
    assert simhash.likeness(a, simhash.fingerprint(" ".join(words[:-6]))) > 0.9
    assert simhash.likeness(a, simhash.fingerprint(" ".join(f"v{i}" for i in range(300)))) < 0.4


def test_within_radius(spark):
    rng = np.random.default_rng(3)
    prints = [rng.bytes(16) for _ in range(40)]
    for p in prints[:20]:
        bits = np.unpackbits(np.frombuffer(p, np.uint8)).copy()
        bits[rng.choice(128, rng.integers(1, 9), replace=False)] ^= 1
        prints.append(np.packbits(bits).tobytes())
    prints += prints[:3]
    found = simhash.within_radius(spark.createDataFrame([(p.hex(),) for p in prints] + [(None,)], "fingerprint string"), radius=6).collect()
    own = sorted(set(p.hex() for p in prints))
    want = {(a, b, d) for i, a in enumerate(own) for b in own[i + 1 :] if (d := _bits(bytes.fromhex(a), bytes.fromhex(b))) <= 6}
    assert {(r["a"], r["b"], r["distance"]) for r in found} == want and len(want) > 5
