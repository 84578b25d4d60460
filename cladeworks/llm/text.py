"""Word and hash helpers shared by the text operators (numpy, no Spark)."""

from __future__ import annotations

import numpy as np
import xxhash

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)

#: Bytes of the classes \x00-\x2F \x3A-\x40 \x5B-\x60 \x7B-\x7F become a space, A-Z become a-z.
ALNUM_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 0x20
    for c in range(256)
)


def space_words(text: str | None) -> list[bytes]:
    """A-Z lower-cased, split at [\\x20\\x09-\\x0D]+ (exactly what bytes.split() takes as white space)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def alnum_words(text: str | None) -> list[bytes]:
    """A-Z lower-cased runs of [0-9a-z] and everything from U+0080 on."""
    return text.encode("utf-8", "surrogatepass").translate(ALNUM_TABLE).split() if text else []


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _S33)) * _M1
    h = (h ^ (h >> _S33)) * _M2
    return h ^ (h >> _S33)


def word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w) for w in words), np.uint64, len(words))


#: White space [\\x20\\x09-\\x0D] becomes a space, A-Z become a-z.
SPACE_TABLE = bytes(0x20 if 9 <= c <= 13 else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_BASE = 0x9E3779B97F4A7C15
_CHUNK = 1 << 19  # bytes hashed at once, unless one text is longer
_powers = {"n": 0}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers["n"] < n:
        size = max(n, _CHUNK)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            _powers[name] = np.concatenate(([np.uint64(1)], np.cumprod(np.full(size - 1, base, np.uint64), dtype=np.uint64)))
        _powers["n"] = size
    return _powers["up"], _powers["down"]


def hashed_words(texts: list[str | None], table: bytes = SPACE_TABLE):
    """Yields for each text the 64-bit hashes of its words (a rolling polynomial over the bytes, many texts at once)."""
    for hashes, bounds in hashed_chunks(texts, table):
        for a, b in zip(bounds, bounds[1:], strict=False):
            yield hashes[a:b]


def hashed_chunks(texts: list[str | None], table: bytes = SPACE_TABLE):
    """Yields (hashes of the words of several texts, where each text's words start and the last ones end)."""
    held, size = [], 0
    for text in texts:
        raw = text.encode("utf-8", "surrogatepass") if text else b""
        if held and size + len(raw) > _CHUNK:
            yield _hashed(held, table)
            held, size = [], 0
        held.append(raw)
        size += len(raw) + 1
    if held:
        yield _hashed(held, table)


def _hashed(held: list[bytes], table: bytes) -> tuple[np.ndarray, list[int]]:
    own = np.frombuffer((b" ".join(held) + b" ").translate(table), np.uint8)
    up, down = _tables(len(own) + 1)
    edges = np.diff((own != 0x20).astype(np.int8), prepend=np.int8(0))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    sums = np.zeros(len(own) + 1, np.uint64)
    np.cumsum((own + np.uint64(1)) * up[: len(own)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    firsts = np.cumsum([0, *(len(x) + 1 for x in held)])
    return hashes, np.searchsorted(starts, firsts).tolist()


def distinct(h: np.ndarray) -> np.ndarray:
    """Sorted without repeats (what np.unique gives, with less overhead for short arrays)."""
    h = np.sort(h)
    return h[np.concatenate(([True], h[1:] != h[:-1]))] if len(h) else h


def shingle_sets(texts: list[str | None], k: int):
    """Yields each text's sorted distinct k-word shingle hashes (see shingle_hashes)."""
    for hashes, bounds in hashed_chunks(texts):
        n = len(hashes) - k + 1
        acc = shingle_hashes(hashes, k) if n > 0 else hashes[:0]
        for a, b in zip(bounds, bounds[1:], strict=False):
            yield distinct(acc[a : b - k + 1] if b - a >= k else shingle_hashes(hashes[a:b], k))


def shingle_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of the k-word windows in order; with fewer words, one hash of the whole sequence."""
    n = len(h)
    if n == 0:
        return h
    m = min(k, n)
    acc = h[: n - m + 1].copy()
    for j in range(1, m):
        acc = mix(acc) + h[j : n - m + 1 + j]
    return mix(acc + np.uint64(m))
