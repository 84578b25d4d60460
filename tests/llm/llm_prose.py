"""Made-up texts for the tests."""

WORDS = "the of and river stone light over under bridge water north south east west small large green old new quiet".split()


def prose(seed: int, n: int) -> str:
    out, x = [], seed * 2654435761 % 4294967291 + 1
    for _ in range(n):
        x = x * 48271 % 2147483647
        out.append(WORDS[x % len(WORDS)] + ("" if x % 3 else WORDS[x // 7 % len(WORDS)]))
    return " ".join(out)
