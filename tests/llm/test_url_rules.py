import re

from cladeworks.llm import url_rules
from cladeworks.llm.queries import URL_RULES

URLS = [
    "http://www.example.com/en/1", "https://example.com/en/", "http://a.example.com/en/x?y#z", "http://EXAMPLE.com/fr/", "http://com/", "http://com",
    "http://x.net/es/1", "http://net/fr/", "http://nett/es/", "http://xcom/", "ftp://www.example.com/en", "http://a.www.example.com/en/q", None, "", "no scheme",
    "http://", "://com/a", "x://y://com/", "http://example.com:80/en/", "http://com./", "http://q.com?x=/en/", "http://q.com#/", "http://É.com/x", "http://a.com/\nb",
] + [f"http://h{i % 3}.net/{'es' if i % 2 else 'de'}/{i}" for i in range(30)]


def _judge(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fits, key=lambda r: len(r[0]), default=(None, "allow"))
    return host, path, rule, verdict


def test_matches_brute_force(spark):
    pages = spark.createDataFrame([(i if i != 4 else None, u, "x") for i, u in enumerate([*URLS, URLS[0]])], "page_id long, url string, host string").repartition(3)
    out = url_rules.judge(pages, url_rules.rules_frame(spark, URL_RULES), buckets=4, sample_rows=20).collect()
    key = lambda r: tuple("" if x is None else str(x) for x in r)
    got = sorted([tuple(r) for r in out], key=key)
    want = sorted([(i if i != 4 else None, *_judge(u, URL_RULES)) for i, u in enumerate([*URLS, URLS[0]])], key=key)
    assert got == want


def test_many_nested_rules(spark):
    hosts = ["a", "b.a", "c.b.a", "d.a", "ab", "b.ab"]
    rules = [("block" if (i + j) % 2 else "allow", h, p) for i, h in enumerate(hosts) for j, p in enumerate(("/", "/x/", "/x/y/"))]
    urls = [f"http://{s}{h}{p}" for h in [*hosts, "z"] for s in ("", "q.") for p in ("", "/", "/x/", "/x/y/z")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    for r in url_rules.judge(pages, url_rules.rules_frame(spark, rules), buckets=5).collect():
        assert tuple(r)[1:] == _judge(urls[r["page_id"]], rules)


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_rules.judge(pages, url_rules.rules_frame(spark, URL_RULES)).count() == 0
    one = spark.createDataFrame([(1, "http://com/")], "page_id long, url string")
    assert url_rules.judge(one, url_rules.rules_frame(spark, URL_RULES).limit(0)).first()["verdict"] == "allow"
