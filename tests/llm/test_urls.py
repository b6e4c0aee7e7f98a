"""URL rules against a plain loop."""

import random

import pytest

from ledgerloom.llm import urls
from ledgerloom.llm.urls import Rule


def brute(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.text), len(r.host)), default=None)
    return host, path, best.text if best else None, best.verdict if best else "allow"


URLS = [
    None, "", "no scheme", "http://", "https://a.net", "https://a.net/", "https://A.NET/x?y#z", "http://net/en/",
    "https://Example.NET/en/1", "https://x.example.net/en", "https://notexample.net/en/", "http://b.example.com/de/?q",
    "http://example.com/DE/", "ftp://q.org/fr/1#t", "x://y://org/fr/", "http://\u00c9X.org/fr/", "http://a.net?x=/en/", "http://.net/",
    "http://org/fr/\n2",
]


@pytest.mark.parametrize("limit", [urls.MAX_INDEX_BYTES, 0])
def test_rules(spark, limit):
    rows = [(i, u, "x") for i, u in enumerate(URLS)] + [(None, URLS[5], None), (5, URLS[5], None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, rule string")
    got = urls.judge(pages, urls.RULES, max_index_bytes=limit).collect()
    expected = sorted((str(i), *map(str, brute(u, urls.RULES))) for i, u, _ in rows)
    assert sorted(tuple(map(str, r)) for r in got) == expected


@pytest.mark.parametrize("limit", [urls.MAX_INDEX_BYTES, 0])
def test_last_of_conflicting_rules_counts(spark, limit):
    rules = [Rule("a.net", "/", "block"), Rule("a.net", "/", "allow"), Rule("b.net", "/", "allow"), Rule("b.net", "/", "block")]
    pages = spark.createDataFrame([(1, "http://a.net/x"), (2, "http://b.net/x")], "page_id int, url string")
    got = urls.judge(pages, rules, max_index_bytes=limit).collect()
    assert {r.page_id: (r.rule, r.verdict) for r in got} == {1: ("a.net/", "allow"), 2: ("b.net/", "block")}


def test_random_rules_and_collisions(monkeypatch):
    """Digests of two bits only, so that whole texts must decide."""
    monkeypatch.setattr(urls, "_digest", lambda text: sum(text) % 4)
    random.seed(3)
    host = lambda: ".".join(random.choice("abc") for _ in range(random.randint(1, 3)))
    path = lambda: "/" + "".join(random.choice("xy/") for _ in range(random.randint(0, 4)))
    rules = {r.text: r for r in (Rule(host(), path(), random.choice(["allow", "block"])) for _ in range(60))}
    rules = list(rules.values())
    index = urls.RuleIndex(urls.RuleIndex.build(rules, ["allow", "block"]))
    probes = [(host(), path()) for _ in range(300)]
    best = index.best([p[0] for p in probes], [p[1] for p in probes])
    for (h, p), place in zip(probes, best):
        expected = brute(f"x://{h}{p}", rules)[2]
        found = index.text(place).decode() if place >= 0 else None
        assert found == expected


@pytest.mark.parametrize("as_table", [False, True])
@pytest.mark.parametrize("limit", [urls.MAX_INDEX_BYTES, 0])
def test_one_length_in_both_ways(spark, limit, as_table):
    """Code points count, not bytes; of rules as long the longer host; rules that fit no URL are none."""
    rules = [
        Rule("xx", "/abc", "block"), Rule("\u00e9\u00e9.xx", "/", "allow"), Rule("\u00e9.xx", "/ab", "block"),
        Rule("b.a.net", "/", "allow"), Rule("a.net", "/xy", "block"), Rule("c.a.net", "", "block"), Rule("net", "/\u4f60", "allow"),
        Rule("a", "net/q", "block"), Rule("q/z", "", "block"), Rule("a.net", "/q/", "allow"), Rule("a.net", "/q/", "block"),
    ]
    probes = ["http://\u00e9\u00e9.xx/abc", "http://\u00e9.xx/abc", "http://b.a.net/xyz", "http://c.a.net/xy", "http://anet/q", "http://q/z",
              "http://a.net/\u4f60\u597d", "http://a.net/q/1", "http://net/\u4f60", "http://c.a.net", "http://x" + "." * 500 + "a.net/" + "x" * 50_000]
    pages = spark.createDataFrame(list(enumerate(probes)), "page_id int, url string")
    given = rules
    if as_table:
        numbered = [(i, r.host, r.path, r.verdict) for i, r in enumerate(rules)]
        given = spark.createDataFrame(numbered, "number int, host string, path string, verdict string").repartition(3)
    got = {r.page_id: tuple(r)[1:] for r in urls.judge(pages, given, max_index_bytes=limit).collect()}
    last = list({r.text: r for r in rules}.values())
    assert got == {i: brute(u, last) for i, u in enumerate(probes)}


def test_empty(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id bigint, url string")
    assert urls.judge(pages, []).first().verdict == "allow"
    assert urls.judge(pages.limit(0), urls.RULES).count() == 0
