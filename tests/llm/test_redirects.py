import random

import pytest

from ledgerwatch.llm import components as c
from ledgerwatch.llm import redirects as r

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/")]


def link(href):
    return f"<html><head><LINK href='{href}' REL=\"Canonical\"></head></html>"


def test_components_equal_union_find(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)]
    edges += [(i, i + 1) for i in range(1000, 1200)] + [(5000, 5000 + i) for i in range(300)]
    edges += [(7, 7), (9000, 9000), (None, 3), (4, None), edges[0]]
    got = {x.node: x.component for x in c.components(
        spark.createDataFrame(edges, "u long, v long")).collect()}
    root = {}

    def find(n):
        root.setdefault(n, n)
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        if a is not None and b is not None:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    assert got == {n: find(n) for n in root}
    assert c.components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_decisions_travel_over_aliases(spark):
    rows = [
        (1, "http://A.example.ORG/es/x?q#f", None), (2, "https://a.net/1", link("http://a.example.org/es/x?q")),
        (3, "https://b.net/", link("//a.net/1")),  # scheme of the page
        (4, "http://x.org/free", link("https://b.net/")),  # explicit allow
        (5, "https://c.net/a/b", '<meta http-equiv=refresh content="0; URL=d/e">'),
        (6, "https://c.net/a/d/e", link("https://m.com/de/y?a=1&amp;b=2")),
        (7, "https://other.net/", link("/self")), (8, "https://m.com/fr/de/", None),
        (9, None, link("http://m.com/de/")), (10, "no scheme", link("http://m.com/de/")),
        (11, "http://example.org/en/12", None), (12, "http://notexample.org/en/12", None),
        (13, "http://q.com", None), (2, "https://a.net/1", None), (None, "https://b.net/#top", ""),
        (14, "http://h.com?u=http://example.org/es/", None), (15, "https://b.net/x", "<link rel=next href=/y>")]
    pages = spark.createDataFrame([(*x, "clash") for x in rows],
                                  "page_id long, url string, html string, node string")
    got = {(x.page_id, i): x for i, x in enumerate(sorted(
        r.judge(pages, RULES).collect(), key=lambda x: (x.page_id or 0, x.rule or "")))}
    verdict = {}
    for (page, _), x in got.items():
        verdict.setdefault(page, []).append((x.rule, x.verdict))
    assert len(got) == len(rows)
    assert verdict[1] == [("example.org/es/", "block")] and verdict[2] == [(None, "block")] * 2
    assert verdict[3] == [(None, "block")] and verdict[4] == [("org/", "allow")]
    assert verdict[5] == verdict[6] == [(None, "block")] and verdict[7] == [(None, "allow")]
    assert verdict[8] == [("com/fr/", "allow")]
    assert verdict[9] == verdict[10] == [(None, "allow")]
    assert verdict[11] == [("example.org/en/1", "block")] and verdict[12] == [("org/", "allow")]
    assert verdict[13] == verdict[14] == verdict[15] == [(None, "allow")]
    assert verdict[None] == [(None, "block")]
    hosts = {x.page_id: (x.host, x.path) for x in got.values()}
    assert hosts[1] == ("a.example.org", "/es/x") and hosts[9] == hosts[10] == ("", "")
    assert hosts[14] == ("h.com", "")


def test_redirect_table_and_tie(spark):
    pages = spark.createDataFrame([(1, "http://a.net/", None)], "page_id long, url string, html string")
    table = spark.createDataFrame([("http://a.net/", "http://b.net/"), ("http://b.net/", "http://z.com/de/")],
                                  "source string, target string")
    assert r.judge(pages, RULES, table).first().verdict == "block"
    both = [("block", "net/"), ("allow", "net/")]
    assert r.judge(pages, both).first().verdict == "allow"
    assert r.judge(pages, []).first().verdict == "allow"
    assert r.judge(pages.limit(0), RULES).count() == 0


@pytest.mark.parametrize("n", [300])
def test_hub(spark, n):
    rows = [(i, f"http://s{i}.net/", link("http://hub.com/de/")) for i in range(n)]
    got = r.judge(spark.createDataFrame(rows, "page_id long, url string, html string"), RULES)
    assert {x.verdict for x in got.collect()} == {"block"}
