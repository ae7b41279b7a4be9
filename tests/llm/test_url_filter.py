"""Redirect equivalence against rules and classes worked out by hand."""

import random

import duckdb
from tideglass.llm import catalog, components, url_filter
from tideglass.llm.catalog import RULES
from tideglass.llm.common import read_table

from compare import connect, difference

PAGES = [
    (1, "https://a.net/x", '<LINK href="http://B.example.org/es/1" rel=canonical>'),
    (2, "http://c.net/y#q", '<meta http-equiv="refresh" content="0; url=https://a.net/x?z=1#f">'),
    (3, "http://a.net/x?z=1", '<link rel="canonical" href="/x">'),
    (4, None, None),
    (5, "nourl", "<link rel=canonical href='/q'>"),
    (6, "http://M.example.org/es/3?x=://", ""),
    (7, "http://org/", "x"),
    (8, "http://neworg/", ""),
    (9, "https://q.net/u/v", '<link rel="canonical" href="w"><link rel=canonical href="http://z.com/fr/1">'),
    (10, "http://q.net/u/w", None),
    (11, "http://q.net/u/v", '<link rel="canonical" href="http://z.com/de/1">'),
    (12, "http://z.com/de/1", ""),
    (12, "http://z.com/de/1", ""),
    (13, "HTTP://x.ORG", ""),
    (14, "http://example.org/en/12", '<link rel="alternate" href="http://a.net/x">'),
    (None, "http://a.com/fr/", ""),
]
EXPECTED = {
    1: (None, "block"), 2: (None, "block"), 3: (None, "block"), 4: (None, "allow"), 5: (None, "allow"),
    6: ("example.org/es/", "block"), 7: ("org/", "allow"), 8: (None, "allow"), 9: (None, "allow"),
    10: (None, "allow"), 11: (None, "allow"), 12: ("com/de/", "block"), 13: (None, "allow"),
    14: ("example.org/en/1", "block"), None: ("com/fr/", "allow"),
}


def test_verdicts(spark):
    pages = spark.createDataFrame(
        [(*p, "x", "y", "z") for p in PAGES],
        "page_id long, url string, html string, host string, node string, verdict string",
    )
    found = url_filter.judge(pages, RULES).collect()
    assert len(found) == len(PAGES)
    for row in found:
        assert (row["rule"], row["verdict"]) == EXPECTED[row["page_id"]], row
    alias = {row["page_id"]: row["alias"] for row in found}
    assert alias[1] == alias[2] == alias[3] and alias[9] == alias[10] == alias[11] == alias[12]
    assert alias[4] is alias[5] is alias[6] is None
    hosts = {row["page_id"]: (row["host"], row["path"]) for row in found}
    assert hosts[13] == ("x.org", "") and hosts[4] == ("", "") and hosts[6] == ("m.example.org", "/es/3")
    assert url_filter.judge(pages.where("false"), RULES).collect() == []
    connection = duckdb.connect()
    connection.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    connection.executemany("INSERT INTO pages VALUES (?, ?, ?)", PAGES)
    sql = catalog.SQL["op4_redirect_equivalence"]
    assert difference(url_filter.judge(pages, RULES), connection, sql) is None


def test_query_equals_sql(spark, sf_dir):
    name = "op4_redirect_equivalence"
    assert difference(catalog.QUERIES[name](spark, sf_dir), connect(sf_dir), catalog.SQL[name]) is None


def test_given_redirects(spark):
    pages = spark.createDataFrame([(1, "http://a.net/", None)], "page_id long, url string, html string")
    redirects = spark.createDataFrame([("http://a.net/", "http://x.com/de/1"), (None, "http://a.net/")], "source string, target string")
    row = url_filter.judge(pages, RULES, redirects).first()
    assert (row["rule"], row["verdict"]) == (None, "block")


def test_table_by_rules(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages")
    urls = {r["page_id"]: r["url"] for r in pages.select("page_id", "url").collect()}
    for row in url_filter.judge(pages, RULES).collect():
        rest = urls[row["page_id"]].partition("://")[2]
        host = rest.split("/")[0].split("?")[0].split("#")[0].lower()
        path = rest[len(host) :].split("?")[0].split("#")[0]
        fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.name), default=None)
        assert (row["host"], row["path"], row["rule"]) == (host, path, best and best.name)
        if best:
            assert row["verdict"] == best.verdict


def test_components_of_chains_stars_and_loops(spark):
    draw = random.Random(4)
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 200 + i) for i in range(60)]
    links += [(draw.randint(300, 360), draw.randint(300, 360)) for _ in range(40)] + [(5, 5), (7, 6)]
    top = {n: n for link in links for n in link}

    def find(n):
        while top[n] != n:
            n = top[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    expected = {n: find(n) for link in links if link[0] != link[1] for n in link}
    frame = spark.createDataFrame([*links, (None, 3)], "a long, b long")
    found = {r["node"]: r["component"] for r in components.components(frame).collect()}
    assert found == expected
