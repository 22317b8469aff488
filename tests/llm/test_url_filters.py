from pyspark.sql import functions as F

from tillwise.llm import url_filters

PAGES = [
    (1, "http://www.Example.com/en/a?x=1#f", None, "www.example.com", "/en/a", "www.example.com/en/", "allow"),
    (2, "https://example.com/en/b", "", "example.com", "/en/b", "example.com/en/", "block"),
    (3, "http://a.example.com/EN/", None, "a.example.com", "/EN/", "com/", "allow"),
    (4, "http://x.net/es/1", None, "x.net", "/es/1", "net/es/", "block"),
    (5, "http://alias.org/p", '<LINK href=\'https://x.net/es/1#top\' rel="canonical">', "alias.org", "/p", None, "block"),
    (6, "http://far.org", '<meta http-equiv="refresh" content="0; URL=http://alias.org/p">', "far.org", "", None, "block"),
    (7, "http://ok.com/z", '<link rel=canonical href="http://x.net/es/1">', "ok.com", "/z", "com/", "allow"),
    (8, "http://plain.org/d/e?q", '<link rel="stylesheet" href="http://x.net/es/1"><link rel="canonical" href="../f">', "plain.org", "/d/e", None, "allow"),
    (9, None, '<link rel="canonical" href="http://x.net/es/1">', "", "", None, "allow"),
    (10, "no scheme", None, "", "", None, "allow"),
    (11, "https://alias.org/p#again", None, "alias.org", "/p", None, "block"),
    (12, "x://com/", None, "com", "/", "com/", "allow"),
    (13, "http://moved.org/", None, "moved.org", "/", None, "block"),
    (None, "http://y.net/fr/", None, "y.net", "/fr/", "net/fr/", "block"),
    (5, "http://ÄB.NET/es", None, "Äb.net", "/es", None, "allow"),
]


def test_rules_and_aliases(spark):
    pages = spark.createDataFrame([r[:3] for r in PAGES], "page_id long, url string, html string")
    pages = pages.withColumns({c: F.lit(1) for c in ("host", "key", "own", "blocked", "node")})
    redirects = spark.createDataFrame([("http://moved.org/", "http://far.org"), (None, "http://x.net/es/1")], "source string, target string")
    got = url_filters.judge_urls(pages, redirects).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((r[0], *r[3:]) for r in PAGES), key=str)


def test_longest_rule_wins_and_empty(spark):
    rules = [("a.org", "/x", "block"), ("org", "/xy/zz", "allow")]
    pages = spark.createDataFrame([(1, "http://b.a.org/xy/zz", None), (2, "http://b.a.org/xy", None)], "page_id long, url string, html string")
    assert {r["page_id"]: r["verdict"] for r in url_filters.judge_urls(pages, None, rules).collect()} == {1: "allow", 2: "block"}
    assert url_filters.judge_urls(pages.limit(0)).count() == 0
