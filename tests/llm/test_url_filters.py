from lavra.llm.url_filters import judge_urls

PAGES = "page_id long, url string, html string, host string"


def judged(spark, rows, **kw):
    pages = spark.createDataFrame([(i, u, h, "extra") for i, (u, h) in enumerate(rows)], PAGES)
    return {r.page_id: r for r in judge_urls(pages, **kw).collect()}


def test_rules_hosts_and_paths(spark):
    out = judged(spark, [
        ("http://A.Example.NET/en/x?q#f", None), ("https://example.net/fr/", ""), ("http://notexample.net.org/fr/a", None),
        ("http://example.com/de/", None), ("http://sub.example.com/de", None), (None, None), ("no scheme", "x"),
        ("http://x.net", None), ("ftp://net/", None), ("http://é.org/fr/?a#b", None)])
    want = {0: ("a.example.net", "/en/x", "example.net/en/", "allow"), 1: ("example.net", "/fr/", "net/", "block"),
            2: ("notexample.net.org", "/fr/a", "org/fr/", "allow"), 3: ("example.com", "/de/", "example.com/de/", "block"),
            4: ("sub.example.com", "/de", None, "allow"), 5: ("", "", None, "allow"), 6: ("", "", None, "allow"),
            7: ("x.net", "", None, "allow"), 8: ("net", "/", "net/", "block"), 9: ("é.org", "/fr/", "org/fr/", "allow")}
    assert {k: (r.host, r.path, r.rule, r.verdict) for k, r in out.items()} == want


def test_blocks_reach_aliases_and_allow_takes_precedence(spark):
    link = '<html><link href="{}" rel="canonical"></html>'.format
    out = judged(spark, [
        ("http://a.com/1", link("http://bad.net/p")),            # canonical to a blocked, uncrawled page
        ("http://b.com/1", link("//a.com/1")),                   # chain
        ("http://c.com/1", "<META HTTP-EQUIV=refresh CONTENT='0; URL=http://b.com/1/'>"),
        ("http://d.com/x/y", link("../z")),                      # relative, leads nowhere known
        ("http://e.com/1", link("http://bad.net/q")), ("http://f.com/1", link("http://e.com/1")),
        ("http://g.example.net/en/1", link("http://f.com/1")),   # an allowed member
        ("https://a.com/1/?utm_source=x#top", None),             # another spelling of page 0
        ("http://bad.net/q", None)])
    got = {k: (r.verdict, r.via) for k, r in out.items()}
    assert got == {0: ("block", "alias"), 1: ("block", "alias"), 2: ("block", "alias"), 3: ("allow", "default"),
                   4: ("allow", "alias"), 5: ("allow", "alias"), 6: ("allow", "rule"), 7: ("block", "alias"),
                   8: ("block", "rule")}


def test_redirect_table_and_empty(spark):
    redirects = spark.createDataFrame([("http://h.com/a", "http://z.net/"), (None, "http://z.net/")],
                                      "from_url string, to_url string")
    out = judged(spark, [("http://h.com/a", None), ("http://h.com/a", None)], redirects=redirects)
    assert [r.verdict for r in out.values()] == ["block", "block"]
    assert judge_urls(spark.createDataFrame([], PAGES)).count() == 0
