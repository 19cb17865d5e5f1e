"""URL rules and their spread over aliases."""

from __future__ import annotations

from deskmill.llm import url_filter as m

PAGES = "page_id bigint, url string, html string"


def judged(spark, *rows, **more):
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], PAGES).repartition(2)
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in m.url_filter(frame, **more).collect()}


def test_parsing_and_longest_rule(spark):
    got = judged(
        spark,
        ("http://A.Example.NET/en/x?q#f", None), ("https://example.net", None), ("https://example.net/de/", None),
        ("https://notexample.com/de/1", None), ("x://m.EXAMPLE.com/de/1.html", None), ("http://a.org/fr/", None),
        ("no scheme", None), (None, None), ("http://h?x/y", None), ("http://net/", None), ("http://a://b/c", None),
    )
    assert got == {
        0: ("a.example.net", "/en/x", "example.net/en/", "allow"),
        1: ("example.net", "", None, "allow"),
        2: ("example.net", "/de/", "net/", "block"),
        3: ("notexample.com", "/de/1", None, "allow"),
        4: ("m.example.com", "/de/1.html", "example.com/de/", "block"),
        5: ("a.org", "/fr/", "org/fr/", "allow"),
        6: ("", "", None, "allow"),
        7: ("", "", None, "allow"),
        8: ("h", "", None, "allow"),
        9: ("net", "/", "net/", "block"),
        10: ("a:", "//b/c", None, "allow"),
    }


def test_aliases(spark):
    link = '<link href="{}" rel="canonical">'.format
    refresh = "<META HTTP-EQUIV=refresh CONTENT='0; URL={}'>".format
    got = judged(
        spark,
        ("https://a.test/1", link("http://b.test/1")),  # a - b - c, and c goes to a blocked host
        ("https://b.test/1", refresh("/2")),
        ("https://b.test/2", link("//bad.net/x")),
        ("https://d.test/1", "<p>canonical</p>"),
        ("https://e.test/1", link("https://bad.net/y") + link("https://good.example.net/en/y")),  # allow comes first
        ("https://f.test/1", link("relative/folder")),
        ("https://example.net/en/own", link("https://bad.net/x")),  # has a rule of its own
    )
    verdicts = {k: v[3] for k, v in got.items()}
    # The last page allows the whole component that it shares with pages 0 to 2.
    assert verdicts == {0: "allow", 1: "allow", 2: "allow", 3: "allow", 4: "allow", 5: "allow", 6: "allow"}
    got = judged(spark, ("https://a.test/1", link("http://b.test/1")), ("https://b.test/1", refresh("/2")), ("https://b.test/2", link("//bad.net/x")))
    assert {v[3] for v in got.values()} == {"block"}


def test_known_redirects_repeats_and_clashes(spark):
    frame = spark.createDataFrame([(1, "http://a.test/x"), (1, "http://a.test/x"), (None, "http://c.test/")], "page_id bigint, url string")
    frame = frame.selectExpr("*", "repeat('long ', 100000) AS html", "'mine' AS component", "'mine' AS verdict", "'mine' AS node")
    redirects = spark.createDataFrame([("http://a.test/x", "http://www.net/z"), (None, "http://a.test/x")], "a string, b string")
    got = m.url_filter(frame, redirects=redirects).collect()
    assert sorted((r.page_id, r.verdict, r.node) for r in got if r.page_id) == [(1, "block", "mine")] * 2
    assert [r.verdict for r in got if r.page_id is None] == ["allow"]
    assert m.url_filter(frame.limit(0)).count() == 0


def test_relative_targets_and_words_of_rel(spark):
    def links(url, *hrefs, rel="'alternate canonical'", head=""):
        tags = "".join(f'<link rel={rel} href="{h}">' for h in hrefs)
        return [r.b for r in m.page_links(spark.createDataFrame([(url, head + tags)], "url string, html string")).collect()]

    base = "http://H.test/a/b/c?q=1#f"
    assert links(base, "page2.html", "../x", "?p=1&amp;r=2", "#top", "./", "../../../y/.", "/u/../v", "..", "mailto:a@b") == [
        "http://h.test/a/b/page2.html", "http://h.test/a/x", "http://h.test/a/b/c?p=1&r=2", "http://h.test/a/b/c?q=1#top",
        "http://h.test/a/b/", "http://h.test/y/", "http://h.test/v", "http://h.test/a/",
    ]
    assert links("http://h.test", "x") == ["http://h.test/x"] and links("no scheme", "x", "/y") == []
    assert links(base, "x", head='<base href="/other/">') == ["http://h.test/other/x"]
    assert links(base, "x", rel="canonical") == links(base, "x", rel='"canonical nofollow"') == ["http://h.test/a/b/x"]
    assert links(base, "x", rel="non-canonical") == []
    got = judged(spark, ("https://g.test/d/1", "<link rel='alternate canonical' href='2'>"), ("https://g.test/d/2", "<link rel=canonical href='//bad.net/'>"))
    assert {v[3] for v in got.values()} == {"block"}
