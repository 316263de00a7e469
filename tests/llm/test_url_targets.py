from urllib.parse import urljoin

from pyspark.sql import functions as F

from textlab.llm import urls


def canonical(target):
    return f'<link rel="canonical" href="{target}">'


def test_targets_that_are_no_rows(spark):
    rows = [
        ("http://z.net/p", canonical("http://example.org/es/9"), "block"),
        ("http://z.net/s", '<meta http-equiv="refresh" content="0; url=http://y.com/de/5">', "block"),
        ("http://z.net/t", canonical("//y.com/de/7"), "block"),
        ("http://q.com/x", canonical("/de/5"), "block"),
        ("http://r.com/a/b", canonical("../de/1"), "block"),
        ("http://r.net/a/b", '<BASE HREF="http://r.com/x/">' + canonical("../de/1"), "block"),
        ("http://u.net/p", '<LINK REL="CANONICAL" HREF="http://y.com/de/8">', "block"),
        ("http://w.net/a", canonical("http://w.net/b?x=1&amp;y=2"), "block"),
        ("http://w.net/b?x=1&y=2", canonical("http:&#x2F;&#47;y.com/de/9"), "block"),
        ("http://k.net/a", canonical("http://a.org/x"), "allow"),
        ("http://k.net/b", canonical("http://n.net/x?u=http://y.com/de/5"), "default"),
        ("http://k.net/c", canonical("/x?u=http://y.com/de/5"), "default"),
        ("http://k.net/d", canonical("mailto:a@y.com/de/5"), "default"),
        ("nohost", canonical("http://y.com/de/5"), "default")]
    pages = spark.createDataFrame([(i, u, h) for i, (u, h, _) in enumerate(rows)], "page_id long, url string, html string")
    got = {r["page_id"]: (r["rule"], r["verdict"], r["decided_by"]) for r in
           urls.judge_urls(pages, urls.rule_table(spark)).collect()}
    for i, (u, _, want) in enumerate(rows):
        assert got[i] == (None, "allow" if want == "default" else want, "default" if want == "default" else "alias"), u


def test_resolution_against_the_library(spark):
    bases = ["http://a.com/b/c/d?q#f", "https://a.com", "http://a.com/"]
    targets = ["g", "./g", "g/", "/g", "//g.net/x", "?y", "g?y#s", ".", "./", "..", "../g", "../../g", "../../../g", "/./g",
               "/../g", "g.", "..g", "./g/.", "g/./h", "g/../h", "g?y/../x", "é/../ü"]
    out = spark.createDataFrame([(b, t) for b in bases for t in targets], "b string, t string").select(
        "b", "t", urls.resolved(F.col("t"), F.col("b")).alias("to")).collect()
    for r in out:
        assert r["to"] == urljoin(r["b"], r["t"]), r
    # RFC 3986 takes the dots out of an absolute target too, urljoin does not.
    far = spark.sql("select 'http://h.net/a/../b' as t, 'http://a.com' as b").select(urls.resolved(F.col("t"), F.col("b")).alias("to"))
    assert far.first()["to"] == "http://h.net/b"
    odd = spark.createDataFrame([("a&amp;lt;&#65;&#x1F600;&#xD800;&x&",)], "t string").select(urls.decoded(F.col("t")).alias("d"))
    assert odd.first()["d"] == "a&lt;A\U0001F600&#xD800;&x&"
