"""Operator 2: url rules with block decisions spread over redirect aliases.

Urls that redirect to one another, or name one another as canonical, are one
page. Connected components over those edges carry a block from any alias to
all, whether or not the alias is itself a row; an explicit allow always wins: a url's own rule decides first, then an
allow on any alias, then a block on any alias, and otherwise the url is
allowed.

Targets of links and refreshes are decoded and resolved against the page (its
``<base>``, else its url) by RFC 3986; one of another scheme without ``://``
names no page.

Nulls: a null url, or one without ``://``, has empty host and path, fits no
rule and has no alias; it is allowed. A url of any length is taken whole.
Repeated rows get equal results, ties between rules of one length go to the
first rule string in order, an empty table gives an empty one. The output holds
only the named columns, so extra columns cannot clash.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textlab.llm.components import connected_components
from textlab.llm.shared import written

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_ABSOLUTE = r"^[A-Za-z][A-Za-z0-9+.\-]*://"
RULE_SCHEMA = "rule_host string, rule_path string, rule_verdict string"

#: (rule, verdict); a rule is a host and a path.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
         ("com/fr/", "allow"), ("com/de/", "block"))


def lower_ascii(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    rows = [(r[:r.index("/")], r[r.index("/"):], v) for r, v in rules]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rule, rule_verdict) of the longest rule that fits each distinct
    url; urls that no rule fits are absent.

    A host has few labels, so its suffixes meet the rules in an equi-join; the
    rule table may be of any size."""
    labels = F.split(F.col("host"), r"\.")
    parts = (urls.select("url").distinct()
             .select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
             .where("host <> ''")
             .withColumn("labels", labels)
             .select("url", "path", F.explode(F.transform(
                 F.sequence(F.lit(1), F.size("labels")),
                 lambda i: F.array_join(F.slice("labels", i, F.size("labels")), "."))).alias("rule_host")))
    fits = parts.join(rules, "rule_host").where(F.startswith(F.col("path"), F.col("rule_path")))
    rule = F.concat("rule_host", "rule_path")
    best = F.max_by(F.struct(rule.alias("rule"), F.col("rule_verdict")),
                    F.struct(F.length(rule), rule))
    return fits.groupBy("url").agg(best.alias("b")).select("url", "b.rule", "b.rule_verdict")


def canonical_form(url: Column) -> Column:
    """Spelling that aliases of a page share: no scheme, fragment, ``www.`` or
    ``m.`` label, tracking parameter, ``.html`` or closing slash."""
    host = F.regexp_replace(host_of(url), r"^(www|m)\.", "")
    path = F.regexp_replace(path_of(url), r"(\.html)?/*$", "")
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    keep = F.array_sort(F.filter(F.split(query, "&"),
                                 lambda p: (p != "") & ~p.rlike(r"^(utm_[a-z]+|ref|gclid|fbclid)=")))
    return F.concat(F.lit("//"), host, path,
                    F.when(F.size(keep) > 0, F.concat(F.lit("?"), F.array_join(keep, "&"))).otherwise(""))


def decoded(text: Column) -> Column:
    """Attribute text with its character references replaced, in one pass."""
    def one(t: Column) -> Column:
        number = F.when(F.lower(t).startswith("&#x"), F.conv(F.regexp_extract(t, "([0-9A-Fa-f]+);", 1), 16, 10)).otherwise(
            F.regexp_extract(t, "([0-9]+);", 1)).cast("long")
        is_char = ((number > 0) & (number < 0xD800)) | ((number > 0xDFFF) & (number < 0x110000))
        char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        named = F.element_at(F.create_map(*[F.lit(x) for x in (
            "&amp;", "&", "&lt;", "<", "&gt;", ">", "&quot;", '"', "&apos;", "'")]), F.lower(t))
        return F.when(t.startswith("&#"), F.when(is_char, char).otherwise(t)).otherwise(F.coalesce(named, t))

    parts = F.regexp_extract_all(text, F.lit(
        r"(?i)&(?:amp|lt|gt|quot|apos|#x[0-9a-f]{1,6}|#[0-9]{1,7});|[^&]+|&"), F.lit(0))
    whole = F.when(text.contains("&"), F.array_join(F.transform(parts, one), "")).otherwise(text)
    return F.regexp_replace(whole, r"""^["']+|["']+$""", "")


def without_dots(url: Column) -> Column:
    """The url without ``.`` and ``..`` segments in its path."""
    path = path_of(url)
    parts = F.split(F.substring(path, 2, 2**31 - 1), "/")
    kept = F.aggregate(parts, F.array().cast("array<string>"), lambda acc, p: F.when(
        p == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).when(
        p == ".", acc).otherwise(F.concat(acc, F.array(p))))
    closing = F.when(path.rlike(r"/\.\.?$") & (F.size(kept) > 0), "/").otherwise("")
    return F.when(path.rlike(r"/\.\.?(/|$)"), F.concat(
        F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1), F.lit("/"), F.array_join(kept, "/"), closing,
        F.regexp_extract(url, r"(?s)^.*?://[^?#]*(.*)$", 1))).otherwise(url)


def resolved(target: Column, base: Column) -> Column:
    """The absolute url of a target named on a page; null if it names none."""
    root, path = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1), path_of(base)
    folder = F.regexp_replace(path, "[^/]*$", "")
    return without_dots(
        F.when(target.rlike(_ABSOLUTE), target)
        .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), None)
        .when(target.startswith("//"), F.concat(F.regexp_extract(base, "(?s)^(.*?:)//", 1), target))
        .when(target.startswith("/"), F.concat(root, target))
        .when(target.startswith("?"), F.concat(root, path, target))
        .when(target.startswith("#"), base)
        .when(target != "", F.concat(root, F.when(folder == "", "/").otherwise(folder), target)))


def alias_edges(pages: DataFrame) -> DataFrame:
    """(a, b): each url, and each target of a canonical link or meta refresh,
    with its canonical spelling, and each url with those of its targets."""
    url, html = F.col("url"), F.coalesce(F.col("html"), F.lit(""))
    link = F.when(html.rlike("(?i)canonical"), F.regexp_extract(
        html, r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*?\bhref\s*=\s*["']?([^"'\s>]+)""", 1))
    refresh = F.when(html.rlike("(?i)http-equiv"), F.regexp_extract(
        html, r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*?\burl\s*=\s*["']?([^"'\s>]+)""", 1))
    base = F.when(html.rlike(r"(?i)<base\b"), F.regexp_extract(
        html, r"""(?is)<base\b[^>]*?\bhref\s*=\s*["']?([^"'\s>]+)""", 1))
    named = pages.where(url.contains("://")).select(
        "url", decoded(link).alias("link"), decoded(refresh).alias("refresh"), decoded(base).alias("base"))
    found = (named.withColumn("base", F.coalesce(resolved(F.col("base"), url), url))
             .select("url", F.explode(F.array_compact(F.array(
                 resolved(F.col("link"), F.col("base")), resolved(F.col("refresh"), F.col("base")), url))).alias("to"))
             .select("url", "to", canonical_form(F.col("to")).alias("b")))
    return (found.select(F.explode(F.array(F.struct(url.alias("a"), "b"), F.struct(F.col("to").alias("a"), "b"))).alias("e"))
            .select("e.a", "e.b").where("a <> b").distinct())


def spread_verdicts(edges: DataFrame, matched: DataFrame) -> DataFrame:
    """(url, spread): the verdict that aliases give every url of an edge."""
    group = written(connected_components(edges), "aliases")
    ruled = group.join(matched, group["id"] == matched["url"]).groupBy("component").agg(
        F.max(F.col("rule_verdict") == "allow").alias("allow"))
    return group.join(ruled, "component").select(
        F.col("id").alias("url"), F.when(F.col("allow"), "allow").otherwise("block").alias("spread"))


def judge_urls(pages: DataFrame, rules: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, and how it was decided."""
    pages = pages.select("page_id", "url", "html")
    edges = written(alias_edges(pages), "edges") if edges is None else edges
    nodes = edges.select(F.explode(F.array("a", "b")).alias("url")).where(F.col("url").rlike(_ABSOLUTE))
    matched = written(match_rules(pages.select("url").union(nodes), rules), "rules")
    spread = spread_verdicts(edges, matched)
    url = F.col("url")
    return (pages.select("page_id", "url").join(matched, "url", "left").join(spread, "url", "left")
            .select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), "rule",
                    F.coalesce("rule_verdict", "spread", F.lit("allow")).alias("verdict"),
                    F.when(F.col("rule").isNotNull(), "rule").when(F.col("spread").isNotNull(), "alias")
                    .otherwise("default").alias("decided_by")))
