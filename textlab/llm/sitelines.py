"""Operator 10: line dedup by frequency within a site. Native.

A line is boilerplate of a host if the pages of the host that contain it number
at least ``min_pages`` and more than ``ratio`` of all pages of the host. Such
lines are dropped from the pages of that host, and only there. ``min_pages`` is
2 by default, so the ratio alone decides which repeated lines go.

A line counts once a page; it is compared without surrounding white space, by a
64-bit hash within its host. Lines are hashed once, in a scratch table of hashes, and
only hashes are counted, map-side before the shuffle, so a host or a line with a
third of all rows is no hot group. A host has at most (mean lines a page) / ratio
boilerplate lines.

``fold_copies`` counts copies of a page once, so that a line which only they share
is not boilerplate. A page is a copy if lines of its host above the ratio hold half
of its characters or more, and all copies with the same least such line (by hash)
count as one page, for their lines and for the host. Copies that differ in one
line each form few such groups, as they differ in this line only where it is the
one changed. Other pages always count one by one, and every page loses the lines found.

Nulls: a null text stays null and counts as a page without lines; null hosts
are one host. Blank lines never count and stay. Repeated rows count as pages of
their own and get equal results. An empty table gives an empty one. All input columns are
kept, whatever their names, but for one named ``_tl_dropped``, which is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlab.llm.shared import drop_written, written


def _bare(line: Column) -> Column:
    return F.trim(F.translate(line, "\t\r\x0b\x0c", "    "))


def _key(line: Column) -> Column:
    """64-bit hash of the bare line; null if blank."""
    bare = _bare(line)
    return F.when(bare != "", F.xxhash64(bare))


def _host(host_col: str) -> Column:
    return F.coalesce(F.col(host_col), F.lit(""))


def _pages(docs: DataFrame, id_col: str, text_col: str, host_col: str, sizes: bool) -> DataFrame:
    """One row a page: number of the row (stable once written), 64-bit hash of id and
    text, host and the keys of its distinct lines (a primitive array, which is made
    distinct by hashing); with ``sizes`` also the keys of all lines, their characters
    and the sum of these."""
    lines = F.split(F.col(text_col), "\n")
    page = [F.monotonically_increasing_id().alias("page"), F.xxhash64(id_col, text_col).alias("row"),
            _host(host_col).alias("host")]
    if not sizes:
        return docs.select(*page, F.array_compact(F.array_distinct(F.transform(lines, _key))).alias("keys"))
    bare = docs.select(*page, F.filter(F.transform(lines, _bare), lambda x: x != "").alias("bare"))
    return (bare.select("page", "row", "host", F.transform("bare", lambda x: F.xxhash64(x)).alias("all"),
                        F.transform("bare", F.length).alias("sizes"))
            .withColumn("keys", F.array_distinct("all"))
            .withColumn("chars", F.aggregate("sizes", F.lit(0).cast("long"), lambda s, x: s + x)))


def _over(n: str, ratio: float) -> Column:
    """Whether ``n`` pages are more than the ratio of ``host_pages``."""
    part, whole = float(ratio).as_integer_ratio()
    return F.col(n).cast("double") * whole > F.col("host_pages").cast("double") * part


def _copies(pages: DataFrame, ratio: float, min_pages: int) -> DataFrame:
    """(page, class): the pages that consist of lines above the ratio, by the
    least of these lines."""
    frequent = written(_frequent(pages, ratio, min_pages), "frequent")
    line = pages.select("page", "host", "chars", F.explode(F.arrays_zip("all", "sizes")).alias("l")).select(
        "page", "host", "chars", F.col("l.all").alias("h"), F.col("l.sizes").alias("size"))
    held = (line.join(frequent.select("host", "h"), ["host", "h"]).groupBy("page")
            .agg(F.sum("size").alias("size"), F.max("chars").alias("chars"), F.min("h").alias("class")))
    out = written(held.where(2 * F.col("size") >= F.col("chars")).select("page", "class"), "copies")
    drop_written(frequent)
    return out


def _frequent(pages: DataFrame, ratio: float, min_pages: int, copies: DataFrame | None = None) -> DataFrame:
    """(host, h, n_pages, host_pages) of the lines above the ratio; the copies of a
    class count as one page."""
    if copies is not None:
        pages = pages.join(copies, "page", "left")
    else:
        pages = pages.withColumn("class", F.lit(None).cast("long"))
    # Pages without a class count each, those of a class once; both sums start map-side.
    one = F.sum(F.when(F.col("class").isNull(), F.col("n")).otherwise(1))
    totals = pages.groupBy("host", "class").agg(F.count("*").alias("n")).groupBy("host").agg(one.alias("host_pages"))
    counts = (pages.select("host", "class", F.explode("keys").alias("h")).groupBy("host", "h", "class")
              .agg(F.count("*").alias("n")).groupBy("host", "h").agg(one.alias("n_pages"))
              .where(F.col("n_pages") >= min_pages))
    return counts.join(totals, "host").where(_over("n_pages", ratio)).select("host", "h", "n_pages", "host_pages")


def boilerplate_lines(pages: DataFrame, ratio: float, min_pages: int, fold_copies: bool = False) -> DataFrame:
    """(host, h, n_pages, host_pages) of the boilerplate lines of ``_pages``."""
    return _frequent(pages, ratio, min_pages, _copies(pages, ratio, min_pages) if fold_copies else None)


def drop_site_lines(docs: DataFrame, ratio: float = 0.05, min_pages: int = 2, fold_copies: bool = False,
                    id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """All columns of ``docs`` with the text cleaned, and ``_tl_dropped`` (long),
    the number of lines dropped."""
    pages = written(_pages(docs, id_col, text_col, host_col, fold_copies), "pagelines")
    boilerplate = written(boilerplate_lines(pages, ratio, min_pages, fold_copies), "sitelines")
    hits = (pages.select("row", "host", F.explode("keys").alias("h"))
            .join(boilerplate.select("host", "h"), ["host", "h"])
            .groupBy("row", "host").agg(F.collect_set("h").alias("bad")))
    # The input columns travel inside a struct, so none can clash with the helpers.
    kept = [c for c in docs.columns if c.lower() != "_tl_dropped"]
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("d"),
                        F.xxhash64(id_col, text_col).alias("row"), _host(host_col).alias("host"))
    lines = F.split(F.col(f"d.`{text_col}`"), "\n")
    left = F.filter(lines, lambda x: F.coalesce(~F.array_contains(F.col("bad"), _key(x)), F.lit(True)))
    out = whole.join(hits, ["row", "host"], "left").withColumn("left", F.when(F.col("bad").isNotNull(), left))
    dropped = F.when(F.col("bad").isNotNull(), F.size(lines) - F.size("left")).otherwise(0).cast("long")
    text = F.coalesce(F.array_join("left", "\n"), F.col(f"d.`{text_col}`"))
    return out.select(*[(text if c == text_col else F.col(f"d.`{c}`")).alias(c) for c in kept],
                      dropped.alias("_tl_dropped"))
