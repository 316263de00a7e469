"""Operator 6: line-first cleaning. Native.

Lines are judged one by one and failing ones removed: navigation (three or more
bars or arrows), boilerplate phrases, and punctuation (no closing mark at the
end, or more than one symbol of ``#*$%&|<>`` for every 20 characters). A text is
then rejected if more than half of its characters in lines with a word are
lost, or if it fails the base counts.

Nulls: a null text is an empty text with no words, so the base fails it. Texts
of any length are taken whole and stay in their row: nothing is exploded or
shuffled. Repeated rows get equal results, an empty table gives an empty one;
columns besides id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
_SPACES = "\x20\x09\x0a\x0b\x0c\x0d"

#: Phrases of lines that are not prose.
BOILERPLATE = ("all rights reserved", "cookie policy", "privacy policy", "terms of use", "terms of service",
               "enable javascript", "lorem ipsum", "subscribe to our newsletter", "click here", "sign in",
               "powered by", "share this")
#: A phrase counts as whole words only.
PHRASE = r"(^|[^\p{L}])(" + "|".join(BOILERPLATE) + r")($|[^\p{L}])"
CLOSING = r"""[.!?:;…。！？"'”’»)\]]\s*$"""
NAVIGATION = r"([|›»→>•·].*){3}"


def symbols(c: Column) -> Column:
    return F.length(c) - F.length(F.translate(c, SYMBOLS, ""))


def line_passes(line: Column) -> Column:
    return (line.rlike(CLOSING) & (20 * symbols(line) <= F.length(line)) & ~line.rlike(NAVIGATION) &
            ~F.lower(line).rlike(PHRASE))


def _repeat_words(df: DataFrame) -> DataFrame:
    """Words in five-word windows that the text holds twice or more.

    Window hashes are sorted with their places, equal neighbours give the
    places, and the union of the windows is the sum of their capped gaps. Every
    step reads a column once or is a column of its own, so no token array is
    computed again for each element."""
    none = F.array().cast("array<int>")
    df = df.withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w)))
    df = df.withColumn("_h2", F.zip_with("_h", F.slice("_h", 2, F.greatest(F.size("_h"), F.lit(1))),
                                         lambda a, b: F.xxhash64(a, b)))
    df = df.withColumn("_h4", F.zip_with("_h2", F.slice("_h2", 3, F.greatest(F.size("_h2"), F.lit(1))),
                                         lambda a, b: F.xxhash64(a, b)))
    df = df.withColumn("_g", F.slice(F.zip_with("_h4", F.slice("_h", 5, F.greatest(F.size("_h"), F.lit(1))),
                                                lambda a, b: F.xxhash64(a, b)),
                                     1, F.greatest(F.size("_h") - 4, F.lit(0))))
    df = df.withColumn("_twice", F.size(F.array_distinct("_g")) < F.size("_g"))
    placed = F.sort_array(F.transform("_g", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    df = df.withColumn("_s", F.when(F.col("_twice"), placed))
    pairs = F.zip_with(F.slice("_s", 1, F.size("_s") - 1), F.slice("_s", 2, F.size("_s") - 1),
                       lambda a, b: F.when(a["x"] == b["x"], F.array(a["i"], b["i"])).otherwise(none))
    df = df.withColumn("_p", F.when(F.col("_twice"), F.sort_array(F.array_distinct(F.flatten(pairs)))))
    gaps = F.zip_with("_p", F.slice("_p", 2, F.greatest(F.size("_p"), F.lit(1))),
                      lambda a, b: F.least(F.lit(5), F.coalesce(b - a, F.lit(5))))
    return df.withColumn("n_repeat_words", F.when(F.col("_twice"), F.aggregate(
        gaps, F.lit(0).cast("long"), lambda s, g: s + g)).otherwise(F.lit(0).cast("long")))


def clean_lines(docs: DataFrame, max_lost: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, clean_text, the base counts, n_lines, n_lines_failed,
    lost_chars, base_failed, kept."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    df = docs.select(F.col(id_col).alias("doc_id"), text.alias("_t"))
    df = df.withColumn("_w", F.regexp_extract_all("_t", F.lit(f"({WORD})"), F.lit(1)))
    df = df.withColumn("_l", F.split("_t", "\n"))
    df = df.withColumn("_lw", F.filter("_l", lambda x: x.rlike(WORD)))
    df = df.withColumn("_ok", F.filter("_lw", line_passes))
    df = _repeat_words(df)
    total = F.aggregate("_lw", F.lit(0).cast("long"), lambda s, x: s + F.length(x))
    good = F.aggregate("_ok", F.lit(0).cast("long"), lambda s, x: s + F.length(x))
    n_words = F.size("_w").cast("long")
    df = df.select(
        "doc_id", F.array_join("_ok", "\n").alias("clean_text"), n_words.alias("n_words"),
        F.length(F.translate("_t", _SPACES, "")).cast("long").alias("word_chars"),
        symbols(F.col("_t")).cast("long").alias("n_symbols"),
        (F.size("_lw") - F.size(F.array_distinct("_lw"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words", F.size("_lw").cast("long").alias("n_lines"),
        (F.size("_lw") - F.size("_ok")).cast("long").alias("n_lines_failed"), total.alias("_total"),
        (total - good).alias("lost_chars"),
        ((n_words < 10) | (100 * F.col("n_repeat_words") > 20 * n_words)).alias("base_failed"))
    share = int(round(max_lost * 1000))
    return df.withColumn("kept", ~F.col("base_failed") & (1000 * F.col("lost_chars") <= share * F.col("_total"))).drop("_total")
