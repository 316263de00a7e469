"""Dictionary baseline: lexicon word/phrase flags and the profanity ratio.

A lexicon of checked small size is compiled into the projection itself:
``exists(tokens, t -> t IN (...))`` becomes a hashed ``InSet`` evaluated once
per token, so flagging is map-only (no explode, no shuffle) and stops at the
first hit. A lexicon above the inline bound goes through an anchor index: every cue is
filed under its rarest token, documents meet the cues of the tokens they hold, and
only those phrases are looked for in the text; hits are joined back by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.ngrams import word_kgrams
from ..functions.normalize import alpha_tokens, normalise, split_ws, ws_join
from ..session import cut_lineage
from .common import INLINE_MAX_ROWS, collect_bounded, row_count_at_most, sized_broadcast


def lexicon_structs(cues: DataFrame) -> DataFrame:
    """``(cue, toks, n_tok)``: each cue split on whitespace; one-token cues
    are words, longer ones phrases grouped by length."""
    toks = split_ws(ws_join("cue"))
    return cues.select("cue", toks.alias("toks"), F.size(toks).alias("n_tok")).where(F.col("n_tok") > 0)


def _tokens(text_col: str, assume_normalised: bool) -> Column:
    t = F.col(text_col) if assume_normalised else normalise(text_col)
    return split_ws(ws_join(t)) if assume_normalised else split_ws(t)


def _in(c: Column, values: list[str]) -> Column:
    return c.isin(*values) if values else F.lit(False)


def _member_of(values: list[str]):
    """One-argument predicate for array higher-order functions."""
    return lambda g: _in(g, values)


def _inline_hit(tokens: Column, structs: DataFrame) -> Column:
    rows = collect_bounded(structs.select("n_tok", F.array_join("toks", " ").alias("gram")),
                           INLINE_MAX_ROWS, "lexicon")
    by_len: dict[int, list[str]] = {}
    for r in rows:
        by_len.setdefault(r.n_tok, []).append(r.gram)
    hit = F.lit(False)
    for k in sorted(by_len):
        grams = sorted(set(by_len[k]))
        hit = hit | F.exists(word_kgrams(tokens, k), _member_of(grams))
    return hit


#: Anchor tokens, the most frequent ones, whose documents are matched without a shuffle.
HOT_ANCHORS = 1_000


def anchor_index(words: DataFrame, structs: DataFrame) -> DataFrame:
    """``(anchor, n_docs, gram, n_tok)``: every cue under the one of its tokens that the
    fewest documents of ``words`` hold (ties: the least token). A cue with a token
    that no document holds cannot occur and is left out."""
    lex = structs.select(F.array_join("toks", " ").alias("gram"), "toks", "n_tok").dropDuplicates(["gram"])
    parts = lex.select("gram", "n_tok", F.explode(F.array_distinct("toks")).alias("anchor"))
    counts = (words.join(parts.select("anchor").distinct(), "anchor", "left_semi")
              .groupBy("anchor").agg(F.count("*").alias("n_docs")))
    rarest = F.min(F.struct(F.coalesce("n_docs", F.lit(0)).alias("n_docs"), "anchor")).alias("r")
    return (parts.join(counts, "anchor", "left").groupBy("gram", "n_tok").agg(rarest)
            .select("r.anchor", "r.n_docs", "gram", "n_tok").where(F.col("n_docs") > 0))


def _joined_hits(df: DataFrame, tokens: Column, structs: DataFrame, key: str) -> DataFrame:
    """Keys of the rows that hold a cue, for a lexicon of any size.

    Only documents that hold a cue's rarest token are compared with it, so the work
    follows those hits and not the number of k-grams or of cue lengths. The most
    frequent anchors, a stated number, meet their documents by a broadcast of checked
    size; without them no key of the other join is hot."""
    tok = df.select(key, tokens.alias("tok"))
    words = tok.select(key, F.explode(F.array_distinct("tok")).alias("anchor"))
    index = cut_lineage(anchor_index(words, structs))
    hot = F.broadcast(index.groupBy("anchor").agg(F.max("n_docs").alias("n"))
                      .orderBy(F.desc("n"), "anchor").limit(HOT_ANCHORS).select("anchor"))
    often = words.join(sized_broadcast(index.join(hot, "anchor", "left_semi")), "anchor")
    rest = words.join(hot, "anchor", "left_anti").join(index.join(hot, "anchor", "left_anti"), "anchor")
    met = often.unionByName(rest).select(key, "gram", "n_tok")
    # One token is the whole cue; a phrase is looked for between blanks, as no token holds one.
    phrases = met.where("n_tok > 1").join(
        tok.select(key, F.concat(F.lit(" "), F.array_join("tok", " "), F.lit(" ")).alias("line")), key)
    found = phrases.where(F.contains("line", F.concat(F.lit(" "), "gram", F.lit(" ")))).select(key)
    return met.where("n_tok = 1").select(key).unionByName(found).distinct().withColumn("hit__", F.lit(True))


def lexicon_flag(df: DataFrame, cues: DataFrame, text_col: str = "text", key: str = "doc_id",
                 assume_normalised: bool = False, threshold: float = 0.5) -> DataFrame:
    """Rows of ``df`` plus ``p1`` (1.0 if any word or phrase cue occurs in the
    whitespace tokens of the normalised text) and ``prediction``."""
    structs = lexicon_structs(cues)
    # Tokens become a column first: the k-gram lambdas index into it many
    # times per row and must not re-run the normalisation each time.
    tok = df.withColumn("tok__", _tokens(text_col, assume_normalised))
    if row_count_at_most(structs, INLINE_MAX_ROWS) is not None:
        out = tok.withColumn("hit__", _inline_hit(F.col("tok__"), structs))
    else:
        hits = _joined_hits(tok, F.col("tok__"), structs, key)
        out = tok.join(hits, key, "left").withColumn("hit__", F.coalesce("hit__", F.lit(False)))
    p1 = F.col("hit__").cast("double")
    return (out.withColumn("p1", p1)
            .withColumn("prediction", (F.col("p1") >= threshold).cast("int"))
            .drop("hit__", "tok__"))


def profanity_ratio(df: DataFrame, cues: DataFrame, norm_col: str = "norm",
                    key: str = "doc_id", out: str = "profanity_ratio") -> DataFrame:
    """Share of ``[a-z]+`` tokens of the normalised text that are cues; 0 for
    no tokens. Multi-word cues can never equal such a token and are skipped."""
    words = cues.where(F.col("cue").rlike("^[a-z]+$")).select("cue").distinct()
    toks = alpha_tokens(F.coalesce(F.col(norm_col), F.lit("")))
    df = df.withColumn("atok__", toks)
    toks = F.col("atok__")
    if row_count_at_most(words, INLINE_MAX_ROWS) is not None:
        vals = sorted(r.cue for r in collect_bounded(words, INLINE_MAX_ROWS, "lexicon"))
        hits = F.size(F.filter(toks, _member_of(vals)))
        ratio = F.when(F.size(toks) == 0, F.lit(0.0)).otherwise(hits / F.size(toks))
        return df.withColumn(out, ratio.cast("double")).drop("atok__")
    exploded = df.select(key, F.explode(toks).alias("cue"))
    flagged = exploded.join(sized_broadcast(words.withColumn("hit__", F.lit(1.0))), "cue", "left")
    ratios = flagged.groupBy(key).agg(F.avg(F.coalesce("hit__", F.lit(0.0))).alias(out))
    return (df.join(ratios, key, "left").withColumn(out, F.coalesce(F.col(out), F.lit(0.0)))
            .drop("atok__"))
