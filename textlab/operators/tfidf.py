"""Exact TF-IDF over word and character n-grams, in long form.

Postings ``(doc_id, block, term, tf)`` come from one explode of all blocks'
terms and one aggregation keyed by document. The vocabulary is fitted on the
train documents only (document frequency >= ``min_df``, optional cap on the
most frequent terms), indexed in sorted term order per block with the word
block first, and carries the smooth idf ``ln((1 + n) / (1 + df)) + 1``.
Weights are ``(1 + ln tf) * idf``, L2-normalised per document and block.

No ``CountVectorizer``/``HashingTF``/``IDF``: the vocabulary is unbounded (no
262,144-term cap, no hashing collisions) and ml's IDF omits the ``+ 1``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.ngrams import char_ngrams, word_ngrams
from ..functions.normalize import default_word_tokens, latin_tokens, lemma_input, letter_tokens, with_stripped_accents
from ..session import cut_lineage
from .common import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS, collect_bounded, row_count_at_most, sized_broadcast
from .sketch import frequent_bits, may_be_frequent, width_for

WORD, CHAR = 0, 1
# A lemma table up to this size is applied in the projection (its map lookup
# is linear in the table, paid only for tokens that are forms).
LEMMA_INLINE_MAX = 256


@dataclass(frozen=True)
class TfidfParams:
    word_ngrams: tuple[int, int] = (1, 2)
    char_ngrams: tuple[int, int] = (3, 4)
    min_df_word: int = 3
    min_df_char: int = 3
    max_features_word: int | None = None
    max_features_char: int | None = None
    use_lemmatizer: bool = True
    latin_only: bool = False       # lookup tokens are runs of A-Z and a-z, for a table of stems
    sketch_from: int = 1 << 30     # characters of train text from which rare terms are sketched out first

    def min_df(self, block: int) -> int:
        return self.min_df_word if block == WORD else self.min_df_char

    def max_features(self, block: int) -> int | None:
        return self.max_features_word if block == WORD else self.max_features_char


# ------------------------------------------------------------ word tokens
def lemmatize(df: DataFrame, tok_col: str, lemmas: DataFrame | None, key: str = "doc_id",
              out: str = "wtok") -> DataFrame:
    """Map every token through a ``(form, lemma)`` table (a token without an
    entry stays itself), keeping token order.

    A table of at most ``LEMMA_INLINE_MAX`` forms is applied in the projection
    (hashed membership first, map lookup only for hits). A larger one is
    joined: tokens are exploded with their position, left-joined to the
    table (broadcast after a size check, else shuffled), and re-assembled per
    document in position order.
    """
    if lemmas is None:
        return df.withColumn(out, F.col(tok_col))
    # A form listed twice takes its smallest lemma, on either path.
    changing = (lemmas.groupBy("form").agg(F.min("lemma").alias("lemma"))
                .where(F.col("form") != F.col("lemma")).select("form", "lemma"))
    if row_count_at_most(changing, LEMMA_INLINE_MAX) is not None:
        pairs = collect_bounded(changing, LEMMA_INLINE_MAX, "lemma table")
        if not pairs:
            return df.withColumn(out, F.col(tok_col))
        forms = [r.form for r in pairs]
        m = F.create_map(*[x for r in pairs for x in (F.lit(r.form), F.lit(r.lemma))])
        mapped = F.transform(F.col(tok_col), lambda t: F.lower(F.when(t.isin(*forms), F.element_at(m, t)).otherwise(t)))
        return df.withColumn(out, mapped)
    toks = df.select(key, F.posexplode(tok_col).alias("pos", "form"))
    joined = toks.join(sized_broadcast(changing, BROADCAST_MAX_ROWS), "form", "left")
    regrouped = (joined.groupBy(key)
                 .agg(F.sort_array(F.collect_list(F.struct("pos", F.lower(F.coalesce("lemma", "form")).alias("t"))))
                      .alias("pt"))
                 .select(key, F.transform("pt", lambda s: s["t"]).alias(out)))
    return (df.join(regrouped, key, "left")
            .withColumn(out, F.coalesce(F.col(out), F.array().cast("array<string>"))))


def word_tokens(df: DataFrame, norm_col: str, params: TfidfParams, lemmas: DataFrame | None,
                key: str = "doc_id", out: str = "wtok") -> DataFrame:
    """Word-block tokens of normalised text. With the lemma tokenizer: accent
    strip, normalise again, alphabetic word runs (or runs of A-Z and a-z), lemma
    or stem lookup, lower-case.
    Without: accent strip, word runs of two or more characters."""
    d = with_stripped_accents(df, norm_col, "plain__")
    if params.use_lemmatizer:
        d = d.withColumn("wraw__", (latin_tokens if params.latin_only else letter_tokens)(lemma_input("plain__")))
        return lemmatize(d, "wraw__", lemmas, key, out).drop("wraw__", "plain__")
    return d.withColumn(out, default_word_tokens("plain__")).drop("plain__")


# --------------------------------------------------------------- postings
def block_terms(word_tok: Column | None, char_text: Column | None, params: TfidfParams,
                char_top: Column | None = None) -> Column:
    """One array of ``struct(block, term)`` holding both blocks' n-grams
    (``char_top``: a column with the longest char n-grams, see char_ngrams)."""
    parts = []
    if word_tok is not None:
        lo, hi = params.word_ngrams
        parts.append(F.transform(word_ngrams(word_tok, lo, hi),
                                 lambda t: F.struct(F.lit(WORD).alias("block"), t.alias("term"))))
    if char_text is not None:
        lo, hi = params.char_ngrams
        parts.append(F.transform(char_ngrams(char_text, lo, hi, char_top),
                                 lambda t: F.struct(F.lit(CHAR).alias("block"), t.alias("term"))))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def term_hash(block: Column, term: Column) -> Column:
    return F.xxhash64(block, term)


def rare_terms_filter(train: DataFrame, terms: Column, params: TfidfParams,
                      characters: int) -> Callable[[Column, Column], Column] | None:
    """First pass of the fit: a predicate (block, term) that is false only for terms
    that cannot be in ``min_df`` train documents. Nothing is stored: the distinct
    term hashes of each document are counted in a count-min sketch.

    The pass pays for itself where rare terms would be stored and shuffled in bulk, so
    it is run on train texts of ``params.sketch_from`` ``characters`` or more; the exact
    counts decide in any case."""
    least = min(params.min_df_word, params.min_df_char)
    if least <= 1 or characters < params.sketch_from:
        return None
    hashes = train.select(F.explode(F.array_distinct(F.transform(
        terms, lambda t: term_hash(t["block"], t["term"])))).alias("h"))
    width = width_for(characters)
    bits = frequent_bits(hashes, least, width)
    return lambda block, term: may_be_frequent(term_hash(block, term), bits, width)


def postings(df: DataFrame, terms: Column, key: str = "doc_id", keep=(), kept=None) -> DataFrame:
    """``(doc_id, *keep, block, term, tf)``; ``keep`` columns depend on the
    key only. ``kept``: a predicate (block, term) of the terms to keep. When ``df``
    is hash-partitioned by the key the aggregation is shuffle-free; otherwise the
    partial aggregation collapses each document's repeats before the shuffle."""
    ex = df.select(key, *keep, F.explode(terms).alias("bt")).select(key, *keep, "bt.block", "bt.term")
    if kept is not None:
        ex = ex.where(kept(F.col("block"), F.col("term")))
    return ex.groupBy(key, *keep, "block", "term").agg(F.count("*").alias("tf"))


# ------------------------------------------------------------- vocabulary
def sorted_index(df: DataFrame, order_cols: list[str], parts: int | None = None,
                 out: str = "idx") -> DataFrame:
    """Dense 0-based index in the global order of ``order_cols`` without a
    single-partition window: range-partition, sort inside partitions, number
    rows locally, checkpoint (fixes the sampled range bounds), then add the
    per-partition offsets (one count per partition reaches the driver)."""
    spark = df.sparkSession
    parts = parts or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    r = (df.repartitionByRange(parts, *order_cols).sortWithinPartitions(*order_cols)
         .withColumn("pid__", F.spark_partition_id())
         .withColumn("mid__", F.monotonically_increasing_id()))
    r = cut_lineage(r)
    counts = {row.pid__: row["count"] for row in r.groupBy("pid__").count().collect()}
    offsets, acc = [], 0
    for p in range(max(counts, default=-1) + 1):
        offsets.append(acc)
        acc += counts.get(p, 0)
    off = F.element_at(F.array(*[F.lit(o).cast("long") for o in offsets] or [F.lit(0).cast("long")]),
                       F.col("pid__") + 1)
    local = F.col("mid__") - F.shiftleft(F.col("pid__").cast("long"), 33)
    return r.withColumn(out, (off + local).cast("long")).drop("pid__", "mid__")


def document_frequencies(train_postings: DataFrame) -> DataFrame:
    """``(block, term, df, ttf)`` over the train postings (partial agg)."""
    return train_postings.groupBy("block", "term").agg(F.count("*").alias("df"), F.sum("tf").alias("ttf"))


def kept_terms(dfs: DataFrame, params: TfidfParams, blocks=(WORD, CHAR)) -> DataFrame:
    """The rows of ``dfs`` that belong to the vocabulary: terms in >= min_df train
    documents, optionally the ``max_features`` most frequent per block (ties by term)."""
    enough = {b: (F.col("block") == b) & (F.col("df") >= params.min_df(b)) for b in blocks}
    if not any(params.max_features(b) for b in blocks):
        return dfs.where(reduce(Column.__or__, enough.values()))
    kept = []
    for b in blocks:
        v, cap = dfs.where(enough[b]), params.max_features(b)
        kept.append(v.orderBy(F.desc("ttf"), "term").limit(int(cap)) if cap else v)
    return reduce(DataFrame.unionByName, kept)


def index_vocab(dfs: DataFrame, n_docs: int, params: TfidfParams, blocks=(WORD, CHAR)) -> DataFrame:
    """``(block, term, df, idf, idx)`` of the kept terms of ``(block, term, df, ttf)``,
    indexed in sorted order with lower blocks first."""
    capped = any(params.max_features(b) for b in blocks)
    if capped:
        dfs = dfs.persist(StorageLevel.MEMORY_AND_DISK)  # read once a block
    idf = F.log((1.0 + n_docs) / (1.0 + F.col("df"))) + 1.0
    # The index job reads its input twice (range sampling, then the sort);
    # the kept terms are computed once.
    vocab = kept_terms(dfs, params, blocks).select("block", "term", "df", idf.alias("idf")).persist(StorageLevel.MEMORY_AND_DISK)
    out = sorted_index(vocab, ["block", "term"])
    vocab.unpersist()
    if capped:
        dfs.unpersist()
    return out


def fit_vocab(train_postings: DataFrame, n_docs: int, params: TfidfParams,
              blocks=(WORD, CHAR)) -> DataFrame:
    """The vocabulary of train postings (see ``index_vocab``)."""
    return index_vocab(document_frequencies(train_postings), n_docs, params, blocks)


def row_bytes(df: DataFrame) -> Column:
    """About the bytes that a row takes in a broadcast table."""
    size = F.lit(16 * len(df.columns))
    for name, kind in df.dtypes:
        if kind == "string":
            size = size + F.octet_length(name)
    return size


def hot_terms(vocab: DataFrame, most_bytes: int) -> DataFrame | None:
    """The most frequent terms that fit ``most_bytes`` together, or None if all do.

    A frequency is cut at powers of two: the bytes of the terms at or above each power
    are known from one aggregation (a row a power), so the cut is the lowest that fits.
    """
    per = (vocab.groupBy(F.floor(F.log2("df")).cast("int").alias("power")).agg(F.sum(row_bytes(vocab)).alias("bytes"))
           .collect())
    total, cut = 0, None
    for r in sorted(per, key=lambda r: -r.power):
        if total + r.bytes > most_bytes:
            return vocab.where(F.col("df") >= F.lit(1 << cut)) if cut is not None else vocab.limit(0)
        total, cut = total + r.bytes, r.power
    return None


def look_up(postings_: DataFrame, vocab: DataFrame, most_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Postings with ``idx`` and ``idf``; terms outside the vocabulary are dropped.

    A vocabulary of at most ``most_bytes`` is broadcast. Of a larger one the terms in
    most documents are, up to that size, so that no key of the shuffle join that
    serves the rest holds more than its share of rows; both parts are united."""
    v = vocab.select("block", "term", "df", "idx", "idf")
    hot = hot_terms(v, most_bytes)
    if hot is None:
        return postings_.join(F.broadcast(v.drop("df")), ["block", "term"])
    hot = hot.drop("df")
    tried = postings_.join(F.broadcast(hot.withColumnsRenamed({"idx": "hot_idx", "idf": "hot_idf"})), ["block", "term"], "left")
    found = (tried.where("hot_idx is not null")
             .withColumnsRenamed({"hot_idx": "idx", "hot_idf": "idf"}))
    rest = (tried.where("hot_idx is null").drop("hot_idx", "hot_idf")
            .join(v.drop("df").hint("shuffle_merge"), ["block", "term"]))
    return found.unionByName(rest)


def weigh(all_postings: DataFrame, vocab: DataFrame, key: str = "doc_id", keep=(),
          most_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``(doc_id, block, idx, w)``: sublinear tf times idf, L2-normalised per
    document and block; terms outside the vocabulary are dropped (see ``look_up``)."""
    j = look_up(all_postings, vocab, most_bytes)
    raw = (1.0 + F.log(F.col("tf").cast("double"))) * F.col("idf")
    w = Window.partitionBy(key, "block")
    return (j.select(key, *keep, "block", "idx", raw.alias("r"))
            .withColumn("norm", F.sqrt(F.sum(F.col("r") * F.col("r")).over(w)))
            .select(key, *keep, "block", "idx", (F.col("r") / F.col("norm")).alias("w")))
