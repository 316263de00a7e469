"""The feature job: split, normalise, fit TF-IDF on train, add the raw-text
and profanity blocks, select by chi-squared, pack.

The corpus is read once. That pass normalises and tokenises every text, computes its
statistics, its hash key and the hash of the row, and writes the keyed rows to the
shared folder. Everything else reads the columns it needs of those rows, down to two
of them for the content signature and the class counts: ``rows -> split -> counts ->
vocab -> chi2 -> packed``. (``DataFrame.observe`` could count in the
writing pass, but in Spark 4.1 a session that holds an ``Observation`` cannot be
serialised, and every fitted ML model whose summary refers to it fails in its tasks.)

N-grams are counted and weighed in slices of many documents (``operators.batches``):
one pass counts the train texts, one sums train weights by class for the selection,
one writes the vectors. No posting is a row of its own on the way, so nothing that
grows like the postings is shuffled, persisted or spilled; a pass is cheaper than
reading stored postings back.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from functools import cache

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.ngrams import char_kgrams
from ..functions.normalize import normalise
from ..functions.stats import STAT_COLUMNS, raw_text_stats
from ..operators.assemble import dense_block_long, sparse_vector
from ..operators.batches import Weighed, class_sums, document_rows, term_counts
from ..operators.common import spread
from ..operators.lexicon import profanity_ratio
from ..operators.select import chi2_scores, class_priors, top_k
from ..operators.split import assign_split, hash_key, plan_split
from ..operators.tfidf import TfidfParams, block_terms, index_vocab, kept_terms, postings, rare_terms_filter, word_tokens
from ..session import written
from ..sources.io import cues_frame, lemma_frame
from ..sources.store import content_sums, row_hash


@dataclass(frozen=True)
class FeatureConfig:
    seed: int = 1337
    test_size: float = 0.1
    valid_size: float = 0.1
    folds: int = 3
    tfidf: TfidfParams = field(default_factory=TfidfParams)
    use_raw_feats: bool = True
    use_profanity_ratio: bool = True
    selection: bool = True
    k_best: int = 150_000
    rank_digits: int | None = None   # rank chi2 rounded (engine-stable ties)

    def as_dict(self) -> dict:
        return asdict(self)

    @staticmethod
    def from_dict(kept: dict) -> "FeatureConfig":
        """The settings that ``as_dict`` gave, also after a way through JSON."""
        tfidf = {k: tuple(v) if isinstance(v, list) else v for k, v in kept["tfidf"].items()}
        return FeatureConfig(**{**kept, "tfidf": TfidfParams(**tfidf)})


@dataclass
class FeatureSet:
    long: DataFrame          # (doc_id, label, split, fold, idx, w) after selection
    docs: DataFrame          # (doc_id, label, split, fold)
    vocab: DataFrame         # (block, term, df, idf, idx)
    selected: DataFrame | None
    n_features: int          # width before selection
    size: int                # width after selection
    n_terms: int             # width of the TF-IDF blocks: where the others begin
    pairs: DataFrame | None = None      # (doc_id, keys, pairs of idx and w) after selection
    make_weights: Callable | None = None
    make_postings: Callable | None = None
    persisted: list = field(default_factory=list)
    content: dict = field(default_factory=dict)  # signature sums of the rows that were read

    @property
    def tfidf(self) -> DataFrame:
        """(doc_id, keys, idx, w) of the word and char blocks."""
        return _long_rows(self.make_weights(), F.col("terms"))

    @property
    def assembled(self) -> DataFrame:
        """(doc_id, keys, idx, w) of all blocks before selection."""
        return _long_rows(self.make_weights(), F.col("pairs"))

    @property
    def postings(self) -> DataFrame:
        """(doc_id, keys, block, term, tf) as rows; the job itself never makes them."""
        return self.make_postings()

    def packed(self) -> DataFrame:
        return self.pairs.select("doc_id", *KEEP, sparse_vector("pairs", self.size).alias("features"))

    def release(self) -> None:
        for d in self.persisted:
            d.unpersist()


KEEP = ("label", "split", "fold")
#: Folds are numbered below this.
MAX_FOLD_NUMBER = 127


def text_columns(docs: DataFrame, cfg: FeatureConfig, cues: DataFrame | None, lemmas: DataFrame | None) -> DataFrame:
    """``docs`` with all that is computed from a text alone: ``norm``, the word tokens
    ``wtok``, and, if wanted, the statistics and the profanity ratio."""
    cols = docs.columns
    d = docs.withColumn("norm", normalise("text"))
    d = word_tokens(d, "norm", cfg.tfidf, lemmas)
    cols = [*cols, "norm", "wtok"]
    if cfg.use_profanity_ratio and cues is not None:
        d = profanity_ratio(d, cues, "norm")
        cols.append("profanity_ratio")
    return raw_text_stats(d, "text", tuple(cols)) if cfg.use_raw_feats else d.select(*cols)


def prepare(docs: DataFrame, cfg: FeatureConfig, cues: DataFrame | None, lemmas: DataFrame | None) -> DataFrame:
    """The one pass over the corpus: the keyed rows, written and read back."""
    d = docs.select("doc_id", "text", "label")
    d = text_columns(d.withColumn("row_hash", row_hash(d)), cfg, cues, lemmas).drop("text").withColumn("key", hash_key(cfg.seed))
    return written(d, "corpus")


def term_arrays(rows: DataFrame, p: TfidfParams, keep=()) -> tuple[DataFrame, object]:
    """(rows hash-partitioned by document with the arrays that n-grams come from, the
    array of all n-grams). The longest char n-grams become a column, so that one regex
    pass feeds every shorter n as well."""
    d = rows.select("doc_id", *keep, "wtok", "norm").repartition("doc_id")
    d = d.select("doc_id", *keep, "wtok", "norm", char_kgrams("norm", p.char_ngrams[1]).alias("ctop"))
    return d, block_terms(F.col("wtok"), F.col("norm"), p, F.col("ctop"))


def _dense_names(cfg: FeatureConfig, cues: DataFrame | None) -> list[str]:
    """Raw statistics and profanity ratio (F12, F13): the columns beside the TF-IDF blocks."""
    names = list(STAT_COLUMNS) if cfg.use_raw_feats else []
    return names + ["profanity_ratio"] if cfg.use_profanity_ratio and cues is not None else names


def _dense(names: list[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in names]) if names else F.array().cast("array<double>")


_SPLITS = ("train", "val", "test")


def _tags(plan) -> tuple[Column, Callable[[DataFrame], DataFrame]]:
    """(label, split and fold as one integer, the way back to the columns). The classes
    are those that the split plan counted."""
    classes = sorted(plan.counts)
    label = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("label")).cast("int") - 1
    split = F.when(F.col("split") == "train", 0).when(F.col("split") == "val", 1).otherwise(2)
    tag = (label * 3 + split) * (MAX_FOLD_NUMBER + 1) + F.coalesce(F.col("fold"), F.lit(MAX_FOLD_NUMBER))

    def untag(df: DataFrame) -> DataFrame:
        rest, fold = F.expr(f"tag div {MAX_FOLD_NUMBER + 1}").cast("int"), F.col("tag") % (MAX_FOLD_NUMBER + 1)
        at = F.expr(f"tag div {3 * (MAX_FOLD_NUMBER + 1)}").cast("int")
        return df.withColumns({"label": F.element_at(F.array(*[F.lit(c) for c in classes]), at + 1),
                               "split": F.element_at(F.array(*[F.lit(x) for x in _SPLITS]), rest % 3 + 1),
                               "fold": F.when(fold < MAX_FOLD_NUMBER, fold.cast("int"))}).drop("tag")
    return tag.cast("int"), untag


def _in_train(tag: Column) -> Column:
    return F.floor(tag / (MAX_FOLD_NUMBER + 1)) % 3 == 0


def _split_rows(docs: DataFrame, cfg: FeatureConfig, cues: DataFrame | None, lemmas: DataFrame | None):
    """(the keyed rows, the split plan, the rows with label, split and fold)."""
    rows = prepare(docs, cfg, cues, lemmas)
    plan = plan_split(rows, cfg.seed, cfg.test_size, cfg.valid_size, cfg.folds, hashed="key")
    return rows, plan, assign_split(rows, plan, hashed="key")


def block_frequencies(docs: DataFrame, cfg: FeatureConfig, block: int, lemmas: DataFrame | None = None) -> DataFrame:
    """``(block, term, df, ttf)`` of the terms of one block's vocabulary, over the train texts."""
    _, _, d = _split_rows(docs, cfg, None, lemmas)
    counts = term_counts(d.where(F.col("split") == "train"), cfg.tfidf, (block,))
    return kept_terms(counts, cfg.tfidf, (block,))


def build_features(docs: DataFrame, cfg: FeatureConfig = FeatureConfig(), cues: DataFrame | None = None,
                   lemmas: DataFrame | None = None) -> FeatureSet:
    """``docs`` = ``(doc_id, text, label)``."""
    rows, plan, d = _split_rows(docs, cfg, cues, lemmas)
    keys = d.select("doc_id", *KEEP)
    in_train = F.col("split") == "train"

    # Raw statistics and profanity ratio (F12, F13) go along with a document, as do its
    # label, split and fold, as one number.
    p = cfg.tfidf
    names = _dense_names(cfg, cues)
    tags, untag = _tags(plan)
    tagged = d.withColumns({"tag": tags, "dense": _dense(names)})

    # TF-IDF blocks (F1-F11)
    n_train = sum(n_test_val[2] for n_test_val in plan.sizes.values())
    vocab = index_vocab(term_counts(d.where(in_train), p), n_train, p)
    n_terms = vocab.count()
    width = n_terms + len(names)

    weighed = cache(lambda: Weighed(tagged, vocab, p))

    def every_weight() -> DataFrame:
        every = {j: n_terms + j for j in range(len(names))}
        plain = untag(document_rows(weighed()))
        return plain.withColumns({"terms": _pairs(), "pairs": F.concat(_pairs(), _dense_pairs(every))})

    selected, scores, size = None, None, width
    if cfg.selection:
        priors = class_priors(keys.where(in_train))
        classes = F.array(*[F.lit(c) for c in sorted(plan.counts)])
        # train is the first split of a tag
        sums = class_sums(weighed(), len(_SPLITS) * (MAX_FOLD_NUMBER + 1), MAX_FOLD_NUMBER + 1)
        sums = sums.select("idx", F.element_at(classes, F.col("class") + 1).alias("label"), "w")
        if names:
            sums = sums.unionByName(dense_block_long(d.where(in_train), names, n_terms, keep=("label",)).select("idx", "label", "w"))
        # one row per feature, read by the quantile cut and the top-k
        scores = chi2_scores(sums, priors).persist(StorageLevel.MEMORY_AND_DISK)
        # k rows at most: kept, so the size check and the projection share it
        selected = top_k(scores, min(cfg.k_best, width), digits=cfg.rank_digits).persist()
        size = min(cfg.k_best, width)
        new = selected.select(F.col("old_idx").alias("idx"), F.col("new_idx"))
        places = {r.idx - n_terms: r.new_idx for r in new.where(F.col("idx") >= n_terms).collect()}
        packed = untag(document_rows(weighed(), new))
        # features beside the terms have the highest numbers, so indices stay ascending
        packed = packed.withColumn("pairs", F.concat(_pairs(), _dense_pairs(places)))
    else:
        packed = every_weight()

    def stored_postings() -> DataFrame:
        d_w, terms = term_arrays(tagged, p, ("tag",))
        characters = d.where(in_train).agg(F.sum(F.length("norm"))).first()[0] or 0
        kept = rare_terms_filter(d_w.where(_in_train(F.col("tag"))), terms, p, characters)
        return untag(postings(d_w, terms, keep=("tag",), kept=kept))

    return FeatureSet(long=_long_rows(packed, F.col("pairs")), docs=keys, vocab=vocab, selected=selected, content=content_sums(rows, "row_hash"),
                      n_features=width, size=size, n_terms=n_terms, pairs=packed,
                      make_weights=every_weight, make_postings=stored_postings,
                      persisted=[selected, scores] if selected is not None else [])


def _pairs() -> Column:
    """The weights of a row of ``document_rows`` as one array of ``(idx, w)``."""
    return F.arrays_zip(F.col("indices").alias("idx"), F.col("values").alias("w")).cast("array<struct<idx:bigint,w:double>>")


def _dense_pairs(places: dict[int, int]) -> Column:
    """``(idx, w)`` of the values of ``dense`` that are not 0: the one at j under ``places[j]``."""
    cells = [F.struct(F.lit(places[j]).cast("long").alias("idx"), F.col("dense")[j].alias("w")) for j in sorted(places)]
    return F.filter(F.array(*cells), lambda s: s["w"] != 0.0) if cells else F.array().cast("array<struct<idx:bigint,w:double>>")


def _long_rows(docs: DataFrame, pairs: Column) -> DataFrame:
    return docs.select("doc_id", *KEEP, F.explode(pairs).alias("p")).select("doc_id", *KEEP, "p.idx", "p.w")


def transform_texts(docs: DataFrame, path: str) -> DataFrame:
    """Features of new texts with a stored fit (raw-text scoring mode):
    ``docs`` = ``(doc_id, text)``; terms outside the stored vocabulary are
    dropped; idf, offsets, selection, toggles, lexicon and lemmas are those of the
    store. Returns packed rows ``(doc_id, features)`` of the stored width, one for each
    row of ``docs``, also where rows share an id or have none."""
    spark = docs.sparkSession
    meta = json.loads(spark.read.text(os.path.join(path, "_manifest")).first().value)
    params = meta["params"]
    cfg = FeatureConfig.from_dict(params["features"])
    cues = cues_frame(spark, params["lexicon"]) if params.get("lexicon") else None
    lemmas = lemma_frame(spark, [tuple(x) for x in params["lemmas"]]) if params.get("lemmas") else None
    vocab = spark.read.parquet(os.path.join(path, "vocab"))
    d = text_columns(spread(docs.select("doc_id", "text")), cfg, cues, lemmas)
    names = _dense_names(cfg, cues)
    weighed = Weighed(d.withColumns({"tag": F.lit(0), "dense": _dense(names)}), vocab, cfg.tfidf)
    new, places = None, {j: meta["n_terms"] + j for j in range(len(names))}
    if cfg.selection:
        new = spark.read.parquet(os.path.join(path, "selected")).select(F.col("old_idx").alias("idx"), "new_idx")
        places = {r.idx - meta["n_terms"]: r.new_idx for r in new.where(F.col("idx") >= meta["n_terms"]).collect()}
    packed = document_rows(weighed, new).withColumn("pairs", F.concat(_pairs(), _dense_pairs(places)))
    return packed.select("doc_id", sparse_vector("pairs", meta["size"]).alias("features"))
