"""Registered queries (Spark) and their DuckDB statements (oracle).

Each query reads the given tables (or data Spark derives from them) in full;
its oracle statement computes the same columns under the same names, doubles
rounded to 6 places, over the same views.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.charclass import sql_literal
from ..functions.normalize import alpha_tokens_sql, normalise, normalise_ctes, with_stripped_accents
from ..functions.stats import STAT_COLUMNS, raw_text_stats, raw_text_stats_sql
from ..operators.lexicon import lexicon_flag, profanity_ratio
from ..operators.metrics import (auc_summary, average_precision, class_report, confusion,
                                 pr_curve, roc_auc, roc_curve)
from ..operators.split import stratified_split, split_sql
from ..operators.common import spread
from ..sources.io import cues_frame, read_labelled, table

# The lexicon fixtures (FIXTURES §2).
LEXICON_WORDS = ("trash", "clown", "scum", "idiot", "worthless", "pathetic", "moron",
                 "loser", "disgusting", "stupid")
LEXICON_PHRASES = ("the moron", "of trash")
# The lemma fixture.
LEMMAS = (("things", "thing"), ("idiots", "idiot"), ("was", "be"), ("are", "be"),
          ("losers", "loser"))

SEED = 1337
D = 6  # rounding of compared doubles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def rnd(c: str, alias: str | None = None):
    return F.round(F.col(c), D).alias(alias or c)


LAB_Q = ("SELECT d.doc_id, d.text, CAST(l.toxic AS INTEGER) AS label "
         "FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
LAB = f"lab AS ({LAB_Q})"
LAB_SUB = f"({LAB_Q}) lab"


def _words_sql(vals) -> str:
    return "[" + ", ".join(sql_literal(v) for v in vals) + "]"


# ----------------------------------------------------------------- scans
@query("scan_labelled", f"WITH {LAB} SELECT doc_id, text, label FROM lab")
def q_scan_labelled(spark, sf):
    return read_labelled(spark, sf)


# ----------------------------------------------------------- projections
@query("normalise_text",
       f"WITH {normalise_ctes('n', 'documents', 'doc_id', 'text')} "
       "SELECT doc_id, md5(norm) AS norm_md5, length(norm) AS norm_len FROM n")
def q_normalise_text(spark, sf):
    n = spread(table(spark, sf, "documents")).select("doc_id", normalise("text").alias("norm"))
    return n.select("doc_id", F.md5("norm").alias("norm_md5"), F.length("norm").alias("norm_len"))


@query("raw_text_stats", raw_text_stats_sql("documents", "text", "doc_id", D))
def q_raw_text_stats(spark, sf):
    s = raw_text_stats(spread(table(spark, sf, "documents")), "text", ("doc_id",))
    return s.select("doc_id", *[rnd(c) for c in STAT_COLUMNS])


@query("accent_fold",
       "SELECT doc_id, md5(strip_accents(coalesce(text, ''))) AS plain_md5, "
       "length(strip_accents(coalesce(text, ''))) AS plain_len FROM documents")
def q_accent_fold(spark, sf):
    d = with_stripped_accents(spread(table(spark, sf, "documents")), "text", "plain")
    return d.select("doc_id", F.md5("plain").alias("plain_md5"), F.length("plain").alias("plain_len"))


# --------------------------------------------------------------- lexicon
def _flag_sql(words, phrases) -> str:
    hit = []
    if words:
        hit.append(f"list_has_any(tok, {_words_sql(words)})")
    if phrases:
        hit.append("list_has_any(list_transform(range(1, len(tok)), lambda i: tok[i] || ' ' || tok[i + 1]), "
                   f"{_words_sql(phrases)})")
    cond = " OR ".join(hit) or "false"
    return (f"WITH {LAB}, {normalise_ctes('n', 'lab', 'doc_id, label', 'text')}, "
            "t AS (SELECT doc_id, label, list_filter(string_split(norm, ' '), lambda x: x <> '') AS tok FROM n) "
            f"SELECT doc_id, label, CAST(CASE WHEN {cond} THEN 1.0 ELSE 0.0 END AS DOUBLE) AS p1, "
            f"CASE WHEN {cond} THEN 1 ELSE 0 END AS prediction FROM t")


def _flagged(spark, sf, cues):
    return lexicon_flag(read_labelled(spark, sf), cues_frame(spark, cues))


@query("lexicon_flag", _flag_sql(LEXICON_WORDS, ()))
def q_lexicon_flag(spark, sf):
    return _flagged(spark, sf, LEXICON_WORDS).select("doc_id", "label", "p1", "prediction")


@query("lexicon_phrase_flag", _flag_sql((), LEXICON_PHRASES))
def q_lexicon_phrase_flag(spark, sf):
    return _flagged(spark, sf, LEXICON_PHRASES).select("doc_id", "label", "p1", "prediction")


RATIO_SQL = (f"WITH {LAB}, {normalise_ctes('n', 'lab', 'doc_id, label', 'text')}, "
             f"a AS (SELECT doc_id, label, {alpha_tokens_sql('norm')} AS tok FROM n) "
             "SELECT doc_id, label, round(CASE WHEN len(tok) = 0 THEN 0.0 ELSE "
             f"len(list_filter(tok, lambda x: list_contains({_words_sql(LEXICON_WORDS)}, x))) / len(tok) END, {D}) "
             "AS profanity_ratio FROM a")


def _ratio(spark, sf):
    d = read_labelled(spark, sf).withColumn("norm", normalise("text"))
    return profanity_ratio(d, cues_frame(spark, LEXICON_WORDS)).select(
        "doc_id", "label", rnd("profanity_ratio"))


@query("profanity_ratio", RATIO_SQL)
def q_profanity_ratio(spark, sf):
    return _ratio(spark, sf)


# ---------------------------------------------------------------- splits
@query("stratified_split", split_sql(LAB_SUB, SEED))
def q_stratified_split(spark, sf):
    return stratified_split(read_labelled(spark, sf), seed=SEED).select("doc_id", "label", "split", "fold")


@query("split_counts",
       f"WITH s AS ({split_sql(LAB_SUB, SEED)}) "
       "SELECT split, label, count(*) AS n FROM s GROUP BY split, label")
def q_split_counts(spark, sf):
    s = stratified_split(read_labelled(spark, sf), seed=SEED)
    return s.groupBy("split", "label").agg(F.count("*").alias("n"))


@query("stratified_folds",
       f"WITH s AS ({split_sql(LAB_SUB, SEED)}) "
       "SELECT fold, label, count(*) AS n FROM s WHERE split = 'train' GROUP BY fold, label")
def q_stratified_folds(spark, sf):
    s = stratified_split(read_labelled(spark, sf), seed=SEED).where(F.col("split") == "train")
    return s.groupBy("fold", "label").agg(F.count("*").alias("n"))


# --------------------------------------------------------------- metrics
BASE_SQL = _flag_sql(LEXICON_WORDS, LEXICON_PHRASES)


def _baseline(spark, sf):
    return _flagged(spark, sf, LEXICON_WORDS + LEXICON_PHRASES)


@query("confusion",
       f"WITH b AS ({BASE_SQL}), g AS (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(label, prediction)) "
       "SELECT g.label, g.prediction, CAST(count(b.doc_id) AS BIGINT) AS n FROM g LEFT JOIN b "
       "ON g.label = b.label AND g.prediction = b.prediction GROUP BY g.label, g.prediction")
def q_confusion(spark, sf):
    return confusion(_baseline(spark, sf))


def _report_sql(source: str) -> str:
    return (
        f"WITH b AS ({source}), c AS (SELECT "
        "CAST(count(*) FILTER (WHERE label = 0 AND prediction = 0) AS DOUBLE) AS tn, "
        "CAST(count(*) FILTER (WHERE label = 0 AND prediction = 1) AS DOUBLE) AS fp, "
        "CAST(count(*) FILTER (WHERE label = 1 AND prediction = 0) AS DOUBLE) AS fn, "
        "CAST(count(*) FILTER (WHERE label = 1 AND prediction = 1) AS DOUBLE) AS tp FROM b), "
        "m AS (SELECT *, tn + fp + fn + tp AS n, "
        "CASE WHEN tn + fn = 0 THEN 0 ELSE tn / (tn + fn) END AS p0, CASE WHEN tn + fp = 0 THEN 0 ELSE tn / (tn + fp) END AS r0, "
        "CASE WHEN 2 * tn + fp + fn = 0 THEN 0 ELSE 2 * tn / (2 * tn + fp + fn) END AS f0, tn + fp AS s0, "
        "CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS p1, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS r1, "
        "CASE WHEN 2 * tp + fn + fp = 0 THEN 0 ELSE 2 * tp / (2 * tp + fn + fp) END AS f1, tp + fn AS s1 FROM c) "
        f"SELECT 'non-toxic' AS row, round(p0, {D}) AS precision, round(r0, {D}) AS recall, round(f0, {D}) AS f1, CAST(s0 AS BIGINT) AS support FROM m "
        f"UNION ALL SELECT 'toxic', round(p1, {D}), round(r1, {D}), round(f1, {D}), CAST(s1 AS BIGINT) FROM m "
        f"UNION ALL SELECT 'accuracy', NULL, NULL, round(CASE WHEN n = 0 THEN 0 ELSE (tn + tp) / n END, {D}), CAST(n AS BIGINT) FROM m "
        f"UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, {D}), round((r0 + r1) / 2, {D}), round((f0 + f1) / 2, {D}), CAST(n AS BIGINT) FROM m "
        f"UNION ALL SELECT 'weighted avg', round((p0 * s0 + p1 * s1) / n, {D}), round((r0 * s0 + r1 * s1) / n, {D}), "
        f"round((f0 * s0 + f1 * s1) / n, {D}), CAST(n AS BIGINT) FROM m")


def _report_cols(df):
    return df.select("row", rnd("precision"), rnd("recall"), rnd("f1"), "support")


@query("class_report", _report_sql(BASE_SQL))
def q_class_report(spark, sf):
    return _report_cols(class_report(_baseline(spark, sf)))


BASE_TEST_SQL = (f"WITH s AS ({split_sql(LAB_SUB, SEED)}), f AS ({BASE_SQL}) "
                 "SELECT f.* FROM f JOIN s ON f.doc_id = s.doc_id WHERE s.split = 'test'")


@query("baseline_test_report", _report_sql(BASE_TEST_SQL))
def q_baseline_test_report(spark, sf):
    b = stratified_split(_baseline(spark, sf), seed=SEED)
    return _report_cols(class_report(b.where(F.col("split") == "test")))


# ---------------------------------------------------------------- curves
def _scored(spark, sf):
    return _ratio(spark, sf).withColumnRenamed("profanity_ratio", "score")


PTS_SQL = (f"WITH r AS ({RATIO_SQL}), g AS (SELECT profanity_ratio AS score, "
           "sum(label) AS pos, sum(1 - label) AS neg FROM r GROUP BY 1), "
           "c AS (SELECT *, sum(pos) OVER w AS tps, sum(neg) OVER w AS fps, "
           "row_number() OVER (ORDER BY score DESC) AS rk, "
           "lead(pos) OVER (ORDER BY score DESC) AS next_pos, lead(neg) OVER (ORDER BY score DESC) AS next_neg, "
           "sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM g "
           "WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))")


@query("roc_curve",
       f"{PTS_SQL} SELECT CAST('inf' AS DOUBLE) AS threshold, 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr "
       f"UNION ALL SELECT score, round(fps / N, {D}), round(tps / P, {D}) FROM c "
       "WHERE rk = 1 OR next_pos IS NULL OR pos <> next_pos OR neg <> next_neg")
def q_roc_curve(spark, sf):
    return roc_curve(_scored(spark, sf)).select("threshold", rnd("fpr"), rnd("tpr"))


@query("pr_curve",
       f"{PTS_SQL} SELECT score AS threshold, round(tps / (tps + fps), {D}) AS precision, "
       f"round(tps / P, {D}) AS recall FROM c UNION ALL SELECT NULL, 1.0, 0.0")
def q_pr_curve(spark, sf):
    return pr_curve(_scored(spark, sf)).select("threshold", rnd("precision"), rnd("recall"))


@query("roc_auc", f"{PTS_SQL} SELECT round(sum(neg * (tps - pos + pos / 2.0)) / (sum(pos) * sum(neg)), {D}) AS roc_auc FROM c")
def q_roc_auc(spark, sf):
    return roc_auc(_scored(spark, sf)).select(rnd("roc_auc"))


@query("avg_precision", f"{PTS_SQL} SELECT round(sum(pos * tps / (tps + fps)) / sum(pos), {D}) AS avg_precision FROM c")
def q_avg_precision(spark, sf):
    return average_precision(_scored(spark, sf)).select(rnd("avg_precision"))


@query("auc_summary",
       f"{PTS_SQL} SELECT round(sum(neg * (tps - pos + pos / 2.0)) / (sum(pos) * sum(neg)), {D}) AS roc_auc, "
       f"round(sum(pos * tps / (tps + fps)) / sum(pos), {D}) AS pr_auc FROM c")
def q_auc_summary(spark, sf):
    return auc_summary(_scored(spark, sf)).select(rnd("roc_auc"), rnd("pr_auc"))


# ------------------------------------------------------- TF-IDF and chi2
from dataclasses import replace  # noqa: E402

from .feature_sql import feature_ctes  # noqa: E402
from .features import FeatureConfig, block_frequencies, build_features  # noqa: E402
from ..sources.io import lemma_frame  # noqa: E402

K_BEST = 2000
FEAT_CFG = FeatureConfig(seed=SEED, k_best=K_BEST, rank_digits=D)
FEAT_CTES = feature_ctes(LAB_Q, SEED, LEMMAS, LEXICON_WORDS, K_BEST)


def _features(spark, sf, selection: bool = True, dense: bool = True):
    """The feature job; queries whose output does not depend on the chi2 selection or
    the dense blocks leave them out."""
    cfg = FEAT_CFG if selection else replace(FEAT_CFG, selection=False)
    cfg = cfg if dense else replace(cfg, use_raw_feats=False, use_profanity_ratio=False)
    return build_features(read_labelled(spark, sf), cfg, cues_frame(spark, LEXICON_WORDS),
                          lemma_frame(spark, LEMMAS))


def _block_df(block):
    return (f"WITH {FEAT_CTES} SELECT term, df, ttf FROM dfs WHERE block = {block} AND df >= 3")


def _spark_block_df(spark, sf, block):
    """df and ttf over the train texts, of the block's vocabulary."""
    cfg = replace(FEAT_CFG, selection=False, use_raw_feats=False, use_profanity_ratio=False)
    return block_frequencies(read_labelled(spark, sf), cfg, block, lemma_frame(spark, LEMMAS)).select("term", "df", "ttf")


@query("word_ngrams_df", _block_df(0))
def q_word_ngrams_df(spark, sf):
    return _spark_block_df(spark, sf, 0)


@query("char_ngrams_df", _block_df(1))
def q_char_ngrams_df(spark, sf):
    return _spark_block_df(spark, sf, 1)


@query("vocab_index", f"WITH {FEAT_CTES} SELECT block, term, CAST(idx AS BIGINT) AS idx, df, round(idf, {D}) AS idf FROM vocab")
def q_vocab_index(spark, sf):
    return _features(spark, sf, selection=False, dense=False).vocab.select("block", "term", "idx", "df", rnd("idf"))


@query("tfidf_union", f"WITH {FEAT_CTES} SELECT doc_id, CAST(idx AS BIGINT) AS idx, round(w, {D}) AS w FROM tfidf")
def q_tfidf_union(spark, sf):
    return _features(spark, sf, selection=False, dense=False).tfidf.select("doc_id", "idx", rnd("w"))


@query("assembled_features", f"WITH {FEAT_CTES} SELECT doc_id, CAST(idx AS BIGINT) AS idx, round(w, {D}) AS w FROM feat")
def q_assembled_features(spark, sf):
    return _features(spark, sf, selection=False).assembled.select("doc_id", "idx", rnd("w"))


@query("chi2_topk", f"WITH {FEAT_CTES} SELECT CAST(old_idx AS BIGINT) AS old_idx, CAST(new_idx AS BIGINT) AS new_idx, "
       f"round(chi2, {D}) AS chi2 FROM sel")
def q_chi2_topk(spark, sf):
    """The selection as saved by the feature store (built if missing)."""
    path, _, _ = feature_store(spark, sf)
    return spark.read.parquet(path + "/selected").select("old_idx", "new_idx", rnd("chi2"))


@query("selected_features", f"WITH {FEAT_CTES} SELECT doc_id, CAST(idx AS BIGINT) AS idx, round(w, {D}) AS w FROM fsel")
def q_selected_features(spark, sf):
    return _features(spark, sf).long.select("doc_id", "idx", rnd("w"))


# ------------------------------------------------ store, models, errors
from ..operators.errors import error_samples  # noqa: E402
from ..operators.models import ModelSpec, class_weights, fit, scores  # noqa: E402
from ..operators.split import plan_split, assign_split  # noqa: E402
from ..session import ensure_checkpoint_dir, written  # noqa: E402
from ..sources.store import load_features, materialise, md5_prefix_signature  # noqa: E402


def store_base(spark) -> str:
    """Where feature sets are kept: the shared folder named in ``spark.textlab.store.dir``,
    which outlives a session, or else a part of the session's checkpoint folder."""
    kept = spark.conf.get("spark.textlab.store.dir", None)
    return (kept or ensure_checkpoint_dir(spark)).rstrip("/") + "/textlab-store"


def feature_store(spark, sf, cfg=FEAT_CFG):
    """Materialised features of the labelled comments (built once per
    signature of parameters and inputs)."""
    docs = read_labelled(spark, sf)
    cues, lemmas = cues_frame(spark, LEXICON_WORDS), lemma_frame(spark, LEMMAS)
    params = {"features": cfg.as_dict(), "lexicon": sorted(LEXICON_WORDS), "lemmas": sorted(LEMMAS)}
    return materialise(spark, store_base(spark), params, {"labelled": docs},
                       lambda: build_features(docs, cfg, cues, lemmas))


@query("materialise_roundtrip", f"WITH {FEAT_CTES} SELECT doc_id, CAST(idx AS BIGINT) AS idx, round(w, {D}) AS w FROM fsel")
def q_materialise_roundtrip(spark, sf):
    path, _, _ = feature_store(spark, sf)
    f = spark.read.parquet(path + "/features")
    iv = F.arrays_zip(F.col("features.indices").alias("i"), F.col("features.values").alias("v"))
    return (f.select("doc_id", F.explode(iv).alias("e"))
            .select("doc_id", F.col("e.i").cast("long").alias("idx"), F.round("e.v", D).alias("w")))


@query("input_signature",
       "SELECT count(*) AS rows, sum(CAST(('0x' || substr(md5(coalesce(text, '')), 1, 8)) AS BIGINT)) AS md5_sum FROM documents")
def q_input_signature(spark, sf):
    return md5_prefix_signature(table(spark, sf, "documents"), "text")


@query("class_weights",
       f"WITH s AS ({split_sql(LAB_SUB, SEED)}), t AS (SELECT label, count(*) AS n FROM s WHERE split = 'train' GROUP BY label) "
       f"SELECT label, n, round((SELECT sum(n) FROM t) / (2.0 * n), {D}) AS weight FROM t")
def q_class_weights(spark, sf):
    s = stratified_split(read_labelled(spark, sf), seed=SEED).where(F.col("split") == "train")
    w = class_weights(s)
    counts = s.groupBy("label").agg(F.count("*").alias("n"))
    expr = F.lit(None).cast("double")
    for c, v in w.items():
        expr = F.when(F.col("label") == c, F.lit(v)).otherwise(expr)
    return counts.select("label", "n", F.round(expr, D).alias("weight"))


ERR_THRESHOLD, ERR_K = 0.05, 3


@query("error_topk",
       f"WITH sp AS ({split_sql(LAB_SUB, SEED)}), r AS ({RATIO_SQL}), lab AS ({LAB_Q}), "
       f"v AS (SELECT r.doc_id AS idx, r.label AS y_true, CASE WHEN r.profanity_ratio >= {ERR_THRESHOLD} THEN 1 ELSE 0 END AS y_pred, "
       f"r.profanity_ratio AS score FROM r JOIN sp ON r.doc_id = sp.doc_id WHERE sp.split = 'val'), "
       "e AS (SELECT CASE WHEN y_true = 0 THEN 'fp' ELSE 'fn' END AS kind, *, "
       f"row_number() OVER (PARTITION BY y_true ORDER BY abs(score - {ERR_THRESHOLD}) DESC, idx) AS rk "
       "FROM v WHERE y_true <> y_pred) "
       "SELECT kind, y_true, y_pred, score, idx, text, CASE WHEN length(replace(text, chr(10), ' ')) > 240 "
       "THEN substr(replace(text, chr(10), ' '), 1, 240) || '…' ELSE replace(text, chr(10), ' ') END AS snippet "
       f"FROM e JOIN lab ON e.idx = lab.doc_id WHERE rk <= {ERR_K}")
def q_error_topk(spark, sf):
    # three numbers a row, written: the split's passes and both kinds of error read those, not the texts
    scored = written(_scored(spark, sf), "scored")
    r = stratified_split(scored, seed=SEED).where(F.col("split") == "val")
    return error_samples(r, read_labelled(spark, sf), ERR_THRESHOLD, ERR_K)


def model_scores(spark, sf, spec: ModelSpec, split: str = "test", stored=None):
    """``stored``: what ``feature_store`` gave, where several models share it."""
    path, _, _ = stored or feature_store(spark, sf)
    model = fit(load_features(spark, path, "train"), spec)
    return scores(model, load_features(spark, path, split))


@query("logreg_scores")
def q_logreg_scores(spark, sf):
    return model_scores(spark, sf, ModelSpec("logreg"))


@query("svm_scores")
def q_svm_scores(spark, sf):
    return model_scores(spark, sf, ModelSpec("lsvc"))


from ..operators.passive_aggressive import PAParams, fit_pa, pa_scores  # noqa: E402


def passive_aggressive_scores(spark, sf, stored=None):
    """Margins of the passive-aggressive model on the test split."""
    path, manifest, _ = stored or feature_store(spark, sf)
    raw = spark.read.parquet(path + "/features")
    weights = fit_pa(raw.where(F.col("split") == "train"), manifest["size"], PAParams())
    return pa_scores(raw.where(F.col("split") == "test"), weights, manifest["size"])


@query("pa_scores")
def q_pa_scores(spark, sf):
    return passive_aggressive_scores(spark, sf)


from ..operators.errors import default_threshold  # noqa: E402
from ..operators.squared_hinge import fit_squared_hinge  # noqa: E402


def squared_hinge_scores(spark, sf, split: str = "test", stored=None):
    """Margins of the squared-hinge SVM fitted on the train split."""
    path, manifest, _ = stored or feature_store(spark, sf)
    raw = spark.read.parquet(path + "/features")
    weights = fit_squared_hinge(raw.where(F.col("split") == "train"), manifest["size"])
    return pa_scores(raw.where(F.col("split") == split), weights, manifest["size"])


@query("svm_squared_scores")
def q_svm_squared_scores(spark, sf):
    return squared_hinge_scores(spark, sf)


@query("model_errors")
def q_model_errors(spark, sf):
    """The surest wrong decisions of the squared-hinge SVM on the val split."""
    return error_samples(squared_hinge_scores(spark, sf, "val"), read_labelled(spark, sf),
                         default_threshold("lsvc"), ERR_K)


from ..operators.tune import cv_search  # noqa: E402

CV_ITER = 15


def train_rows(spark, sf):
    """The stored train rows in both typings, and the number of features."""
    path, manifest, _ = feature_store(spark, sf)
    rows = spark.read.parquet(path + "/features").where(F.col("split") == "train")
    return rows, load_features(spark, path, "train"), manifest["size"]


@query("cv_search")
def q_cv_search(spark, sf):
    _, results = cv_search(*train_rows(spark, sf), ModelSpec("logreg"), n_iter=CV_ITER, seed=SEED, parallelism=6)
    return results


from .scoring import save_scorer, weight_table  # noqa: E402
from ..session import scratch_dir  # noqa: E402


def text_scorer(spark, sf, spec: ModelSpec = ModelSpec("logreg")):
    """A saved and loaded raw-text scorer of the stored features and a model fitted on train."""
    path, _, _ = feature_store(spark, sf)
    model = fit(load_features(spark, path, "train"), spec)
    return save_scorer(path, weight_table(spark, model), "logistic" if spec.name == "logreg" else "identity",
                       scratch_dir(spark, "scorer"))


@query("score_texts")
def q_score_texts(spark, sf):
    """All documents, labelled or not, through the saved logistic scorer."""
    return text_scorer(spark, sf).transform(table(spark, sf, "documents"))


def evaluated_models(spark, sf):
    """``{model: scored test rows}`` of the three models, each with its default spec; the
    store looks at the comments once for all of them."""
    stored = feature_store(spark, sf)
    return {"logreg": model_scores(spark, sf, ModelSpec("logreg"), stored=stored),
            "lsvc": squared_hinge_scores(spark, sf, stored=stored), "pac": passive_aggressive_scores(spark, sf, stored)}


@query("model_report")
def q_model_report(spark, sf):
    """The classification report of each model on the test split."""
    parts = [_report_cols(class_report(s)).withColumn("model", F.lit(m)) for m, s in evaluated_models(spark, sf).items()]
    return reduce(DataFrame.unionByName, parts)


@query("model_areas")
def q_model_areas(spark, sf):
    """ROC-AUC and average precision of each model on the test split."""
    parts = [auc_summary(s).withColumn("model", F.lit(m)) for m, s in evaluated_models(spark, sf).items()]
    return reduce(DataFrame.unionByName, parts).select("model", rnd("roc_auc"), rnd("pr_auc"))


from ..streaming.flags import run_flag_stream  # noqa: E402


@query("stream_lexicon_flag",
       f"WITH {normalise_ctes('n', 'documents', 'doc_id', 'text')}, "
       "t AS (SELECT doc_id, list_filter(string_split(norm, ' '), lambda x: x <> '') AS tok FROM n) "
       f"SELECT doc_id, CASE WHEN list_has_any(tok, {_words_sql(LEXICON_WORDS)}) THEN 1.0 ELSE 0.0 END AS p1, "
       f"CASE WHEN list_has_any(tok, {_words_sql(LEXICON_WORDS)}) THEN 1 ELSE 0 END AS prediction FROM t")
def q_stream_lexicon_flag(spark, sf):
    """All documents flagged by a Structured Streaming run over the table."""
    import os
    src = os.path.join(sf, "documents.parquet")
    out = run_flag_stream(spark, src, cues_frame(spark, LEXICON_WORDS))
    return spark.read.parquet(out).select("doc_id", "p1", "prediction")
