"""Paths for large inputs against their small-input twins and plain versions."""

import hashlib
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from paths import SF001
from textlab.operators import metrics, split, tfidf, wide_linear
from textlab.operators.models import ModelSpec
from textlab.operators.passive_aggressive import PAParams, fit_pa, pa_scores
from textlab.operators.squared_hinge import fit_squared_hinge
from textlab.operators.tfidf import TfidfParams, document_frequencies, fit_vocab, postings, rare_terms_filter, weigh
from textlab.plans.features import FeatureConfig, build_features, prepare, text_columns
from textlab.sources.io import cues_frame, lemma_frame, read_labelled
from textlab.sources.store import content_signature, content_sums, materialise


# ------------------------------------------------------------ feature job
def test_feature_job_reads_each_table_once(spark):
    docs = read_labelled(spark, SF001)
    rows = prepare(docs, FeatureConfig(), cues_frame(spark, ["idiot"]), None)
    plan = text_columns(docs, FeatureConfig(), cues_frame(spark, ["idiot"]), None)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2 and "documents" in plan and "labels" in plan
    assert dict(rows.groupBy("label").count().collect()) == dict(docs.groupBy("label").count().collect())
    looked_up = content_signature(docs)
    assert {"columns": docs.columns, **content_sums(rows, "row_hash")} == looked_up
    again = prepare(docs.repartition(3), FeatureConfig(use_raw_feats=False, use_profanity_ratio=False), None, None)
    assert {"columns": docs.columns, **content_sums(again, "row_hash")} == looked_up


def test_store_files_under_the_rows_that_were_read(spark, tmp_path):
    """A table that changes after the look-up is filed under its new content."""
    docs = read_labelled(spark, SF001)
    cfg = FeatureConfig(k_best=50, use_raw_feats=False, use_profanity_ratio=False)
    params, fewer = {"features": cfg.as_dict()}, docs.where("doc_id % 7 > 0")
    build = lambda: build_features(fewer, cfg)
    path, manifest, hit = materialise(spark, str(tmp_path), params, {"labelled": docs}, build)
    assert not hit and manifest["inputs"]["labelled"]["rows"] == fewer.count()
    assert materialise(spark, str(tmp_path), params, {"labelled": fewer}, build)[::2] == (path, True)


def test_config_survives_json():
    import json
    cfg = FeatureConfig(k_best=7, tfidf=TfidfParams(word_ngrams=(1, 3)))
    assert FeatureConfig.from_dict(json.loads(json.dumps(cfg.as_dict()))) == cfg


def _posting_rows(spark, n=400):
    """One term in every document, some frequent ones, and many that one document has."""
    rows = [(d, 0, t, 1 + d % 3) for d in range(n) for t in {"everywhere", f"mod{d % 7}", f"pair{d // 2}", f"own{d}", f"é{d % 50}"}]
    return spark.createDataFrame(rows, "doc_id long, block int, term string, tf long")


def test_hot_terms_by_broadcast_and_tail_by_shuffle(spark):
    post = _posting_rows(spark)
    vocab = fit_vocab(post, 400, TfidfParams(min_df_word=2))
    key = lambda df: sorted((r.doc_id, r.idx, round(r.w, 12)) for r in df.collect())
    want = key(weigh(post, vocab))
    assert len(want) == 400 * 4
    old = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        for adaptive in ("true", "false"):
            spark.conf.set("spark.sql.adaptive.enabled", adaptive)
            for most in (0, 60, 300, 2000):
                assert key(weigh(post, vocab, most_bytes=most)) == want
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    hot = tfidf.hot_terms(vocab.select("block", "term", "df", "idx", "idf"), 600)
    assert "everywhere" in {r.term for r in hot.collect()} and hot.count() < vocab.count()
    plan = weigh(post, vocab, most_bytes=600)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan


@pytest.mark.parametrize("least", [1, 2, 3, 8])
def test_sketch_drops_only_rare_terms(spark, least, monkeypatch):
    from textlab.operators import sketch
    monkeypatch.setattr(sketch, "WIDTH_MIN", 8)  # crowded counters
    docs = spark.createDataFrame([(d, ["all", "all", f"m{d % 20}", f"n{d % 60}", f"o{d}"]) for d in range(120)],
                                 "doc_id long, wtok array<string>")
    terms = F.transform("wtok", lambda t: F.struct(F.lit(0).alias("block"), t.alias("term")))
    params = TfidfParams(min_df_word=least, min_df_char=least, sketch_from=1)
    kept = rare_terms_filter(docs, terms, params, characters=1)
    exact = {r.term: (r.df, r.ttf) for r in document_frequencies(postings(docs, terms)).collect()}
    got = {r.term: (r.df, r.ttf) for r in document_frequencies(postings(docs, terms, kept=kept)).collect()}
    assert got.items() <= exact.items()
    assert {t for t, (df, _) in exact.items() if df >= least} <= set(got)
    if least > 1:
        assert len(got) < len(exact)


def test_features_do_not_depend_on_the_sketch(spark):
    docs = read_labelled(spark, SF001)
    cfg = FeatureConfig(k_best=500, rank_digits=6)
    sketched = replace(cfg, tfidf=TfidfParams(sketch_from=1))
    lemmas = lemma_frame(spark, [("things", "thing")])
    key = lambda fs: sorted((r.doc_id, r.idx, round(r.w, 9)) for r in fs.long.collect())
    want = key(build_features(docs, cfg, cues_frame(spark, ["idiot"]), lemmas))
    fs = build_features(docs, sketched, cues_frame(spark, ["idiot"]), lemmas)
    assert key(fs) == want
    # few terms that miss min_df have been stored
    stored = document_frequencies(fs.postings.where("split = 'train'"))
    assert stored.where("df < 3").count() < stored.count() / 10


def test_default_tokens_and_capped_vocabulary(spark):
    """Word runs of two characters or more; the most frequent terms, ties by term."""
    docs = spark.createDataFrame([(1, "a bb ccc, d_e x1 é éé"), (2, "bb bb zz"), (3, "ccc zz")], "doc_id long, norm string")
    params = TfidfParams(use_lemmatizer=False, word_ngrams=(1, 1), min_df_word=1, max_features_word=3)
    toks = tfidf.word_tokens(docs, "norm", params, None)
    assert {r.doc_id: r.wtok for r in toks.collect()}[1] == ["bb", "ccc", "d_e", "x1", "ee"]
    post = postings(toks, tfidf.block_terms(F.col("wtok"), None, params))
    vocab = {r.term: (r.idx, r.df) for r in fit_vocab(post, 3, params, blocks=(0,)).collect()}
    assert vocab == {"bb": (0, 2), "ccc": (1, 2), "zz": (2, 2)}


def test_ratio_of_a_lexicon_too_large_to_inline(spark, monkeypatch):
    from textlab.operators import lexicon
    docs = spark.createDataFrame([(1, "you idiot you scum"), (2, "fine"), (3, ""), (4, None)], "doc_id long, norm string")
    cues = cues_frame(spark, ["idiot", "scum", "of trash"])
    inline = {r.doc_id: r.profanity_ratio for r in lexicon.profanity_ratio(docs, cues).collect()}
    monkeypatch.setattr(lexicon, "INLINE_MAX_ROWS", 1)
    assert {r.doc_id: r.profanity_ratio for r in lexicon.profanity_ratio(docs, cues).collect()} == inline
    assert inline[1] == 0.5 and inline[2] == inline[3] == 0.0


# ------------------------------------------------------------------ split
def test_order_statistics_equal_sorting(spark, monkeypatch):
    ids = [(i % 3, i // 2 if i % 5 else 7) for i in range(3000)]
    df = spark.createDataFrame(ids, "g int, id long").repartition(5)
    key = split.hash_key(3, "id")
    ranked = {}
    for g, i in ids:
        ranked.setdefault(g, []).append(hashlib.md5(f"3:{i}".encode()).hexdigest())
    wanted = {g: [1, 2, len(k) // 2, len(k) - 1, len(k)] for g, k in ranked.items()}
    want = {(g, r): sorted(ranked[g])[r - 1] for g, rs in wanted.items() for r in rs}
    assert split.order_statistics(df, key, F.col("g"), wanted) == want
    monkeypatch.setattr(split, "BINS", 4)
    monkeypatch.setattr(split, "READ_KEYS", 1)
    assert split.order_statistics(df, key, F.col("g"), wanted) == want
    monkeypatch.setattr(split, "_bracket", lambda rank, n, grid: (1 << 40, 1 << 50))  # misses every rank
    assert split.order_statistics(df, key, F.col("g"), wanted) == want
    with pytest.raises(ValueError):
        split.order_statistics(df, key, F.col("g"), {0: [10_000]})


# ----------------------------------------------------------------- curves
def test_prefix_scan_ranges_are_bounded_and_exact(spark):
    rng = np.random.default_rng(4)
    label, score = (rng.random(2000) < 0.3).astype(int), np.round(rng.normal(size=2000), 2)
    df = spark.createDataFrame(list(zip(label.tolist(), score.tolist())), "label int, score double")
    pts, pos, neg = metrics.curve_points(df, bucket_rows=25)
    rows = sorted(pts.collect(), key=lambda r: -r.score)
    assert (pos, neg) == (label.sum(), 2000 - label.sum())
    for k, r in enumerate(rows):
        assert r["rank"] == k + 1 and r.tps == label[score >= r.score].sum() and r.fps == (1 - label)[score >= r.score].sum()
        assert (r.next_pos, r.next_neg) == ((rows[k + 1].pos, rows[k + 1].neg) if k + 1 < len(rows) else (None, None))


# ----------------------------------------------------------------- models
_ROWS = "doc_id long, label int, features struct<indices: array<int>, values: array<double>>"


def _random_rows(spark, n=60, width=7):
    rng = np.random.default_rng(5)
    x = np.where(rng.random((n, width)) < 0.5, rng.normal(size=(n, width)), 0.0)
    y = (x[:, 0] - x[:, 1] + 0.3 * rng.normal(size=n) > 0).astype(int)
    x[0] = 0.0  # a row without features
    rows = [(i, int(t), ([int(j) for j in np.nonzero(r)[0]], [float(v) for v in r[r != 0]]))
            for i, (r, t) in enumerate(zip(x, y))]
    return x, y, spark.createDataFrame(rows, _ROWS)


def test_wide_fit_equals_the_driver_fit(spark, monkeypatch):
    monkeypatch.setattr(wide_linear, "ROW_BLOCK", 25)
    monkeypatch.setattr(wide_linear, "FEATURE_BLOCK", 3)
    _, _, df = _random_rows(spark)
    spec = ModelSpec("lsvc", C=0.7, loss="squared_hinge", tol=1e-4, class_weight="balanced")
    near = {r.idx: r.w for r in fit_squared_hinge(df, 7, spec).collect()}
    wide = {r.idx: r.w for r in wide_linear.fit_wide(df, 7, spec).collect()}
    assert near.keys() == wide.keys() and max(abs(near[i] - wide[i]) for i in near) < 3e-3
    assert wide_linear.fit_wide(df.limit(0), 7).count() == 0


def test_wide_logistic_reaches_the_minimum(spark, monkeypatch):
    monkeypatch.setattr(wide_linear, "ROW_BLOCK", 40)
    monkeypatch.setattr(wide_linear, "FEATURE_BLOCK", 5)
    x, y, df = _random_rows(spark)
    w = np.zeros(8)
    for r in wide_linear.fit_wide(df, 7, ModelSpec("logreg", C=0.9, tol=1e-4), loss="logistic").collect():
        w[r.idx] = r.w
    x1, sign = np.c_[x, np.ones(60)], 2 * y - 1
    start = 0.9 * x1.T @ (-sign * 0.5)
    grad = w + 0.9 * x1.T @ (-sign / (1 + np.exp(sign * (x1 @ w))))
    assert np.linalg.norm(grad) <= 2e-4 * np.linalg.norm(start)
    with pytest.raises(ValueError):
        wide_linear.fit_wide(df, 7, loss="hinge")


def test_passive_aggressive_models_follow_the_rows(spark):
    _, y, df = _random_rows(spark, 90)
    params = PAParams(rows_per_model=20, max_epochs=20)
    fits = [{r.idx: round(r.w, 9) for r in fit_pa(df.repartition(n), 7, params).collect()} for n in (1, 6)]
    assert fits[0] == fits[1] and len(fits[0]) == 8
    weights = fit_pa(df, 7, params)
    right = [r.prediction == r.label for r in pa_scores(df, weights, 7).collect()]
    assert sum(right) > 75
    assert fit_pa(df.limit(0), 7).count() == 0


def test_one_shard_is_sequential_passive_aggressive(spark):
    x, y, df = _random_rows(spark, 30)
    got = np.zeros(8)
    for r in fit_pa(df, 7, PAParams(max_epochs=5, passes=5)).collect():
        got[r.idx] = r.w
    order = [r.doc_id for r in df.orderBy(F.xxhash64(F.xxhash64(F.lit(1337), "doc_id")), "doc_id").collect()]
    w = np.zeros(8)
    for _ in range(5):
        for i in order:
            v, t = np.append(x[i], 1.0), 2 * y[i] - 1
            loss = max(0.0, 1 - t * (w @ v))
            w += min(1.0, loss / (v @ v)) * t * v
    assert np.abs(w - got).max() < 1e-9


def test_saved_scorer_needs_nothing_but_its_folder(spark, tmp_path):
    from textlab.plans.catalog import feature_store
    from textlab.plans.scoring import TextScorer, save_scorer
    path, meta, _ = feature_store(spark, SF001)
    weights = spark.createDataFrame([(i, (i % 5 - 2) / 3) for i in range(meta["size"] + 1)], "idx long, w double")
    first = save_scorer(path, weights, "logistic", str(tmp_path / "scorer"))
    docs = spark.createDataFrame([(1, "You idiots are trash!!!"), (2, None), (3, ""), (4, "a plain text")], "doc_id long, text string")
    want = {r.doc_id: (r.score, r.prediction) for r in first.transform(docs).collect()}
    first.write().overwrite().save(str(tmp_path / "again"))
    other = spark.newSession()
    second = TextScorer.load(str(tmp_path / "again"))
    assert second.getOrDefault("folder") == str(tmp_path / "again") and second.getOrDefault("link") == "logistic"
    new = other.createDataFrame([tuple(r) for r in docs.collect()], "doc_id long, text string")
    assert {r.doc_id: (r.score, r.prediction) for r in second.transform(new).collect()} == want
    assert want[2] == want[3] and len({s for s, _ in want.values()}) == 3
    # a scorer and the stored features agree
    from textlab.sources.io import table
    stored = {r.doc_id: r.score for r in pa_scores(spark.read.parquet(path + "/features"), weights, meta["size"]).collect()}
    scored = {r.doc_id: r.score for r in TextScorer(folder=str(tmp_path / "again"), link="identity")
              .transform(table(spark, SF001, "documents")).collect()}
    assert len(stored) > 50 and all(abs(scored[i] - s) < 1e-9 for i, s in stored.items())
