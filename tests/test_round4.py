"""The feature job and the models on it read no more than they need."""

import random

from pyspark.sql import functions as F

from paths import SF001
from textlab.functions.charclass import ws_chars, ws_class
from textlab.functions.normalize import normalise, strip_ws, ws_join
from textlab.operators import batches
from textlab.operators.tfidf import TfidfParams, index_vocab
from textlab.sources import store
from textlab.sources.io import read_labelled


def test_whitespace_without_class_regexes(spark):
    """Python's strip and split, with no regex that tries the whole class at every character."""
    r = random.Random(3)
    alphabet = [*ws_chars(), "a", "é", " ", " ", "\n", "😀", "​", "᠎", "\0"]
    texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(12))) for _ in range(3000)] + ["", None]
    d = spark.createDataFrame([(t,) for t in texts], "text string")
    for row in d.select("text", strip_ws("text").alias("s"), ws_join("text").alias("j")).collect():
        assert row.s == (row.text or "").strip() and row.j == " ".join((row.text or "").split())
    plan = d.select(normalise("text"), ws_join("text"))._jdf.queryExecution().optimizedPlan().toString()
    assert ws_class() + "+" not in plan


def test_terms_of_slices_meet_a_large_vocabulary_unsorted(spark, monkeypatch):
    p = TfidfParams(min_df_word=1, min_df_char=1)
    rows = spark.createDataFrame([(i, i % 2 * 128, [1.0], ["a", f"b{i % 3}"], f"ab{i % 3}") for i in range(20)],
                                 "doc_id long, tag int, dense array<double>, wtok array<string>, norm string")
    vocab, plans, real = index_vocab(batches.term_counts(rows, p), 20, p), {}, batches.written

    def written(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return real(df, name)
    monkeypatch.setattr(batches, "written", written)
    large, small = batches.Weighed(rows, vocab, p, most_bytes=0), batches.Weighed(rows, vocab, p)
    assert "ShuffledHashJoin" in plans["found"] and "SortMergeJoin" not in plans["found"]
    # rows that no class counts are left out before they are weighed
    sums = [sorted(batches.class_sums(w, 384, 128).groupBy("idx", "class").agg(F.round(F.sum("w"), 9)).collect()) for w in (large, small)]
    assert sums[0] == sums[1]
    seen = batches.class_sums(large, 384, 128)._jdf.queryExecution().optimizedPlan().toString()
    assert "tag" in seen and "Filter" in seen


def test_an_empty_store_reads_its_input_once(spark, tmp_path, monkeypatch):
    """No look-up where no feature set has the parameters; the key is that of the rows read."""
    from textlab.plans.features import FeatureConfig, build_features
    docs, looked = read_labelled(spark, SF001), []
    real = store.content_signature
    monkeypatch.setattr(store, "content_signature", lambda df: looked.append(1) or real(df))
    for folds in (3, 4):
        cfg = FeatureConfig(k_best=50, use_raw_feats=False, use_profanity_ratio=False, folds=folds)
        params, looked[:] = {"features": cfg.as_dict()}, []
        build = lambda: build_features(docs, cfg)
        path, manifest, hit = store.materialise(spark, str(tmp_path), params, {"labelled": docs}, build)
        assert not hit and not looked
        assert path.endswith(store.signature(params, {"labelled": docs})["hash"]) and manifest["params"] == store.json.loads(store.one_line(params))
        assert store.materialise(spark, str(tmp_path), params, {"labelled": docs}, build)[::2] == (path, True) and looked


def test_models_share_one_look_up(spark, monkeypatch):
    from textlab.plans import catalog
    times, real = [], catalog.feature_store
    monkeypatch.setattr(catalog, "feature_store", lambda *a: times.append(a) or real(*a))
    assert sorted(r.model for r in catalog.QUERIES["model_areas"](spark, SF001).collect()) == ["logreg", "lsvc", "pac"]
    assert len(times) == 1


def test_packed_passes_equal_plain_gradients(spark):
    """Losses, gradients and hits of all fits against a dense computation; rows without
    features, features of all rows, null folds; no Python work for a single row."""
    import numpy as np
    from textlab.operators import batched
    from textlab.operators.models import ModelSpec
    rng, size, data = np.random.default_rng(5), 40, []
    for i in range(500):
        idx = sorted({0, 1, *rng.integers(2, size, rng.integers(0, 6)).tolist()}) if i % 9 else []
        data.append((i % 2, [0, 1, 2, None][i % 4], (0, size, [int(j) for j in idx], [float(v) for v in rng.normal(size=len(idx))])))
    x, y = np.zeros((500, size + 1)), np.array([1.0 if d[0] else -1.0 for d in data])
    for k, d in enumerate(data):
        x[k, d[2][2]], x[k, -1] = d[2][3], 1.0
    schema = "label int, fold int, features struct<type: tinyint, size: int, indices: array<int>, values: array<double>>"
    rows = spark.createDataFrame(data, schema).repartition(3)
    entries, batched.ENTRIES = batched.ENTRIES, 60
    try:
        packed = rows.select(F.col("label").alias("code"), "features.indices", "features.values").mapInArrow(
            batched._packed(size), ", ".join(f"{c} binary" for c in batched.PACK)).persist()
    finally:
        batched.ENTRIES = entries
    assert packed.count() > 9
    kinds, w = ["logistic", "hinge", "squared_hinge", "logistic"], rng.normal(size=(size + 1, 4))
    sign, share = np.array([-1.0, 1.0]), np.array([[1.0, 0.5, 2.0, 0.0], [0.0, 3.0, 1.0, 1.0]])
    sent = spark.sparkContext.broadcast(w)
    parts = packed.mapInArrow(batched._pass(size, sent, kinds, sign, share), "block long, g binary").collect()
    loss = sum(np.frombuffer(r.g) for r in parts if r.block == -1)
    grad = sum(np.frombuffer(r.g).reshape(-1, 4) for r in parts if r.block == 0)
    z, s = y[:, None] * (x @ w), share[(y > 0).astype(int)]
    slack = np.maximum(0, 1 - z)
    value = np.column_stack([np.logaddexp(0, -z[:, 0]), slack[:, 1], slack[:, 2] ** 2, np.logaddexp(0, -z[:, 3])])
    slope = np.column_stack([-1 / (1 + np.exp(z[:, 0])), -1.0 * (z[:, 1] < 1), -2 * slack[:, 2], -1 / (1 + np.exp(z[:, 3]))])
    assert np.allclose(loss, (s * value).sum(axis=0)) and np.allclose(grad, x.T @ (s * y[:, None] * slope))
    f1, _ = batched.fit_folds(rows, size, [ModelSpec("logreg", C=1e-9, max_iter=1), ModelSpec("lsvc", max_iter=3)], [0, 1, 2])
    assert f1.shape == (2, 3) and np.isfinite(f1).all()
