"""Models on stored features, persistence, raw-text scoring, contract."""

import os
import tempfile

from pyspark.sql import functions as F

from paths import SF001
from textlab.operators.models import ModelSpec, fit, load_model, save_model, scores
from textlab.operators.tune import candidates, load_best_params, save_best_params
from textlab.plans.catalog import feature_store
from textlab.plans.features import transform_texts
from textlab.sources.io import read_labelled
from textlab.sources.store import load_features


def test_logreg_roundtrip_and_text_scoring(spark):
    path, meta, _ = feature_store(spark, SF001)
    train = load_features(spark, path, "train")
    model = fit(train, ModelSpec("logreg"))
    d = tempfile.mkdtemp(prefix="model-")
    save_model(model, os.path.join(d, "logreg"))
    again = load_model(os.path.join(d, "logreg"))
    a = {r.doc_id: r.score for r in scores(model, load_features(spark, path, "test")).collect()}
    b = {r.doc_id: r.score for r in scores(again, load_features(spark, path, "test")).collect()}
    assert a == b and len(a) > 0
    # raw texts through the stored fit give the stored test features
    docs = read_labelled(spark, SF001)
    test_ids = load_features(spark, path, "test").select("doc_id")
    new = transform_texts(docs.join(test_ids, "doc_id", "left_semi").select("doc_id", "text"), path)
    stored = spark.read.parquet(path + "/features").where(F.col("split") == "test")
    got = {r.doc_id: (list(r.features.indices), [round(v, 9) for v in r.features.values]) for r in new.collect()}
    want = {r.doc_id: (list(r.features.indices), [round(v, 9) for v in r.features.values]) for r in stored.collect()}
    assert got == want


def test_best_params_sink(spark):
    d = tempfile.mkdtemp(prefix="best-")
    save_best_params(spark, {"best_score_cv": 0.5, "best_params": {"C": 2.0}}, os.path.join(d, "best"))
    assert load_best_params(spark, os.path.join(d, "best")) == {"C": 2.0}
    assert load_best_params(spark, os.path.join(d, "absent")) is None
    assert ModelSpec("logreg").with_params({"C": 2.0, "bogus": 1}).C == 2.0


def test_candidates_seeded():
    a, b = candidates("logreg", 5, 1337), candidates("logreg", 5, 1337)
    assert a == b and all(1e-3 <= c["C"] <= 10 for c in a)
    assert candidates("unknown", 3, 1) == []


def test_entry_contract(spark):
    import __spark_entry__ as E
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert E.entry(spark).count() == 5


def test_pa_deterministic_and_learns(spark):
    from textlab.operators.metrics import auc_summary
    from textlab.operators.passive_aggressive import PAParams, fit_pa, pa_scores
    path, meta, _ = feature_store(spark, "/root/testdata/sf0.01")
    raw = spark.read.parquet(path + "/features")
    train = raw.where(F.col("split") == "train")
    w1 = {r.idx: r.w for r in fit_pa(train, meta["size"], PAParams(max_epochs=5)).collect()}
    w2 = {r.idx: r.w for r in fit_pa(train, meta["size"], PAParams(max_epochs=5)).collect()}
    assert w1 == w2 and len(w1) > 0
    s = pa_scores(raw.where(F.col("split") == "train"), fit_pa(train, meta["size"], PAParams(max_epochs=5)),
                  meta["size"])
    # separable enough on its own training rows
    assert auc_summary(s).first().roc_auc > 0.9


def test_squared_hinge_reaches_the_minimum(spark):
    """The gradient of the stated objective, written out in NumPy, vanishes at the fit."""
    import numpy as np
    from textlab.operators.squared_hinge import fit_squared_hinge
    rng = np.random.default_rng(5)
    x = np.where(rng.random((60, 7)) < 0.5, rng.normal(size=(60, 7)), 0.0)
    y = (x[:, 0] - x[:, 1] + 0.3 * rng.normal(size=60) > 0).astype(int)
    x[0] = 0.0  # a row without features
    rows = [(([int(j) for j in np.nonzero(r)[0]], [float(v) for v in r[r != 0]]), int(t)) for r, t in zip(x, y)]
    df = spark.createDataFrame(rows, "features struct<indices: array<int>, values: array<double>>, label int").repartition(3)
    for weight in (None, "balanced"):
        spec = ModelSpec("lsvc", C=0.7, loss="squared_hinge", tol=1e-9, class_weight=weight)
        w = np.zeros(8)
        for r in fit_squared_hinge(df, 7, spec).collect():
            w[r.idx] = r.w
        s = np.ones(60) if weight is None else 60 / (2 * np.bincount(y))[y]
        x1, sign = np.c_[x, np.ones(60)], 2 * y - 1
        grad = w - 2 * 0.7 * x1.T @ (s * sign * np.maximum(0, 1 - sign * (x1 @ w)))
        assert np.abs(grad).max() < 1e-6 and np.abs(w).max() > 0.1
    assert fit_squared_hinge(df.limit(0), 7).count() == 0


def test_passive_aggressive_does_not_follow_the_cores(spark):
    from textlab.operators.passive_aggressive import PAParams, fit_pa
    df = spark.createDataFrame([(i, i % 2, ([i % 2, 2], [1.0, 0.5])) for i in range(40)],
                               "doc_id long, label int, features struct<indices: array<int>, values: array<double>>")
    fits = [{r.idx: r.w for r in fit_pa(df.repartition(n), 3, PAParams(average=a)).collect()}
            for n, a in ((1, False), (7, False), (1, 10), (7, 10))]
    assert fits[0] == fits[1] and fits[2] == fits[3] and fits[0][1] > 0 > fits[0][0]
