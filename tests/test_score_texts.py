"""Raw-text scoring row by row, in slices."""

import math

from pyspark.sql import functions as F

from paths import SF001
from textlab.plans.catalog import feature_store
from textlab.plans.features import transform_texts
from textlab.plans.scoring import TextScorer, save_scorer

TEXTS = ["You idiots are trash!!!", None, "", "a plain text", "a plain text, and you idiots are still trash", "zzqx"]


def _scorer(spark, tmp_path):
    path, meta, _ = feature_store(spark, SF001)
    weights = spark.createDataFrame([(i, (i % 5 - 2) / 3) for i in range(meta["size"] + 1)], "idx long, w double")
    return path, save_scorer(path, weights, "identity", str(tmp_path / "scorer"))


def test_rows_that_share_an_id_are_scored_by_themselves(spark, tmp_path):
    path, scorer = _scorer(spark, tmp_path)
    alone = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    want = sorted(r.score for r in scorer.transform(alone).collect())
    for ids, kind in (([7] * 6, "long"), ([None] * 6, "long"), ([None, "x", "x", "y", "", "é"], "string"),
                      ([2**60 + 1, None, 2**60 + 2, None, 5, 5], "long")):
        docs = spark.createDataFrame(list(zip(ids, TEXTS)), f"doc_id {kind}, text string")
        got = scorer.transform(docs).collect()
        assert sorted(map(repr, (r.doc_id for r in got))) == sorted(map(repr, ids))
        assert all(math.isclose(a, b, abs_tol=1e-9) for a, b in zip(sorted(r.score for r in got), want))


def test_a_large_vocabulary_scores_alike(spark, tmp_path, monkeypatch):
    from textlab.operators import batches
    path, scorer = _scorer(spark, tmp_path)
    docs = spark.createDataFrame([(None, TEXTS[0]), *enumerate(TEXTS)], "doc_id long, text string")
    want = sorted(map(repr, scorer.transform(docs).collect()))
    monkeypatch.setattr(batches, "hot_terms", lambda vocab, most: vocab.limit(0))  # as if it did not fit: shuffle join
    assert sorted(map(repr, scorer.transform(docs).collect())) == want


def test_scoring_moves_no_postings(spark, tmp_path):
    path, scorer = _scorer(spark, tmp_path)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(3)
    for df in (transform_texts(docs, path), scorer.transform(docs)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "MapInArrow" in plan and "Window" not in plan and "Generate" not in plan and "Aggregate" not in plan
