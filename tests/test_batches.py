"""Batched n-grams and weights against postings as rows."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from paths import SF001
from textlab.functions.ngrams import char_kgrams
from textlab.operators import batches
from textlab.operators.tfidf import (TfidfParams, block_terms, document_frequencies, fit_vocab, index_vocab, postings, weigh)
from textlab.plans.features import FeatureConfig, build_features
from textlab.sources.io import cues_frame, read_labelled

WIDE = "".join(chr(0x4E00 + 7 * i) for i in range(2900)) + "".join(chr(0x1F300 + i) for i in range(300))


def _rows(spark):
    r = random.Random(5)
    words = ["a", "b", "a b", "", "b a", "é", "new york", "york", "😀"]
    rows = [(d, [r.choice(words) for _ in range(r.randrange(9))], "".join(r.choice("ab é\0😀\n") for _ in range(r.randrange(12))))
            for d in range(300)]
    rows += [(300, [], ""), (301, ["a"] * 700, "ab" * 400), (302, list(WIDE), WIDE), (303, list(WIDE), WIDE), (304, ["é"], WIDE[::-1])]
    return spark.createDataFrame(rows, "doc_id long, wtok array<string>, norm string").repartition(3, "doc_id")


@pytest.mark.parametrize("spans", [((1, 2), (3, 4)), ((1, 3), (2, 6)), ((2, 2), (1, 1))])
@pytest.mark.parametrize("slice_chars", [1, 500, 1 << 21])
def test_batched_terms_equal_postings(spark, spans, slice_chars, monkeypatch):
    monkeypatch.setattr(batches, "SLICE_CHARS", slice_chars)
    p = TfidfParams(word_ngrams=spans[0], char_ngrams=spans[1], min_df_word=2, min_df_char=2)
    rows = _rows(spark)
    d = rows.withColumn("ctop", char_kgrams("norm", p.char_ngrams[1]))
    post = postings(d, block_terms(F.col("wtok"), F.col("norm"), p, F.col("ctop")))
    counts = batches.term_counts(rows, p)
    assert sorted(counts.collect()) == sorted(document_frequencies(post).collect())
    if slice_chars == 500:
        return
    vocab = fit_vocab(post, 305, p)
    assert sorted(index_vocab(counts, 305, p).collect()) == sorted(vocab.collect())
    want = sorted((r.doc_id, r.idx, round(r.w, 9)) for r in weigh(post, vocab).collect())
    tagged = rows.withColumns({"tag": (F.col("doc_id") % 2).cast("int") * 384, "dense": F.array(F.col("doc_id") / 2)})
    third = vocab.where("idx % 3 = 0").selectExpr("idx", "idx div 3 as new_idx")
    for most in (0, 64 << 20):  # larger than the bound: shuffle join
        met = batches.Weighed(tagged, vocab, p, most_bytes=most)
        docs = batches.document_rows(met).collect()
        assert len(docs) == 305 and all(list(r.dense) == [r.doc_id / 2] and list(r.indices) == sorted(r.indices) for r in docs)
        assert sorted((r.doc_id, i, round(w, 9)) for r in docs for i, w in zip(r.indices, r["values"])) == want
        few = batches.document_rows(met, third).collect()
        assert sorted((r.doc_id, 3 * i, round(w, 9)) for r in few for i, w in zip(r.indices, r["values"])) == [x for x in want if x[1] % 3 == 0]
        sums = {(r.idx, r["class"]): r.w for r in batches.class_sums(met, 384, 128).groupBy("idx", "class").agg(F.sum("w").alias("w")).collect()}
        plain = Counter()
        for doc, idx, w in want:
            plain[idx, doc % 2] += w
        assert sums.keys() == plain.keys() and all(math.isclose(sums[k], plain[k], abs_tol=1e-6) for k in sums)


def test_feature_job_moves_no_postings(spark):
    """Vectors and all weights come from the texts without a shuffle, and nothing of their size is persisted."""
    fs = build_features(read_labelled(spark, SF001), FeatureConfig(k_best=300, rank_digits=6), cues_frame(spark, ["idiot"]))
    for df in (fs.packed(), fs.assembled, fs.tfidf, fs.long):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "MapInArrow" in plan and "RepartitionByExpression" not in plan and "collect_list" not in plan and "windowspec" not in plan.split("InMemoryRelation")[0]
    assert len(fs.persisted) == 2 and all(set(d.columns) <= {"idx", "chi2", "old_idx", "new_idx"} for d in fs.persisted)
    fs.release()
