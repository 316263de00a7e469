"""Lexicon loading, word/phrase flags and corpus expectations (FIXTURES)."""

import os
import tempfile

from pyspark.sql import functions as F

from paths import SF001, SF01
from textlab.functions.normalize import normalise
from textlab.operators.lexicon import lexicon_flag, lexicon_structs, profanity_ratio
from textlab.operators.metrics import confusion
from textlab.plans.catalog import LEXICON_PHRASES, LEXICON_WORDS
from textlab.sources.io import cues_frame, read_labelled, read_lexicon

M9 = "@Zoé!! of trash, IDIOT idiot! the moron"


def test_loader_fixture(spark):
    lines = ["﻿trash"] + list(LEXICON_WORDS[1:]) + ["IDIOT", "# comment", "", "  Of Trash  "]
    d = tempfile.mkdtemp(prefix="lex-")
    p = os.path.join(d, "lex.txt")
    with open(p, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    cues = sorted(r.cue for r in read_lexicon(spark, p).collect())
    assert cues == sorted(set(LEXICON_WORDS) | {"of trash"})
    assert len(cues) == 11
    s = {r.cue: r.n_tok for r in lexicon_structs(read_lexicon(spark, p)).collect()}
    assert s["of trash"] == 2 and s["idiot"] == 1


def test_loader_other_encoding(spark):
    d = tempfile.mkdtemp(prefix="lex-")
    p = os.path.join(d, "lex.txt")
    with open(p, "wb") as f:
        f.write("Café\r\nnaïve\n".encode("cp1252"))
    assert sorted(r.cue for r in read_lexicon(spark, p, encoding="windows-1252").collect()) == ["café", "naïve"]


def test_micro_flags(spark):
    df = spark.createDataFrame([(9, M9), (3, "SOOO coool!!! AAaa you, You u")], "doc_id long, text string")
    w = {r.doc_id: r.prediction for r in lexicon_flag(df, cues_frame(spark, LEXICON_WORDS)).collect()}
    p = {r.doc_id: r.prediction for r in lexicon_flag(df, cues_frame(spark, LEXICON_PHRASES)).collect()}
    assert w == {9: 1, 3: 0} and p == {9: 1, 3: 0}
    # "idiot!" and "trash," are not the cues; "of trash," is not the phrase
    df2 = spark.createDataFrame([(1, "idiot! trash, of trash,")], "doc_id long, text string")
    assert lexicon_flag(df2, cues_frame(spark, LEXICON_WORDS + LEXICON_PHRASES)).first().prediction == 0


def _counts(spark, sf, cues):
    s = lexicon_flag(read_labelled(spark, sf), cues_frame(spark, cues))
    return [r.n for r in confusion(s).orderBy("label", "prediction").collect()]


def test_corpus_counts(spark):
    assert _counts(spark, SF001, LEXICON_WORDS) == [76, 0, 5, 6]
    assert _counts(spark, SF001, LEXICON_PHRASES) == [76, 0, 11, 0]
    assert _counts(spark, SF01, LEXICON_WORDS) == [348, 0, 19, 32]
    assert _counts(spark, SF01, LEXICON_PHRASES) == [348, 0, 44, 7]


def test_profanity_ratio_sum(spark):
    for sf, want in ((SF001, 0.152818), (SF01, 0.842410)):
        d = read_labelled(spark, sf).withColumn("norm", normalise("text"))
        got = profanity_ratio(d, cues_frame(spark, LEXICON_WORDS)).agg(F.sum("profanity_ratio")).first()[0]
        assert abs(got - want) < 1e-6


def test_join_path_equals_inline(spark, monkeypatch):
    import textlab.operators.lexicon as lx
    d = read_labelled(spark, SF001)
    cues = cues_frame(spark, LEXICON_WORDS + LEXICON_PHRASES)
    inline = {r.doc_id: r.prediction for r in lexicon_flag(d, cues).collect()}
    monkeypatch.setattr(lx, "INLINE_MAX_ROWS", 1)
    joined = {r.doc_id: r.prediction for r in lexicon_flag(d, cues).collect()}
    assert inline == joined
    dn = d.withColumn("norm", normalise("text"))
    a = {r.doc_id: r.profanity_ratio for r in profanity_ratio(dn, cues_frame(spark, LEXICON_WORDS)).collect()}
    monkeypatch.setattr(lx, "INLINE_MAX_ROWS", 20000)
    b = {r.doc_id: r.profanity_ratio for r in profanity_ratio(dn, cues_frame(spark, LEXICON_WORDS)).collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-12 for k in a)


def test_anchor_index_of_a_large_lexicon(spark):
    """100,000 cues of one to five tokens against a plain search; one token is in every text."""
    import random
    rng = random.Random(8)
    vocab = [f"t{i}" for i in range(3000)]
    texts = [" ".join(["the"] + rng.choices(vocab, k=rng.randrange(0, 25))) for _ in range(300)]
    texts += [None, "", " ", "the", "the the", "t1 " * 400]
    cues = {" ".join(rng.choices(vocab, k=rng.randrange(2, 6))) for _ in range(99_900)}
    cues |= {f"the {w}" for w in vocab[:40]} | {" ".join(t.split()[2:5]) for t in texts[:30] if len(t.split()) > 5}
    cues |= {"t1 t1 t1", "absent", "t2999"}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    frame = spark.createDataFrame([(c,) for c in sorted(cues)] + [("absent",)], "cue string")
    got = {r.doc_id: r.prediction for r in lexicon_flag(df, frame, assume_normalised=True).collect()}

    def holds(t):
        w = (t or "").split()
        return int(any(" ".join(w[i:i + k]) in cues for k in range(1, 6) for i in range(len(w) - k + 1)))
    want = {i: holds(t) for i, t in enumerate(texts)}
    assert got == want and 20 < sum(want.values()) < len(texts) - 20


def test_anchor_is_the_rarest_token(spark, monkeypatch):
    import textlab.operators.lexicon as lx
    words = spark.createDataFrame([(d, w) for d, t in enumerate(["a b c", "a b", "a"]) for w in t.split()], "doc_id long, anchor string")
    structs = lexicon_structs(spark.createDataFrame([("a b",), ("b c a",), ("a",), ("a z",), ("c b",)], "cue string"))
    got = sorted(tuple(r) for r in lx.anchor_index(words, structs).collect())
    assert got == [("a", 3, "a", 1), ("b", 2, "a b", 2), ("c", 1, "b c a", 3), ("c", 1, "c b", 2)]
    monkeypatch.setattr(lx, "HOT_ANCHORS", 1)
    monkeypatch.setattr(lx, "INLINE_MAX_ROWS", 1)
    df = spark.createDataFrame([(0, "a b c"), (1, "b a"), (2, "c b"), (3, "z")], "doc_id long, text string")
    cues = spark.createDataFrame([("a b",), ("c b",), ("a z",)], "cue string")
    assert {r.doc_id: r.prediction for r in lexicon_flag(df, cues).collect()} == {0: 1, 1: 0, 2: 1, 3: 0}
