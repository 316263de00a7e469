"""n-gram edge cases and the sorted vocabulary index."""

from pyspark.sql import functions as F

from textlab.functions.ngrams import char_ngrams, word_ngrams
from textlab.operators.tfidf import sorted_index


def test_word_ngram_edges(spark):
    df = spark.createDataFrame([([],), (["a"],), (["a", "b", "c"],)], "t array<string>")
    got = [r.g for r in df.select(word_ngrams("t", 1, 2).alias("g")).collect()]
    assert got == [[], ["a"], ["a", "b", "c", "a b", "b c"]]
    got3 = [r.g for r in df.select(word_ngrams("t", 3, 3).alias("g")).collect()]
    assert got3 == [[], [], ["a b c"]]


def test_char_ngram_edges(spark):
    df = spark.createDataFrame([("",), ("ab",), ("abc",), ("a bcd",), ("a\nbé",)], "t string")
    got = [sorted(r.g) for r in df.select(char_ngrams("t", 3, 4).alias("g")).collect()]
    want = [[], [], ["abc"], ["a b", " bc", "bcd", "a bc", " bcd"], ["a\nb", "\nbé", "a\nbé"]]
    assert got == [sorted(w) for w in want]
    got5 = [sorted(r.g) for r in df.select(char_ngrams("t", 2, 5).alias("g")).collect()]
    brute = [sorted(t[i:i + n] for n in range(2, 6) for i in range(len(t) - n + 1))
             for t in ("", "ab", "abc", "a bcd", "a\nbé")]
    assert got5 == brute


def test_sorted_index_dense_and_ordered(spark):
    df = spark.range(0, 5000).select(F.concat(F.lit("t"), ((F.col("id") * 7919) % 5000).cast("string")).alias("term"))
    idx = sorted_index(df, ["term"], parts=6)
    rows = sorted((r.term, r.idx) for r in idx.collect())
    assert [i for _, i in rows] == list(range(5000))


def test_lemma_join_path_equals_inline(spark, monkeypatch):
    import textlab.operators.tfidf as tf
    from textlab.functions.normalize import normalise
    from textlab.plans.catalog import LEMMAS
    from textlab.sources.io import lemma_frame, read_labelled
    d = read_labelled(spark, "/root/testdata/sf0.001").withColumn("norm", normalise("text"))
    p = tf.TfidfParams()
    inline = {r.doc_id: r.wtok for r in tf.word_tokens(d, "norm", p, lemma_frame(spark, LEMMAS)).collect()}
    monkeypatch.setattr(tf, "LEMMA_INLINE_MAX", 0)
    joined = {r.doc_id: r.wtok for r in tf.word_tokens(d, "norm", p, lemma_frame(spark, LEMMAS)).collect()}
    assert inline == joined and any("idiot" in t for t in inline.values())
