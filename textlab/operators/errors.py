"""Error analysis: most confident false positives / negatives with text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SNIPPET_CHARS = 240
ELLIPSIS = "…"
#: Rows of six numbers that are broadcast at most, twice (both kinds of error).
BROADCAST_K = 100_000


def default_threshold(model_name: str) -> float:
    """0.5 for probabilities, 0.0 for margin models."""
    return 0.5 if model_name in ("logreg", "baseline") else 0.0


def snippet(c: Column | str, n: int = SNIPPET_CHARS) -> Column:
    """Newlines to spaces, first ``n`` characters, ellipsis when cut."""
    t = F.regexp_replace(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")), "\n", " ")
    return F.when(F.length(t) > n, F.concat(F.substring(t, 1, n), F.lit(ELLIPSIS))).otherwise(t)


def error_samples(scored: DataFrame, texts: DataFrame, threshold: float, k: int = 3,
                  key: str = "doc_id", label: str = "label", score: str = "score") -> DataFrame:
    """``(kind, y_true, y_pred, score, idx, text, snippet)``: per kind
    (``fp``/``fn``) the k rows with the largest ``|score - threshold|``, ties
    by key. Each top-k is a bounded TakeOrderedAndProject; only those 2k
    rows meet the texts (broadcast up to ``BROADCAST_K``, else a plain join)."""
    s = scored.select(F.col(key).alias("idx"), F.col(label).cast("int").alias("y_true"),
                      F.col(score).cast("double").alias("score"))
    s = s.withColumn("y_pred", (F.col("score") >= threshold).cast("int"))
    conf = F.abs(F.col("score") - F.lit(threshold))
    parts = []
    for kind, yt, yp in (("fp", 0, 1), ("fn", 1, 0)):
        top = (s.where((F.col("y_true") == yt) & (F.col("y_pred") == yp))
               .orderBy(conf.desc(), F.col("idx").asc()).limit(k)
               .withColumn("kind", F.lit(kind)))
        parts.append(top)
    top = parts[0].unionByName(parts[1])
    t = texts.select(F.col(key).alias("idx"), F.col("text"))
    return (t.join(F.broadcast(top) if k <= BROADCAST_K else top, "idx", "inner")
            .select("kind", "y_true", "y_pred", "score", "idx", "text", snippet("text").alias("snippet")))
