"""Operator 7: toxicity by a linear classifier on character n-grams scaled by
naive Bayes log-count ratios (Wang and Manning, 2012).

A feature is the presence of a character n-gram of ``SIZES`` characters of the
text (simple lower case, runs of white space as one space, one space before and
after), identified by a 64-bit hash. Document counts of each class give the
log-count ratio r of a feature; features whose ratio is significant are kept,
their columns are scaled by r, and a logistic regression is fitted on them.

Counts are taken in two passes. The first one counts hash places (``BITS`` bits), so
its memory is fixed, and keeps the ``MAX_FEATURES`` places of highest significance
(at least ``LEAST_Z`` standard errors, ``MIN_DOCS`` documents); the second one counts
the n-grams themselves in those places and keeps the ``MAX_FEATURES`` most significant
ones. Both bounds are on the model alone. Texts are looked up by the whole hash, so a
long text gains no feature by chance.

The fit uses at most ``MAX_FIT`` labelled rows, the first by a hash of their
doc_id, so it costs the same at any input size; scoring covers every text whole.
Every n-gram of every text is looked up.

Nulls and edges: a null or empty text holds no n-gram and scores the intercept;
rows without label or with a null doc_id are not learned from; a doc_id with
several labels is toxic if one of them says so. Without labels of both classes
the score is the share of toxic ones (0 without any). Repeated rows score
equally, ties cannot arise (the sample order is a hash, then the id), an empty
table gives an empty one. Only id and text are inputs of a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.llm.shared import drop_written, list_array, offsets_of, release_memory, row_chunks, text_column, written
from textlab.llm.spans import mix

SIZES = (4, 5, 6)
BITS = 22
MAX_FIT = 16_000
MAX_FEATURES = 30_000
#: Steps of the regression; it ends earlier at its tolerance.
MAX_STEPS = 100
MIN_DOCS = 6
LEAST_Z = 3.0
THRESHOLD = 0.3

_FOLD = np.arange(0x110000, dtype=np.uint32)
for _c in range(0x10000):
    if not 0xD800 <= _c < 0xE000 and len(chr(_c).lower()) == 1:
        _FOLD[_c] = ord(chr(_c).lower())
for _c in (*range(0x09, 0x0E), 0x85, 0xA0, 0x2028, 0x2029, 0x3000):
    _FOLD[_c] = 0x20


@dataclass
class Model:
    keys: np.ndarray     # 64-bit hashes of the features, ascending
    weights: np.ndarray
    intercept: float
    constant: float | None = None

    @staticmethod
    def without_features(score: float) -> "Model":
        return Model(np.zeros(0, np.uint64), np.zeros(0), 0.0, score)


def characters(u8: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(code points, row offsets): folded, one space for each run of white
    space, and each row between two spaces."""
    cp = _FOLD[np.frombuffer(u8.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)]
    cut = np.append(0, np.cumsum((u8 & 0xC0) != 0x80))[offs]
    rows = len(cut) - 1
    out = np.full(len(cp) + 2 * rows, 0x20, np.uint32)
    out[np.arange(len(cp)) + 2 * np.repeat(np.arange(rows), np.diff(cut)) + 1] = cp
    cut = cut + 2 * np.arange(rows + 1)
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != 0x20) | (out[:-1] != 0x20)
    keep[cut[:-1]] = True  # a row may follow another one's closing space
    return out[keep], np.append(0, np.cumsum(keep))[cut]


def places_of(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(64 - BITS)).astype(np.int64)


def place_filter(keys: np.ndarray) -> np.ndarray:
    """Bool by place: whether a key is there."""
    wanted = np.zeros(1 << BITS, bool)
    wanted[places_of(keys)] = True
    return wanted


def _occurrences(u8: np.ndarray, offs: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of all n-grams, in no order; with ``wanted`` (bool by place) only
    those whose place is wanted."""
    cp, cut = characters(u8, offs)
    rows, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    h = cp.astype(np.uint64)
    for j in range(1, max(SIZES)):
        h = h[:-1] * np.uint64(0x100000001B3) + cp[j:]
        size = j + 1
        if size not in SIZES or not len(h):
            continue
        key = mix(h + np.uint64(size << 56))
        at = np.flatnonzero(wanted[places_of(key)]) if wanted is not None else np.arange(len(key))
        row = np.searchsorted(cut, at, "right") - 1
        inside = at + size <= cut[row + 1]
        rows.append(row[inside])
        keys.append(key[at[inside]])
    return np.concatenate(rows), np.concatenate(keys)


def feature_keys(u8: np.ndarray, offs: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of the distinct features of each row, sorted by row and key."""
    row, key = _occurrences(u8, offs, wanted)
    order = np.lexsort((key, row))
    row, key = row[order], key[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    return row[new], key[new]


def _chunk_features(batch: pa.RecordBatch, wanted: np.ndarray | None = None, features=feature_keys):
    data, offs = text_column(batch, "text")
    for lo, hi in row_chunks(offs):
        yield lo, hi, *features(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], wanted)


def _found(keys: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which of ``key`` are among the sorted ``keys``, their places there)."""
    at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
    hit = keys[at] == key if len(keys) else np.zeros(len(key), bool)
    return hit, at[hit]


def fit_sample(docs: DataFrame, labels: DataFrame, max_fit: int = MAX_FIT) -> DataFrame:
    """(text, label) of at most ``max_fit`` labelled documents."""
    chosen = (labels.where("doc_id is not null and toxic is not null").groupBy("doc_id")
              .agg(F.max(F.col("toxic").cast("int")).alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_fit))
    # At most max_fit rows of two numbers: a broadcast of proven size.
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "label")


def _place_counts(sample: DataFrame) -> DataFrame:
    """(key, n1, n0) by place: in how many toxic and other documents a feature of it is."""
    def run(batches):
        counts = np.zeros((1 << BITS) * 2, np.int32)
        for batch in batches:
            label = batch.column(batch.schema.get_field_index("label")).to_numpy()
            for lo, hi, row, key in _chunk_features(batch, features=_occurrences):
                once = np.unique(row << BITS | places_of(key))  # a place counts once a document
                place = (once & ((1 << BITS) - 1)) * 2 + (label[lo + (once >> BITS)] == 1)
                place, n = np.unique(place, return_counts=True)
                counts[place] += n.astype(np.int32)
        some = np.flatnonzero(counts.reshape(-1, 2).any(axis=1))
        for lo in range(0, len(some), 100_000):
            p = some[lo:lo + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(counts[2 * p + 1].astype(np.int64)),
                                              pa.array(counts[2 * p].astype(np.int64))], names=["key", "n1", "n0"])
        release_memory()

    return _summed(sample.mapInArrow(run, "key long, n1 long, n0 long"))


def _key_counts(sample: DataFrame, shared) -> DataFrame:
    """The same by n-gram, for the n-grams of the places of a broadcast."""
    def run(batches):
        wanted = np.zeros(1 << BITS, bool)
        wanted[shared.value] = True
        for batch in batches:
            label = batch.column(batch.schema.get_field_index("label")).to_numpy()
            for lo, hi, row, key in _chunk_features(batch, wanted):
                toxic = (label[lo + row] == 1).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(toxic), pa.array(1 - toxic)],
                                                 names=["key", "n1", "n0"])
        release_memory()

    return _summed(sample.mapInArrow(run, "key long, n1 long, n0 long"))


def _summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy("key").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def _significant(counts: DataFrame, n1: int, n0: int) -> dict[int, float]:
    """Log ratio of the smoothed class rates of the most significant keys."""
    p, q = (F.col("n1") + 0.5) / (n1 + 1.0), (F.col("n0") + 0.5) / (n0 + 1.0)
    error = F.sqrt((1 - p) / (F.col("n1") + 0.5) + (1 - q) / (F.col("n0") + 0.5))
    ratio = F.log(p / q)
    rows = (counts.where(F.col("n1") + F.col("n0") >= MIN_DOCS)
            .select("key", ratio.alias("r"), (F.abs(ratio) / error).alias("z")).where(F.col("z") >= LEAST_Z)
            .orderBy(F.desc("z"), "key").limit(MAX_FEATURES).collect())
    return {x["key"]: x["r"] for x in rows}


def fit(docs: DataFrame, labels: DataFrame, max_fit: int = MAX_FIT, reg: float = 0.002, parts: int = 12) -> Model:
    sample = written(fit_sample(docs, labels, max_fit).repartition(parts), "toxicity")
    sc = sample.sparkSession.sparkContext
    n = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if not n.get(0) or not n.get(1):
        drop_written(sample)
        return Model.without_features(1.0 if n.get(1) else 0.0)
    places = np.array(sorted(_significant(_place_counts(sample), n[1], n[0])), np.int64)
    sent = sc.broadcast(places)
    ratios = _significant(_key_counts(sample, sent), n[1], n[0]) if len(places) else {}
    sent.destroy()
    if not ratios:
        drop_written(sample)
        return Model.without_features(n[1] / (n[0] + n[1]))
    keys = np.sort(np.array(list(ratios), np.int64).view(np.uint64))
    r = np.array([ratios[int(k)] for k in keys.view(np.int64)])
    sent = sc.broadcast(keys)

    def run(batches):
        wanted = place_filter(sent.value)
        for batch in batches:
            for lo, hi, row, key in _chunk_features(batch, wanted):
                hit, at = _found(sent.value, key)
                cut = offsets_of(np.bincount(row[hit], minlength=hi - lo))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(batch.schema.get_field_index("label")).slice(lo, hi - lo),
                     list_array(at.astype(str), cut, pa.string())], names=["label", "grams"])
        release_memory()

    grams = written(sample.mapInArrow(run, "label int, grams array<string>").repartition(parts), "toxicity")
    sent.destroy()
    counted = CountVectorizerModel.from_vocabulary([str(i) for i in range(len(keys))], "grams", "presence").setBinary(True)
    scaled = ElementwiseProduct(scalingVec=Vectors.dense(r), inputCol="presence", outputCol="features")
    model = LogisticRegression(featuresCol="features", labelCol="label", regParam=reg, standardization=False,
                               maxIter=MAX_STEPS, tol=1e-5).fit(scaled.transform(counted.transform(grams)))
    drop_written(grams)
    drop_written(sample)
    return Model(keys, model.coefficients.toArray() * r, float(model.intercept))


def _scores(model: Model, batch: pa.RecordBatch, wanted: np.ndarray) -> np.ndarray:
    out = np.full(batch.num_rows, model.intercept)
    if model.constant is not None:
        out[:] = model.constant
        return out
    for lo, hi, row, key in _chunk_features(batch, wanted):
        hit, at = _found(model.keys, key)
        out[lo:hi] += np.bincount(row[hit], model.weights[at], hi - lo)
    return 1 / (1 + np.exp(-out))


def score_documents(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        wanted = place_filter(shared.value.keys)
        for batch in batches:
            s = _scores(shared.value, batch, wanted)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                                             names=["doc_id", "score", "predicted"])
        release_memory()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, predicted int")


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (all columns) that score below the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        wanted = place_filter(shared.value.keys)
        for batch in batches:
            yield batch.filter(pa.array(_scores(shared.value, batch, wanted) < threshold))
        release_memory()

    return docs.mapInArrow(run, docs.schema)
