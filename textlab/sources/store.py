"""Signature-keyed materialisation of the feature tables.

A dataset lives under ``<base>/<signature>/``: ``features`` (packed sparse
vectors, partitioned by ``split`` so a split is read by partition pruning),
``vocab``, ``selected`` and last the ``_manifest`` (one JSON line). The
signature covers all parameters and the content of the rows that the job
uses (columns, filters, labels and texts), so stored features of other data,
another label column or other parameters are never loaded.
"""

from __future__ import annotations

import hashlib
import json
import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from ..operators.assemble import vector_schema


def one_line(obj) -> str:
    """JSON on one line, keys in order."""
    return json.dumps(obj, sort_keys=True, default=str)


def row_hash(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(c) for c in df.columns])


def content_sums(hashed: DataFrame, col: str) -> dict:
    """Order-free sums of row hashes: their number, XOR and sum (one aggregation)."""
    r = hashed.agg(F.count("*").alias("n"), F.bit_xor(col).alias("x"),
                   F.sum(F.col(col).cast("decimal(38,0)")).alias("s")).first()
    return {"rows": int(r.n), "xor": int(r.x or 0), "sum": str(r.s or 0)}


def content_signature(df: DataFrame) -> dict:
    """Order-free signature of the rows a job uses: their columns and the sums of
    a 64-bit hash of all columns."""
    return {"columns": df.columns, **content_sums(df.select(row_hash(df).alias("h")), "h")}


def md5_prefix_signature(df: DataFrame, col: str) -> DataFrame:
    """Portable signature (same value in DuckDB): rows and the sum of the
    first 8 hex digits of each value's md5."""
    pre = F.conv(F.substring(F.md5(F.coalesce(F.col(col).cast("string"), F.lit(""))), 1, 8), 16, 10)
    return df.agg(F.count("*").alias("rows"), F.sum(pre.cast("long")).alias("md5_sum"))


def signature(params: dict, inputs: dict[str, DataFrame]) -> dict:
    """All parameters and the content of every input, and one key of them."""
    return keyed_signature(params, {name: content_signature(df) for name, df in inputs.items()})


def keyed_signature(params: dict, contents: dict[str, dict]) -> dict:
    digest = hashlib.sha256()
    for kind, part in (("param", params), ("input", contents)):
        for name in sorted(part):
            digest.update(f"{kind} {name} {one_line(part[name])}\n".encode())
    return {"params": params, "inputs": contents, "hash": digest.hexdigest()[:40]}


def _read_manifest(spark: SparkSession, path: str) -> dict | None:
    try:
        rows = spark.read.text(os.path.join(path, "_manifest")).collect()
    except AnalysisException:
        return None
    return json.loads(rows[0].value) if rows else None


def _saved_with(spark: SparkSession, base: str, params: dict) -> bool:
    """Whether any feature set in ``base`` was made with ``params``, of whatever input."""
    try:
        saved = spark.read.text(os.path.join(base, "*", "_manifest")).toLocalIterator()
        return any(one_line(json.loads(r.value).get("params")) == one_line(json.loads(one_line(params))) for r in saved)
    except AnalysisException:
        return False


def save_feature_set(fs, path: str, sig: dict) -> None:
    """Write packed features, vocab, selection, then the manifest."""
    spark = fs.docs.sparkSession
    fs.packed().write.mode("overwrite").partitionBy("split").parquet(os.path.join(path, "features"))
    fs.vocab.write.mode("overwrite").parquet(os.path.join(path, "vocab"))
    if fs.selected is not None:
        fs.selected.write.mode("overwrite").parquet(os.path.join(path, "selected"))
    meta = dict(sig, n_features=fs.n_features, size=fs.size, n_terms=fs.n_terms)
    spark.createDataFrame([(one_line(meta),)], "value string").coalesce(1).write.mode(
        "overwrite").text(os.path.join(path, "_manifest"))


def load_features(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Packed features with ``features`` typed as ml vectors (the stored
    struct is read under a VectorUDT schema: no UDF); ``split`` prunes."""
    p = os.path.join(path, "features")
    raw = spark.read.parquet(p)
    df = spark.read.schema(vector_schema(raw)).parquet(p)
    return df.where(F.col("split") == split) if split else df


def materialise(spark: SparkSession, base: str, params: dict, inputs: dict[str, DataFrame],
                builder) -> tuple[str, dict, bool]:
    """Load-if-fresh else build-and-save. Returns ``(path, manifest, hit)``.

    A feature set is filed under the rows that its own pass read: if a single input
    changed between the look-up and the build, that is another key than the one
    looked up. So where no set has these parameters nothing is looked up: the input is
    not read for a key that cannot be there."""
    sig = None
    if len(inputs) > 1 or _saved_with(spark, base, params):
        sig = signature(params, inputs)
        path = os.path.join(base, sig["hash"])
        saved = _read_manifest(spark, path)
        if saved and saved.get("hash") == sig["hash"]:
            return path, saved, True
    fs = builder()
    if len(inputs) == 1 and fs.content:
        (name, df), = inputs.items()
        sig = keyed_signature(params, {name: {"columns": df.columns, **fs.content}})
    sig = sig or signature(params, inputs)
    path = os.path.join(base, sig["hash"])
    try:
        save_feature_set(fs, path, sig)
    finally:
        fs.release()
    return path, _read_manifest(spark, path), False
