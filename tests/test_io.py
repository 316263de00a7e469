"""CSV source, report sinks and the signature-keyed store."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from paths import SF001
from textlab.operators.errors import error_samples, snippet
from textlab.operators.metrics import class_report
from textlab.sources.io import read_labelled, read_labelled_csv, write_csv, write_json


def test_csv_multiline_and_doubled_quotes(spark):
    d = tempfile.mkdtemp(prefix="csv-")
    p = os.path.join(d, "raw.csv")
    with open(p, "w", encoding="utf-8") as f:
        f.write('id,text,label\n1,"Row one, line one;\n\nline three says ""stop"".",1\n2,plain,0\n')
    rows = {r.doc_id: (r.text, r.label) for r in read_labelled_csv(spark, p, id_col="id").collect()}
    assert rows == {1: ('Row one, line one;\n\nline three says "stop".', 1), 2: ("plain", 0)}


def test_error_sink_roundtrip(spark):
    docs = read_labelled(spark, SF001)
    scored = docs.select("doc_id", "label", (F.length("text") % 7 / 7.0).alias("score"))
    err = error_samples(scored, docs, 0.5, k=2)
    out = tempfile.mkdtemp(prefix="err-")
    write_csv(err.select("y_true", "y_pred", "score", "idx", "text"), out)
    back = read_labelled_csv(spark, out, text_col="text", label_col="y_true", id_col="idx")
    assert sorted(r.doc_id for r in back.collect()) == sorted(r.idx for r in err.collect())
    assert {r.kind for r in err.collect()} <= {"fp", "fn"} and err.count() <= 4


def test_report_json_sink(spark):
    rows = spark.createDataFrame([(0, 0), (1, 1), (1, 0)], "label int, prediction int")
    out = tempfile.mkdtemp(prefix="rep-")
    write_json(class_report(rows), out)
    got = [json.loads(line) for f in os.listdir(out) if f.endswith(".json") for line in open(os.path.join(out, f))]
    assert {g["row"] for g in got} == {"non-toxic", "toxic", "accuracy", "macro avg", "weighted avg"}


def test_snippet(spark):
    df = spark.createDataFrame([("a\nb",), ("x" * 300,)], "t string")
    got = [r.s for r in df.select(snippet("t").alias("s")).collect()]
    assert got == ["a b", "x" * 240 + "…"]


def test_store_hits_second_time(spark):
    from textlab.plans.catalog import feature_store
    p1, m1, hit1 = feature_store(spark, SF001)
    p2, m2, hit2 = feature_store(spark, SF001)
    assert p1 == p2 and hit2 and m1["hash"] == m2["hash"]
    from textlab.sources.store import load_features
    f = load_features(spark, p1, "train")
    from pyspark.ml.linalg import VectorUDT
    assert isinstance(f.schema["features"].dataType, VectorUDT) and f.count() > 0
