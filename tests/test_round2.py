"""Content signatures, repeated keys, repeated lemma forms, saved parameters."""

import json

import pytest
from pyspark.sql import functions as F

from textlab.operators import tfidf, tune
from textlab.operators.models import ModelSpec, make_pipeline
from textlab.operators.split import order_statistics
from textlab.operators.tune import candidates, load_best_params
from textlab.sources.io import read_lexicon
from textlab.sources.store import signature


def test_signature_follows_content(spark):
    df = spark.createDataFrame([(1, "a", 0), (2, "b", 1)], "doc_id long, text string, label int")
    base = signature({"k": 1}, {"d": df})["hash"]
    assert base == signature({"k": 1}, {"d": df.orderBy(F.desc("doc_id"))})["hash"]
    other = [signature({"k": 2}, {"d": df}), signature({"k": 1}, {"d": df.where("label = 1")}),
             signature({"k": 1}, {"d": df.withColumn("label", 1 - F.col("label"))}),
             signature({"k": 1}, {"d": df.withColumn("text", F.lit("c"))}), signature({"k": 1}, {"d": df.union(df)})]
    assert len({base, *(x["hash"] for x in other)}) == 6


def test_order_statistics_end_on_repeated_keys(spark):
    key = F.md5(F.col("id").cast("string"))
    df = spark.createDataFrame([(7,)] * 4 + [(8,)], "id long")
    got = order_statistics(df, key, F.lit("g"), {"g": [1, 3, 5]})
    assert len(got) == 3 and len(set(got.values())) == 2


def test_repeated_lemma_forms_agree_on_both_paths(spark, monkeypatch):
    docs = spark.createDataFrame([(1, ["was", "things"])], "doc_id long, tok array<string>")
    lemmas = spark.createDataFrame([("things", "thing"), ("things", "stuff"), ("was", "be")], "form string, lemma string")
    inline = tfidf.lemmatize(docs, "tok", lemmas).first()["wtok"]
    monkeypatch.setattr(tfidf, "LEMMA_INLINE_MAX", 0)
    assert tfidf.lemmatize(docs, "tok", lemmas).first()["wtok"] == inline == ["be", "stuff"]


def test_best_params_damage_is_an_error(spark, tmp_path):
    (tmp_path / "p.txt").write_text("not json\n")
    with pytest.raises(ValueError):
        load_best_params(spark, str(tmp_path / "p.txt"))


def test_squared_hinge_has_no_pipeline():
    with pytest.raises(ValueError):
        make_pipeline(ModelSpec("lsvc", loss="squared_hinge"), 10)


def _planted(spark):
    """Sixty rows that feature 0 or 1 decides, in three folds, in both typings."""
    from textlab.operators.assemble import vector_schema
    rows = spark.createDataFrame(
        [(i, i % 2, i % 3, (0, 4, [i % 2, 2 + i % 5 // 3], [1.0, 0.5])) for i in range(60)],
        "doc_id long, label int, fold int, features struct<type: tinyint, size: int, indices: array<int>, values: array<double>>")
    return rows, vector_schema(rows)


@pytest.mark.parametrize("name", ["logreg", "lsvc"])
def test_batched_search_equals_one_by_one(spark, tmp_path, monkeypatch, name):
    """Same mean F1 where features decide the label but for some noise."""
    import numpy as np
    from textlab.operators.batched import fit_folds
    from textlab.operators.assemble import vector_schema
    rng = np.random.default_rng(3)
    data = []
    for i in range(150):
        label = int(rng.random() < 0.4)
        hint = label if rng.random() < 0.85 else 1 - label
        idx = sorted({hint, int(rng.integers(2, 6)), int(rng.integers(2, 6))})
        data.append((i, label, i % 3, (0, 6, idx, [1.0 + 0.5 * (j > 1) for j in idx])))
    rows = spark.createDataFrame(
        data, "doc_id long, label int, fold int, features struct<type: tinyint, size: int, indices: array<int>, values: array<double>>")
    schema, path = vector_schema(rows), str(tmp_path / "rows")
    rows.repartition(3).write.parquet(path)
    rows, vectors = spark.read.parquet(path), spark.read.schema(schema).parquet(path)
    base = ModelSpec(name, max_iter=50)
    given = {"logreg": [{"C": 1.0, "penalty": "l2", "class_weight": "balanced", "tol": 1e-5},
                        {"C": 0.5, "penalty": "l1", "class_weight": None, "tol": 1e-5}],
             "lsvc": [{"C": 1.0, "loss": "squared_hinge", "class_weight": "balanced", "tol": 1e-5},
                      {"C": 0.3, "loss": "hinge", "class_weight": None, "tol": 1e-5}]}[name]
    monkeypatch.setattr(tune, "candidates", lambda *a: given)
    args = (rows, vectors, 6, base, 2, 11)
    _, many = tune.cv_search(*args)
    _, single = tune.cv_search(*args, batched=False, parallelism=6)
    got, want = ({r.params: r.mean_f1 for r in t.collect()} for t in (many, single))
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 0.02 for p in got)
    specs = [ModelSpec(name, max_iter=8).with_params(c) for c in candidates(name, 15, 4)]
    f1, passes = fit_folds(rows, 6, specs, [0, 1, 2])
    assert f1.shape == (15, 3) and f1.max() > 0.7
    assert passes < 45  # fewer jobs than fits


def test_search_fits_every_candidate_as_stated(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "rows")
    rows, schema = _planted(spark)
    rows.write.parquet(path)
    rows, vectors = spark.read.parquet(path), spark.read.schema(schema).parquet(path)
    assert {c["loss"] for c in candidates("lsvc", 20, 1)} == {"hinge", "squared_hinge"}
    seed = next(s for s in range(99) if len({c["loss"] for c in candidates("lsvc", 2, s)}) == 2)
    losses = []
    real = tune.fit_folds
    monkeypatch.setattr(tune, "fit_folds", lambda r, n, specs, *a: losses.extend(s.loss for s in specs) or real(r, n, specs, *a))
    for name in ("logreg", "lsvc", "pac"):
        n = 2 if name == "lsvc" else 1
        best, results = tune.cv_search(rows, vectors, 4, ModelSpec(name), n_iter=n, seed=seed, parallelism=6)
        table = results.collect()
        assert len(table) == n and best["best_score_cv"] == max(r.mean_f1 for r in table) > 0.9
        if name == "lsvc":
            stated = [json.loads(r.params)["loss"] for r in table]
            assert stated.count("squared_hinge") == 1 and losses[-2:] == stated


def test_search_is_skipped_where_parameters_are_saved(spark, tmp_path, monkeypatch):
    path, folder = str(tmp_path / "rows"), str(tmp_path / "models")
    rows, schema = _planted(spark)
    rows.write.parquet(path)
    rows, vectors = spark.read.parquet(path), spark.read.schema(schema).parquet(path)
    _, untuned = tune.train(rows, vectors, 4, ModelSpec("pac"), folder)
    assert untuned == ModelSpec("pac")
    scorer, tuned = tune.train(rows, vectors, 4, ModelSpec("pac"), folder, search=True, n_iter=1)
    assert all(r.prediction == r.label for r in scorer(rows, vectors).collect())
    assert tuned.C != 1.0 and spark.read.option("header", True).csv(folder + "/pac-candidates").count() == 1
    monkeypatch.setattr(tune, "cv_search", lambda *a, **k: pytest.fail("searched again"))
    for search in (True, False):
        assert tune.train(rows, vectors, 4, ModelSpec("pac"), folder, search=search)[1] == tuned
    (tmp_path / "models" / "lsvc-best").write_text("damaged\n")
    with pytest.warns(UserWarning):
        assert tune.train(rows, vectors, 4, ModelSpec("lsvc"), folder)[1] == ModelSpec("lsvc")


def test_latin_tokens_take_the_stem_table(spark):
    docs = spark.createDataFrame([(1, "caf\u00e9s 3rd na\u00efve \u0434\u0430x")], "doc_id long, norm string")
    stems = spark.createDataFrame([("cafes", "cafe"), ("rd", "r")], "form string, lemma string")
    params = tfidf.TfidfParams(latin_only=True)
    assert tfidf.word_tokens(docs, "norm", params, stems).first()["wtok"] == ["cafe", "r", "naive", "x"]


@pytest.mark.parametrize("encoding", ["cp1252", "utf-8", "latin-1", "cp1251", "gbk"])
def test_lexicon_charsets(spark, tmp_path, encoding):
    words = {"cp1251": "\u0432\u043e\u043b", "gbk": "\u4e2d\u6587", "latin-1": "caf\u00e9\x81b"}.get(encoding, "caf\u00e9")
    (tmp_path / "lex.txt").write_bytes(f"{words}\n# no\nplain\n".encode(encoding))
    read = None if encoding in ("cp1252", "utf-8", "latin-1") else encoding
    assert {r.cue for r in read_lexicon(spark, str(tmp_path / "lex.txt"), read).collect()} == {words, "plain"}
