"""Cross-validated hyper-parameter search.

Candidates are drawn, seeded, from the reference's search spaces
(log-uniform C and tol, categorical penalty / loss / class weight / average)
and fitted on the stored stratified folds: logistic regression and SVM all in the
same passes over the rows (``operators.batched``), passive-aggressive models
``parallelism`` at a time. Each fit takes its penalty and its balanced weights from
the rows it is given. A candidate's score is its mean F1 of class 1 over the folds; ``train`` refits
the best on all train rows. The Gaussian-process proposal step of a Bayesian
search is not reproduced: this is seeded random search.
"""

from __future__ import annotations

import json
import math
import os
import warnings
from collections.abc import Callable
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..sources.io import write_csv
from .batched import fit_folds
from .models import ModelSpec, fit, scores
from .passive_aggressive import PAParams, fit_pa, pa_scores
from .squared_hinge import fit_squared_hinge

#: Folds that a search takes at most; their numbers pass through the driver.
MAX_FOLDS = 100

# The reference's search spaces.
SPACES = {
    "logreg": {"C": ("log", 1e-3, 1e1), "penalty": ("cat", ["l1", "l2"]),
               "class_weight": ("cat", [None, "balanced"]), "tol": ("log", 1e-6, 1e-2)},
    "lsvc": {"C": ("log", 1e-3, 1e1), "loss": ("cat", ["hinge", "squared_hinge"]),
             "class_weight": ("cat", [None, "balanced"]), "tol": ("log", 1e-6, 1e-2)},
    "pac": {"C": ("log", 1e-3, 1e1), "loss": ("cat", ["hinge", "squared_hinge"]),
            "average": ("cat", [False, True, 10, 50, 100]), "tol": ("log", 1e-5, 1e-2)},
}


def candidates(name: str, n_iter: int, seed: int) -> list[dict]:
    space = SPACES.get(name)
    if space is None:
        return []
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n_iter):
        c = {}
        for k, spec in space.items():
            if spec[0] == "log":
                c[k] = float(math.exp(rng.uniform(math.log(spec[1]), math.log(spec[2]))))
            else:
                c[k] = spec[1][int(rng.integers(len(spec[1])))]
        out.append(c)
    return out


def f1_evaluator(label: str = "label") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=label, predictionCol="prediction",
                                             metricName="fMeasureByLabel", metricLabel=1.0)


def fit_scorer(rows: DataFrame, vectors: DataFrame, size: int, spec: ModelSpec,
               label: str = "label") -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Fit any model. ``rows`` holds ``features`` as the stored struct (indices,
    values), ``vectors`` the same rows with ml vectors; so does the scorer's
    input. It returns doc_id, label, score, prediction."""
    if spec.name == "pac":
        weights = fit_pa(rows, size, PAParams(C=spec.C, loss=spec.loss, tol=spec.tol, average=spec.average), label=label)
    elif spec.name == "lsvc" and spec.loss == "squared_hinge":
        weights = fit_squared_hinge(rows, size, spec, label)
    else:
        model = fit(vectors, spec, label)
        return lambda _, v: scores(model, v, ("doc_id", label))
    return lambda r, _: pa_scores(r, weights, size, keep=(label,))


def cv_search(rows: DataFrame, vectors: DataFrame, size: int, base: ModelSpec, n_iter: int = 15, seed: int = 1337,
              parallelism: int = 4, fold_col: str = "fold", label: str = "label", batched: bool | None = None):
    """Returns ``(best, results)``: the best candidate's mean F1 and parameters,
    and the table ``(candidate, params, mean_f1)``, which states the loss that
    each candidate was fitted with. ``rows`` and ``vectors`` are two typings of
    the train rows (see :func:`fit_scorer`); the caller refits. ``batched`` False fits
    every model by itself."""
    folds = sorted(r[0] for r in rows.select(fold_col).distinct().limit(MAX_FOLDS + 1).collect())
    if not 2 <= len(folds) <= MAX_FOLDS:
        raise ValueError(f"a search takes 2 to {MAX_FOLDS} folds, not {len(folds)}")
    cands = candidates(base.name, n_iter, seed)
    evaluator = f1_evaluator(label)

    def one(task) -> float:
        c, fold = task
        away, held = F.col(fold_col) != fold, F.col(fold_col) == fold
        scorer = fit_scorer(rows.where(away), vectors.where(away), size, base.with_params(c), label)
        judged = scorer(rows.where(held), vectors.where(held))
        return evaluator.evaluate(judged.withColumn("prediction", F.col("prediction").cast("double")))

    spark: SparkSession = rows.sparkSession
    if batched is None:
        batched = base.name != "pac"
    if batched:
        mean = fit_folds(rows, size, [base.with_params(c) for c in cands], folds, fold_col, label)[0].mean(axis=1)
    else:
        with ThreadPool(parallelism) as pool:
            f1 = pool.map(inheritable_thread_target(spark)(one), [(c, f) for c in cands for f in folds], chunksize=1)
        mean = np.reshape(f1, (len(cands), len(folds))).mean(axis=1)
    best = int(np.argmax(mean))
    results = spark.createDataFrame(
        [(i, json.dumps(c, sort_keys=True), float(a)) for i, (c, a) in enumerate(zip(cands, mean))],
        "candidate int, params string, mean_f1 double")
    return {"best_score_cv": float(mean[best]), "best_params": cands[best]}, results


def train(rows: DataFrame, vectors: DataFrame, size: int, base: ModelSpec, folder: str, search: bool = False,
          skip_if_saved: bool = True, n_iter: int = 15, seed: int = 1337, parallelism: int = 4):
    """The scorer of a training run, and the spec it was fitted with.

    Parameters saved in ``folder`` apply with or without a search. A search runs
    if asked for, unless saved parameters let it be skipped or the model has no
    search space; it saves its best parameters and the table of all candidates.
    Saved parameters that cannot be read are reported and passed over."""
    spark = rows.sparkSession
    best_path = os.path.join(folder, f"{base.name}-best")
    try:
        saved = load_best_params(spark, best_path)
    except ValueError as e:
        warnings.warn(f"untuned parameters are used: {e}", stacklevel=2)
        saved = None
    spec = base.with_params(saved or {})
    if search and base.name in SPACES and not (skip_if_saved and saved is not None):
        best, results = cv_search(rows, vectors, size, spec, n_iter, seed, parallelism)
        save_best_params(spark, best, best_path)
        write_csv(results, os.path.join(folder, f"{base.name}-candidates"))
        spec = spec.with_params(best["best_params"])
    return fit_scorer(rows, vectors, size, spec), spec


def save_best_params(spark: SparkSession, best: dict, path: str) -> None:
    """``{best_score_cv, best_params}`` as one JSON line."""
    spark.createDataFrame([(json.dumps(best, sort_keys=True),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(path)


def load_best_params(spark: SparkSession, path: str) -> dict | None:
    """The parameters that ``save_best_params`` wrote to ``path``; None if there
    is no such path. A file that does not hold them raises ValueError."""
    try:
        lines = spark.read.text(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    fields = lines.select(F.from_json("value", "best_score_cv double, best_params string").alias("j")).select("j.*")
    kept = [r.best_params for r in fields.where("best_params is not null").limit(2).collect()]
    if len(kept) != 1:
        raise ValueError(f"{path} holds {len(kept) or 'no'} parameter rows; one was written")
    return json.loads(kept[0])
