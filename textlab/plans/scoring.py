"""Raw-text scoring as one saved pipeline stage.

``TextScorer`` takes ``(doc_id, text)`` rows to scores. Saving it copies all that a
score depends on into its folder: the vocabulary with idf, the selected features, the
weights, and the manifest of the feature set with toggles, tokenizer settings,
lexicon, lemma table and offsets. Nothing comes from the caller, so a scorer loaded
in another session gives the same scores. Its tables stay tables: scoring joins terms
with the vocabulary, features with the selection and the weights.
"""

from __future__ import annotations

import json
import os

from pyspark import keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.passive_aggressive import pa_scores
from .features import transform_texts

#: Tables of a scorer beside its parameters.
PARTS = ("vocab", "selected", "weights")


def weight_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """``(idx, w)`` of a fitted linear pipeline; the last index is the intercept's."""
    last = model.stages[-1]
    weights = [*last.coefficients.toArray(), last.intercept]
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(weights) if v], "idx long, w double")


class _Writer(DefaultParamsWriter):
    """Parameters, then the tables; ``weights`` replace those of the scorer's folder."""

    def __init__(self, instance: "TextScorer", weights: DataFrame | None = None):
        super().__init__(instance)
        self.weights = weights

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        spark, source = SparkSession.active(), self.instance.getOrDefault("folder")
        for part in PARTS:
            if part == "weights" and self.weights is not None:
                self.weights.write.parquet(os.path.join(path, part))
            elif self.instance.has(part):
                spark.read.parquet(os.path.join(source, part)).write.parquet(os.path.join(path, part))
        spark.read.text(os.path.join(source, "_manifest")).coalesce(1).write.text(os.path.join(path, "_manifest"))


class _Reader(DefaultParamsReader):
    def load(self, path: str) -> "TextScorer":
        return super().load(path)._set(folder=path)


class TextScorer(Transformer, MLReadable, MLWritable):
    """``folder`` holds the tables and the manifest; ``link`` is ``logistic``
    (probability of class 1) or ``identity`` (margin)."""

    folder = Param(Params._dummy(), "folder", "tables and manifest of the fit", TypeConverters.toString)
    link = Param(Params._dummy(), "link", "logistic or identity", TypeConverters.toString)

    @keyword_only
    def __init__(self, folder: str | None = None, link: str = "logistic"):
        super().__init__()
        self._setDefault(link="logistic")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def manifest(self) -> dict:
        return json.loads(SparkSession.active().read.text(os.path.join(self.getOrDefault("folder"), "_manifest")).first().value)

    def has(self, part: str) -> bool:
        return part != "selected" or self.manifest()["params"]["features"]["selection"]

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """``doc_id``, ``score``, ``prediction`` of every row of ``(doc_id, text)``."""
        folder = self.getOrDefault("folder")
        packed = transform_texts(dataset.select("doc_id", "text"), folder)
        weights = dataset.sparkSession.read.parquet(os.path.join(folder, "weights"))
        out = pa_scores(packed, weights, self.manifest()["size"], keep=())
        if self.getOrDefault("link") == "logistic":
            out = out.withColumn("score", 1.0 / (1.0 + F.exp(-F.col("score"))))
        return out


def save_scorer(features_path: str, weights: DataFrame, link: str, path: str) -> TextScorer:
    """A scorer of a stored feature set and a weight table, saved in ``path`` and loaded from there."""
    _Writer(TextScorer(folder=features_path, link=link), weights).save(path)
    return TextScorer.load(path)
