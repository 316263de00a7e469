"""The texts are scored once."""

from paths import SF001
from textlab.plans.catalog import QUERIES


def test_error_topk_scores_texts_once(spark):
    out = QUERIES["error_topk"](spark, SF001)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "[a-z]+" not in plan  # was: each kind of error normalised and scored the texts again
    rows = out.collect()
    assert rows and all(r.y_true != r.y_pred for r in rows)
