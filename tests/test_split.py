"""Stratified split and folds."""

from pyspark.sql import functions as F

from paths import SF01
from textlab.operators.split import round_share, stratified_split
from textlab.sources.io import read_labelled


def test_split_counts_sf001(spark):
    s = stratified_split(read_labelled(spark, SF01), seed=1337)
    got = {(r.split, r.label): r["count"] for r in s.groupBy("split", "label").count().collect()}
    assert got == {("test", 0): 35, ("test", 1): 5, ("val", 0): 31, ("val", 1): 5,
                   ("train", 0): 282, ("train", 1): 41}


def test_split_partitions_input_and_folds(spark):
    d = read_labelled(spark, SF01)
    s = stratified_split(d.repartition(3), seed=7, folds=3)
    assert s.count() == d.count() and s.select("doc_id").distinct().count() == d.count()
    f = {(r.fold, r.label): r["count"] for r in s.where(F.col("split") == "train").groupBy("fold", "label").count().collect()}
    for lab in (0, 1):
        sizes = [f[(k, lab)] for k in range(3)]
        assert max(sizes) - min(sizes) <= 1


def test_split_invariant_to_partitioning(spark):
    d = read_labelled(spark, SF01)
    a = {r.doc_id: (r.split, r.fold) for r in stratified_split(d, seed=3).collect()}
    b = {r.doc_id: (r.split, r.fold) for r in stratified_split(d.repartition(7), seed=3).collect()}
    assert a == b


def test_round_share():
    assert round_share(348, 0.1) == 35 and round_share(51, 0.1) == 5 and round_share(25, 0.1) == 3
