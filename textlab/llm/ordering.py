"""Positions of rows in their group, for groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlab.llm.shared import written


def ordered(df: DataFrame, group: str, order: list[str | Column], what: str) -> DataFrame:
    """The rows of ``df``, written once, with ``_id`` (ascending in the order of
    (group, *order)) and ``_part`` (the range of that order a row is in).

    The rows are cut into ranges of the whole order, so one group may spread over
    many tasks, and the sort inside a range spills. Writing fixes the ranges: a
    lost task can't renumber them.
    """
    keys = [F.col(group).asc_nulls_first(), *order]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    return written(rows.withColumn("_id", F.monotonically_increasing_id())
                   .withColumn("_part", F.spark_partition_id()), what)


def positions(rows: DataFrame, group: str, out: str) -> DataFrame:
    """``ordered`` rows with their position in the group, from 0, as ``out``.

    A range holds a group's rows in one run, so a position is the place in the run
    and the rows of the group in earlier ranges. Only runs are carried on: one for
    each group and range. ``group`` must not be null.
    """
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = (rows.groupBy(group, "_part").agg(F.min("_id").alias("_first"), F.count("*").alias("_n"))
            .select(group, "_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    return (rows.join(runs, [group, "_part"])
            .withColumn(out, F.col("_before") + F.col("_id") - F.col("_first")).drop("_before", "_first"))
