"""Shared guards: broadcast or collect only what has a checked size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Row bounds for small side tables (lexicon, lemma table, class priors, the
# selected-feature map). Above them the operators take their shuffle path.
BROADCAST_MAX_ROWS = 2_000_000
INLINE_MAX_ROWS = 20_000
# Bytes of a side table with texts of any length, measured before it is broadcast.
BROADCAST_MAX_BYTES = 64 << 20


def row_count_at_most(df: DataFrame, bound: int) -> int | None:
    """Number of rows if it is at most ``bound``, else None. Reads at most
    ``bound + 1`` rows' worth of output, never the whole table twice."""
    n = df.limit(bound + 1).count()
    return n if n <= bound else None


def sized_broadcast(df: DataFrame, bound: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast hint only behind a row-count check; otherwise the plain
    frame, so the planner (and AQE) choose a shuffle join."""
    return F.broadcast(df) if row_count_at_most(df, bound) is not None else df


def collect_bounded(df: DataFrame, bound: int, what: str) -> list:
    """Collect a small table to the driver, refusing if it exceeds ``bound``."""
    rows = df.limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"{what}: more than {bound} rows, refusing to collect")
    return rows


def spread(df: DataFrame, scan: DataFrame | None = None, key: str = "doc_id", factor: int = 2) -> DataFrame:
    """Hash-partition ``df`` by ``key`` when the table scan it comes from (``df``
    itself by default) has fewer files than the cluster has cores (a parquet
    file of one row group is one task). Decided from the file listing that the
    scan holds already: no plan is run. With more files than cores nothing is
    added: no shuffle at scale."""
    want = df.sparkSession.sparkContext.defaultParallelism
    if len((df if scan is None else scan).inputFiles()) >= want:
        return df
    return df.repartition(want * factor, key)
