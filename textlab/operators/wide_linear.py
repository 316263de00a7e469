"""Linear models wider than the driver: L-BFGS whose vectors are all tables.

Minimises ``|w|^2 / 2 + C * sum(s_i * loss(y_i * m_i))`` with the squared hinge or
the logistic loss. The data are cut into a grid: rows into blocks of ``ROW_BLOCK``,
features into blocks of ``FEATURE_BLOCK``, so that a cell meets one block of weights
and one block of rows. An evaluation is two passes over the cells:

* margins: each cell gives partial dot products of its rows, summed by row block;
  there the loss and its derivative by row follow;
* gradient: each cell takes the derivatives of its rows and gives the partial
  gradient of its features, summed by feature block.

Weights, gradient and the last ``MEMORY`` steps and gradient changes are one table,
a row a feature block. The two-loop recursion needs only their dot products (Chen et
al., 2014): each block gives its share of the Gram matrix, the driver sees the sum,
``2 * MEMORY + 1`` squared numbers, and answers with as many coefficients. So the
driver holds no vector of the model, and a task holds the vectors of one block.
Lineage ends with the tables written at every evaluation.

Rows without features count through the intercept, a penalised constant feature with
``idx = size``. An empty table gives an empty weight table.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from ..session import scratch_dir
from .models import ModelSpec, class_weights

ROW_BLOCK, FEATURE_BLOCK, MEMORY, HALVINGS = 4096, 1 << 16, 10, 30


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _loss(name: str):
    """(loss, derivative) by y * margin."""
    if name == "squared_hinge":
        return lambda z: (np.maximum(0.0, 1.0 - z) ** 2, -2.0 * np.maximum(0.0, 1.0 - z))
    if name == "logistic":
        return lambda z: (np.logaddexp(0.0, -z), -1.0 / (1.0 + np.exp(np.minimum(z, 700.0))))
    raise ValueError(f"{name} is not a loss of this fit: squared_hinge or logistic")


def _sum_arrays(arrays, length: int) -> np.ndarray:
    out = np.zeros(length)
    for a in arrays:
        out[:len(a)] += a
    return out


def _grid(train: DataFrame, size: int, balance: Column, key: str, label: str) -> tuple[DataFrame, DataFrame, int]:
    """(cells, row blocks, feature blocks). A cell: rb, fb and its entries as arrays
    (place of the row in rb, place of the feature in fb, value)."""
    n = train.count()
    blocks = max(1, -(-n // ROW_BLOCK))
    rows = train.select(F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int").alias("rb"), F.col(key).alias("id"),
                        F.col("features.indices").alias("i"), F.col("features.values").alias("x"),
                        F.when(F.col(label) == 1, 1.0).otherwise(-1.0).alias("y"), balance.alias("s"))
    rows = _kept(rows.withColumn("r", F.row_number().over(Window.partitionBy("rb").orderBy("id")) - 1), "wide-rows")
    entries = rows.select("rb", "r", F.explode(F.arrays_zip(
        F.concat(F.col("i").cast("array<long>"), F.array(F.lit(size).cast("long"))).alias("i"),
        F.concat("x", F.array(F.lit(1.0))).alias("x"))).alias("e"))
    cells = (entries.select("rb", F.expr(f"cast(e.i div {FEATURE_BLOCK} as int)").alias("fb"), "r",
                            (F.col("e.i") % FEATURE_BLOCK).cast("int").alias("j"), F.col("e.x").alias("x"))
             .groupBy("rb", "fb").agg(F.collect_list("r").alias("r"), F.collect_list("j").alias("j"), F.collect_list("x").alias("x")))
    return (cells.repartition("rb", "fb").persist(StorageLevel.MEMORY_AND_DISK),
            rows.select("rb", "r", "y", "s"), -(-(size + 1) // FEATURE_BLOCK))


_STATE = "fb int, w array<double>, g array<double>, steps array<array<double>>, changes array<array<double>>, gram array<double>"


def _vectors(state) -> list[np.ndarray]:
    """Steps, changes and the gradient of a block, in the order of the Gram matrix."""
    return [*map(np.asarray, state.steps), *map(np.asarray, state.changes), np.asarray(state.g)]


def _direction(gram: np.ndarray) -> np.ndarray:
    """Coefficients of the step over (steps, changes, gradient), by the two-loop
    recursion on dot products alone."""
    k = (len(gram) - 1) // 2
    c = np.zeros(len(gram))
    c[-1] = -1.0
    kept = np.zeros(k)
    for i in reversed(range(k)):
        kept[i] = c @ gram[:, i] / gram[i, k + i]
        c[k + i] -= kept[i]
    if k:
        c *= gram[k - 1, 2 * k - 1] / gram[2 * k - 1, 2 * k - 1]
    for i in range(k):
        c[i] += kept[i] - c @ gram[:, k + i] / gram[i, k + i]
    return c


def fit_wide(train: DataFrame, size: int, spec: ModelSpec = ModelSpec("lsvc", loss="squared_hinge"),
             loss: str = "squared_hinge", key: str = "doc_id", label: str = "label") -> DataFrame:
    """``train`` holds ``features`` as the stored sparse struct (indices, values). Returns
    the weight table ``(idx, w)``; ``idx = size`` is the intercept. Ends when the gradient
    has shrunk to ``spec.tol`` of that at zero, or after ``spec.max_iter`` steps."""
    spark = train.sparkSession
    balance = F.lit(1.0)
    if spec.class_weight == "balanced":
        for c, v in class_weights(train, label).items():
            balance = F.when(F.col(label) == c, F.lit(v)).otherwise(balance)
    cells, row_table, n_blocks = _grid(train, size, balance, key, label)
    lengths = [min(FEATURE_BLOCK, size + 1 - b * FEATURE_BLOCK) for b in range(n_blocks)]
    places = _kept(cells.select("rb", "fb"), "wide-places")
    of_loss, C = _loss(loss), spec.C

    def candidate(state, coefs: np.ndarray, t: float) -> np.ndarray:
        return np.asarray(state.w) + t * sum(c * v for c, v in zip(coefs, _vectors(state)))

    def moved(coefs: np.ndarray, t: float):
        def run(batches):
            for pdf in batches:
                yield pd.DataFrame({"fb": pdf["fb"], "w": [candidate(r, coefs, t) for r in pdf.itertuples()]})
        return run

    def dots(key_, cell: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(cell):
            return pd.DataFrame({"rb": pd.Series(dtype="int32"), "m": pd.Series(dtype=object)})
        c = cell.iloc[0]
        return pd.DataFrame({"rb": [key_[0]], "m": [np.bincount(c.r, c.x * np.asarray(block["w"].iloc[0])[c.j])]})

    def slopes(key_, parts: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("r")
        y, s = rows["y"].to_numpy(), rows["s"].to_numpy()
        value, slope = of_loss(y * _sum_arrays(parts["m"], len(rows)))
        return pd.DataFrame({"rb": [key_[0]], "pull": [s * y * slope], "loss": [float(s @ value)]})

    def shares(key_, cell: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(cell):
            return pd.DataFrame({"fb": pd.Series(dtype="int32"), "g": pd.Series(dtype=object)})
        c = cell.iloc[0]
        return pd.DataFrame({"fb": [key_[1]], "g": [np.bincount(c.j, c.x * np.asarray(rows["pull"].iloc[0])[c.r])]})

    def advanced(coefs: np.ndarray, t: float):
        def run(_, parts: pd.DataFrame, states: pd.DataFrame) -> pd.DataFrame:
            old = next(states.itertuples())
            w = candidate(old, coefs, t)
            g = w + C * _sum_arrays(parts["g"], len(w))
            steps, changes = [np.asarray(x) for x in old.steps], [np.asarray(x) for x in old.changes]
            if t:
                steps, changes = [*steps, w - np.asarray(old.w)], [*changes, g - np.asarray(old.g)]
            steps, changes = steps[-MEMORY:], changes[-MEMORY:]
            all_ = np.array([*steps, *changes, g])
            gram = np.append((all_ @ all_.T).ravel(), w @ w)
            return pd.DataFrame({"fb": [old.fb], "w": [w], "g": [g], "steps": [steps], "changes": [changes], "gram": [gram]})
        return run

    def evaluate(state: DataFrame, coefs: np.ndarray, t: float) -> tuple[float, DataFrame]:
        """(loss over all rows, pulls by row block) at the candidate weights."""
        blocks = state.mapInPandas(moved(coefs, t), "fb int, w array<double>")
        sent = places.join(blocks, "fb")
        parts = cells.groupBy("rb", "fb").cogroup(sent.groupBy("rb", "fb")).applyInPandas(dots, "rb int, m array<double>")
        seen = Observation()
        pulls = parts.groupBy("rb").cogroup(row_table.groupBy("rb")).applyInPandas(
            slopes, "rb int, pull array<double>, loss double").observe(seen, F.sum("loss").alias("loss"))
        pulls = _kept(pulls, "wide-pulls")
        return seen.get["loss"], pulls

    def accept(state: DataFrame, pulls: DataFrame, coefs: np.ndarray, t: float) -> tuple[DataFrame, np.ndarray, float]:
        """(the next state, its Gram matrix, squared norm of its weights)."""
        sent = places.join(pulls, "rb")
        parts = cells.groupBy("rb", "fb").cogroup(sent.groupBy("rb", "fb")).applyInPandas(shares, "fb int, g array<double>")
        state = _kept(parts.groupBy("fb").cogroup(state.groupBy("fb")).applyInPandas(advanced(coefs, t), _STATE), "wide-state")
        sums = state.select(F.posexplode("gram")).groupBy("pos").agg(F.sum("col").alias("v")).orderBy("pos").collect()
        flat = np.array([r.v for r in sums])
        n = int(np.sqrt(len(flat) - 1))
        return state, flat[:-1].reshape(n, n), float(flat[-1])

    try:
        if not row_table.limit(1).count():
            return spark.createDataFrame([], "idx long, w double")
        state = spark.range(n_blocks).select(F.col("id").cast("int").alias("fb")).mapInPandas(
            _zeros(lengths), _STATE)
        start = np.zeros(1)
        total, pulls = evaluate(state, start, 0.0)
        state, gram, squared = accept(state, pulls, start, 0.0)
        value, enough = C * total + 0.5 * squared, spec.tol * float(np.sqrt(gram[-1, -1]))
        for _ in range(spec.max_iter):
            if np.sqrt(gram[-1, -1]) <= enough:
                break
            coefs = _direction(gram)
            slope = float(coefs @ gram[:, -1])
            t = 1.0 if len(gram) > 1 else min(1.0, 1.0 / float(np.sqrt(gram[-1, -1])))
            for _ in range(HALVINGS):
                total, pulls = evaluate(state, coefs, t)
                nxt, new_gram, squared = accept(state, pulls, coefs, t)
                new_value = C * total + 0.5 * squared
                if new_value <= value + 1e-4 * t * slope:
                    break
                t /= 2
            else:
                break
            state, gram, value = nxt, new_gram, new_value
            k = (len(gram) - 1) // 2
            if gram[k - 1, 2 * k - 1] <= 0:  # no curvature along the last step: begin anew from here
                state, gram = state.withColumns({"steps": F.array().cast("array<array<double>>"),
                                                 "changes": F.array().cast("array<array<double>>")}), gram[-1:, -1:]
        return state.select("fb", F.posexplode("w")).select(
            (F.col("fb").cast("long") * FEATURE_BLOCK + F.col("pos")).alias("idx"), F.col("col").alias("w")).where("w <> 0")
    finally:
        cells.unpersist()


def _zeros(lengths: list[int]):
    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"fb": pdf["fb"], "w": [np.zeros(lengths[b]) for b in pdf["fb"]],
                                "g": [np.zeros(lengths[b]) for b in pdf["fb"]], "steps": [[] for _ in pdf["fb"]],
                                "changes": [[] for _ in pdf["fb"]], "gram": [[] for _ in pdf["fb"]]})
    return run
