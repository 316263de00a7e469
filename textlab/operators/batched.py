"""Many linear fits in the same passes over the rows.

A search fits one model for each candidate and fold. Here they advance in step: each
pass over the rows takes one trial point of every unfinished fit and gives its loss
and gradient, so a pass costs one Spark job whatever the number of fits, and the
rows are read once for all of them. A fit leaves out the rows of its own fold; one
last pass counts its hits and misses on them.

The rows are packed once, by about ``ENTRIES`` features, and the passes read those packs:
what many rows of a pack have is a dense matrix, whose products with all fits are matrix
products; the rest is kept by row and by feature. A pass does no work in Python for a
single row. Class weights, signs and folds are tables by the code of (fold, label).

Each fit minimises ``penalty(w) + C * sum(s_i * loss(y_i * m_i))`` by L-BFGS with
backtracking, where loss is logistic, hinge or squared hinge and the penalty is
``|w|^2 / 2`` or ``|w|_1`` (OWL-QN: Andrew and Gao, 2007). Gradients are summed by
blocks of ``BLOCK`` features in parallel. The driver holds a vector of one value a
feature and the last ``MEMORY`` steps for each fit, and never a row.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from .models import ModelSpec
from .squared_hinge import HALVINGS, MEMORY, _direction

#: Features of a block of gradients, and entries of rows worked on at a time.
BLOCK, ENTRIES = 1024, 8_000
#: Share of the rows of a pack from which a feature is a column of its dense matrix.
COMMON = 0.1
#: A pack: the rows' codes, the dense features and their matrix; the other features by row
#: (feature and value, which rows have some and where each one's begin) and by feature.
PACK = {"code": np.int64, "dense_idx": np.int64, "dense": np.float64,
        "idx": np.int64, "val": np.float64, "rows": np.int64, "heads": np.int64,
        "row_of": np.int64, "val_of": np.float64, "ids": np.int64, "firsts": np.int64}
#: Relative change of the objective that counts as none.
ROUNDING = 1e-10


@dataclass
class Fit:
    """One model of a batch and where its search stands."""

    spec: ModelSpec
    fold: object
    weights: dict              # class weights by label
    w: np.ndarray
    value: float = np.inf
    grad: np.ndarray | None = None
    steps: deque = field(default_factory=lambda: deque(maxlen=MEMORY))
    way: np.ndarray | None = None
    slope: float = 0.0
    length: float = 0.0
    halved: int = 0
    taken: int = 0
    enough: float = 0.0
    done: bool = False

    def __post_init__(self) -> None:
        # The intercept, the last place, is penalised where the fit of one model penalises it.
        self.pen = np.ones(len(self.w))
        self.pen[-1] = 1.0 if self.loss == "squared_hinge" else 0.0

    @property
    def l1(self) -> bool:
        return self.spec.name == "logreg" and self.spec.penalty == "l1"

    @property
    def loss(self) -> str:
        return "logistic" if self.spec.name == "logreg" else self.spec.loss

    def trial(self) -> np.ndarray:
        if self.way is None:
            return self.w
        new = self.w + self.length * self.way
        if self.l1:  # stay in the orthant of the step
            side = np.where(self.w != 0, np.sign(self.w), -np.sign(self.descent()))
            new[(np.sign(new) != side) & (self.pen > 0)] = 0.0
        return new

    def descent(self) -> np.ndarray:
        """The gradient, or with the absolute values of l1 the steepest subgradient."""
        if not self.l1:
            return self.grad
        g = self.grad + self.pen * np.sign(self.w)
        flat = (self.w == 0) & (self.pen > 0)
        g[flat] = np.sign(self.grad[flat]) * np.maximum(0.0, np.abs(self.grad[flat]) - 1.0)
        return g

    def told(self, loss: float, data_grad: np.ndarray) -> None:
        """Loss and gradient of the data at the trial point: take the step or shorten it."""
        new = self.trial()
        value = self.spec.C * loss + (
            float(self.pen @ np.abs(new)) if self.l1 else 0.5 * float((self.pen * new) @ new))
        grad = self.spec.C * data_grad + (0.0 if self.l1 else self.pen * new)
        if self.way is not None:
            gain = float(self.descent() @ (new - self.w)) if self.l1 else self.length * self.slope
            if value > self.value + 1e-4 * gain:
                self.length, self.halved = self.length / 2, self.halved + 1
                self.done = self.halved > HALVINGS or abs(gain) <= ROUNDING * max(1.0, abs(self.value))
                return
            if (new - self.w) @ (grad - self.grad) > 0:
                self.steps.append((new - self.w, grad - self.grad))
            self.taken += 1
        settled = abs(self.value - value) <= ROUNDING * max(1.0, abs(value))
        self.w, self.value, self.grad, self.halved = new, value, grad, 0
        down = self.descent()
        norm = float(np.linalg.norm(down))
        if self.way is None:
            self.enough = self.spec.tol * norm
        if norm <= self.enough or settled or self.taken >= self.spec.max_iter:
            self.done = True
            return
        self.way = _direction(down, self.steps)
        if self.l1:
            self.way[(self.way * down >= 0) & (self.pen > 0)] = 0.0
        self.slope = float(down @ self.way)
        self.length = 1.0 if self.steps else min(1.0, 1.0 / norm)


def _losses(kinds: list[str]):
    """Loss and derivative of a matrix of signed margins, a column a fit."""
    columns = [(k, np.flatnonzero([x == k for x in kinds])) for k in sorted(set(kinds))]

    def one(kind: str, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if kind == "logistic":
            small = np.exp(-np.abs(z))
            return np.maximum(0.0, -z) + np.log1p(small), -np.where(z > 0, small, 1.0) / (1.0 + small)
        slack = np.maximum(0.0, 1.0 - z)
        return (slack * slack, -2.0 * slack) if kind == "squared_hinge" else (slack, -(z < 1.0).astype(float))

    def run(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(columns) == 1:
            return one(columns[0][0], z)
        value, slope = np.empty_like(z), np.empty_like(z)
        for kind, at in columns:
            value[:, at], slope[:, at] = one(kind, z[:, at])
        return value, slope
    return run


def _packed(size: int):
    """Batches of rows (code, indices, values) as packs; the intercept is a feature of all rows."""
    entries, common, kinds = ENTRIES, COMMON, PACK

    def pack(code, lens, idx, val):
        n = len(code)
        row = np.repeat(np.arange(n, dtype=np.int32), lens)
        used, at, many = np.unique(idx, return_inverse=True, return_counts=True)
        wide = many >= common * n
        place = np.cumsum(wide) - 1
        dense_idx = np.append(used[wide], size)
        dense = np.zeros((n, len(dense_idx)))
        dense[:, -1] = 1.0
        here = wide[at]
        np.add.at(dense, (row[here], place[at[here]]), val[here])
        row, idx, val = row[~here], idx[~here], val[~here]
        order, heads = np.argsort(idx, kind="stable"), runs(row)
        firsts = runs(idx[order])
        return {"code": code, "dense_idx": dense_idx, "dense": dense, "idx": idx, "val": val, "rows": row[heads], "heads": heads,
                "row_of": row[order], "val_of": val[order], "ids": idx[order][firsts], "firsts": firsts}

    def runs(ids):
        """Where the runs of equal ids begin."""
        return np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])) if len(ids) else np.empty(0, np.int64)

    def run(batches):
        for batch in batches:
            lens = pc.fill_null(pc.list_value_length(batch.column("indices")), 0).to_numpy().astype(np.int64)
            idx = batch.column("indices").flatten().to_numpy().astype(np.int64)
            val = batch.column("values").flatten().to_numpy().astype(np.float64)
            code = batch.column("code").to_numpy().astype(np.int32)
            ends, begins, lo, out = np.cumsum(lens + 1), np.append(0, np.cumsum(lens)), 0, []
            while lo < len(lens):
                hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + entries, "right")))
                a, b = begins[lo], begins[hi]
                out.append(pack(code[lo:hi], lens[lo:hi], idx[a:b], val[a:b]))
                lo = hi
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(x[c], k).tobytes() for x in out], pa.binary())
                                                  for c, k in kinds.items()], [*kinds])
    return run


def _packs(batches):
    """The packs of a task's batches, as arrays."""
    for batch in batches:
        for k in range(batch.num_rows):
            x = {c: np.frombuffer(batch.column(c)[k].as_buffer(), kind) for c, kind in PACK.items()}
            x["dense"] = x["dense"].reshape(len(x["code"]), -1)
            yield x


class _Sums:
    """Sums of weighted rows of a matrix, in one buffer: a fresh one of this size each time
    costs more than the sums."""

    def __init__(self):
        self.buffer = np.empty(0)

    def __call__(self, matrix: np.ndarray, at: np.ndarray, val: np.ndarray, begins: np.ndarray) -> np.ndarray:
        n = len(at) * matrix.shape[1]
        if len(self.buffer) < n:
            self.buffer = np.empty(n)
        taken = self.buffer[:n].reshape(len(at), -1)
        np.take(matrix, at, axis=0, out=taken, mode="clip")
        np.multiply(taken, val[:, None], out=taken)
        return np.add.reduceat(taken, begins, axis=0)


def _margin(x: dict, w: np.ndarray, sums: _Sums) -> np.ndarray:
    out = x["dense"] @ w[x["dense_idx"]]
    if len(x["idx"]):
        out[x["rows"]] += sums(w, x["idx"], x["val"], x["heads"])
    return out


def _pass(size: int, sent, kinds: list[str], sign: np.ndarray, share: np.ndarray):
    """Partial losses and gradients of all fits, a row a block of features; the block
    -1 holds the losses. ``sign`` and ``share`` (the weight of a row in a fit) are by code."""
    run_losses, pull_of = _losses(kinds), share * sign[:, None]

    def run(batches):
        w = sent.value  # (size + 1, fits)
        grad, loss, sums = np.zeros_like(w), np.zeros(w.shape[1]), _Sums()
        for x in _packs(batches):
            value, slope = run_losses(sign[x["code"]][:, None] * _margin(x, w, sums))
            loss += np.einsum("ij,ij->j", share[x["code"]], value)
            slope *= pull_of[x["code"]]
            grad[x["dense_idx"]] += x["dense"].T @ slope
            if len(x["idx"]):
                grad[x["ids"]] += sums(slope, x["row_of"], x["val_of"], x["firsts"])
        blocks = [b for b in range(0, size + 1, BLOCK) if grad[b:b + BLOCK].any()]
        yield pa.RecordBatch.from_arrays([pa.array([-1, *(b // BLOCK for b in blocks)], pa.int64()),
                                          pa.array([loss.tobytes(), *(grad[b:b + BLOCK].tobytes() for b in blocks)], pa.binary())],
                                         ["block", "g"])
    return run


def _summed(key, parts: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"block": [key[0]], "g": [sum(np.frombuffer(g) for g in parts["g"]).tobytes()]})


def _hits(sent, own: np.ndarray, toxic: np.ndarray):
    """Of each fit the (true and false positives, false negatives) on its own fold;
    ``own`` and ``toxic`` are by code."""
    def run(batches):
        w, sums = sent.value, _Sums()
        out = np.zeros((3, w.shape[1]), np.int64)
        for x in _packs(batches):
            said, mine, bad = _margin(x, w, sums) > 0, own[x["code"]], toxic[x["code"]][:, None]
            for k, what in enumerate((said & bad, said & ~bad, ~said & bad)):
                out[k] += (what & mine).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.arange(w.shape[1]), *out)], ["fit", "tp", "fp", "fn"])
    return run


def fit_folds(rows: DataFrame, size: int, specs: list[ModelSpec], folds: list, fold_col: str = "fold",
              label: str = "label") -> tuple[np.ndarray, int]:
    """(F1 of class 1 by spec and fold, passes over the rows). ``rows`` hold ``features``
    as the stored sparse struct (indices, values)."""
    spark = rows.sparkSession
    counts: dict = {}
    for r in rows.groupBy(F.col(fold_col).alias("fold"), F.col(label).alias("label")).count().collect():
        counts.setdefault(r.fold, {})[r.label] = r["count"]
    codes = [(f, c) for f, own in counts.items() for c in own]
    code = F.lit(0)
    for k, (f, c) in enumerate(codes):
        code = F.when(F.col(fold_col).eqNullSafe(F.lit(f)) & F.col(label).eqNullSafe(F.lit(c)), k).otherwise(code)
    data = (rows.select(code.cast("int").alias("code"), F.col("features.indices").alias("indices"), F.col("features.values").alias("values"))
            .mapInArrow(_packed(size), ", ".join(f"{c} binary" for c in PACK)).persist(StorageLevel.MEMORY_AND_DISK))
    toxic = np.array([c == 1 for _, c in codes], bool)
    sign = np.where(toxic, 1.0, -1.0)
    fits = []
    for spec in specs:
        for fold in folds:
            by: dict = {}
            for f, own in counts.items():
                if f != fold:
                    for c, n in own.items():
                        by[c] = by.get(c, 0) + n
            weights = {c: sum(by.values()) / (len(by) * n) for c, n in by.items()} if spec.class_weight == "balanced" else {}
            fits.append(Fit(spec, fold, weights, np.zeros(size + 1)))
    share = np.array([[0.0 if f == x.fold else x.weights.get(c, 1.0) for x in fits] for f, c in codes]).reshape(-1, len(fits))
    own = np.array([[f == x.fold for x in fits] for f, _ in codes], bool).reshape(-1, len(fits))
    passes = 0
    try:
        while live := [f for f in fits if not f.done]:
            at = [k for k, f in enumerate(fits) if not f.done]
            sent = spark.sparkContext.broadcast(np.column_stack([f.trial() for f in live]))
            parts = data.mapInArrow(_pass(size, sent, [f.loss for f in live], sign, share[:, at]), "block long, g binary")
            got = {r.block: np.frombuffer(r.g).reshape(-1, len(live)) for r in
                   parts.groupBy("block").applyInPandas(_summed, "block long, g binary").collect()}
            sent.destroy()
            passes += 1
            grad = np.zeros((size + 1, len(live)))
            for b, g in got.items():
                if b >= 0:
                    grad[b * BLOCK:b * BLOCK + len(g)] = g
            for k, f in enumerate(live):
                f.told(float(got[-1][0, k]), grad[:, k].copy())
        sent = spark.sparkContext.broadcast(np.column_stack([f.w for f in fits]))
        hits = (data.mapInArrow(_hits(sent, own, toxic), "fit long, tp long, fp long, fn long")
                .groupBy("fit").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn")).collect())
        sent.destroy()
    finally:
        data.unpersist()
    f1 = np.zeros(len(fits))
    for r in hits:
        f1[r.fit] = 2 * r.tp / (2 * r.tp + r.fp + r.fn) if r.tp else 0.0
    return f1.reshape(len(specs), len(folds)), passes + 1
