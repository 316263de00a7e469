"""Deterministic stratified train/val/test split and stratified folds.

Rows are ordered inside each class by ``md5('<seed>:<doc_id>')`` (the same
hex string in Spark and DuckDB). Class c puts its first
``round(frac * n_c)`` rows in ``test``, the next ``round(frac * rest)`` in
``val``, the remainder in ``train``; train rows are cut into ``folds``
contiguous blocks in the same order.

No window ever ranks a whole class. The boundary rows are exact order statistics,
found in two jobs at any size: one aggregation counts each class and sketches its
keys (KLL, mergeable), and brackets every wanted rank between two sketched quantiles;
the next one counts the rows below each bracket and in fine bins inside it. A third
job reads the keys of a bin that holds several. A bracket that missed its rank (the
counts show it) is opened and counted again, so the sketch never decides. The split
of a row is then a comparison of its key with a few literal cut keys: a projection,
no shuffle, works on any table holding ``doc_id`` and ``label``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import collect_bounded

MAX_CLASSES = 1000
_MICRO = 1_000_000


def hash_key(seed: int, key: str = "doc_id") -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def round_share(n: int, frac: float) -> int:
    """``round(n * frac)`` with halves up, in exact integer arithmetic."""
    return (n * round(frac * _MICRO) + _MICRO // 2) // _MICRO


def fold_ends(m: int, k: int) -> list[int]:
    """Rank (1-based, within the class's train rows) of the last row of folds
    0..k-2 when fold = floor((rank - 1) * k / m)."""
    return [-(-(f + 1) * m // k) for f in range(k - 1)]


#: Hex digits of a key that make its number: 60 bits, so it fits a long.
NUMBER_DIGITS = 15
#: Quantiles read from a sketch, its size, and bins a bracket.
GRID, SKETCH_SIZE, BINS = 256, 2000, 1 << 14
#: Keys of one bin that are read one by one.
READ_KEYS = 10_000


def _number(key: Column) -> Column:
    return F.conv(F.substring(key, 1, NUMBER_DIGITS), 16, 10).cast("long")


def key_grids(df: DataFrame, key: Column, group: Column) -> dict:
    """``{group: (rows, GRID + 1 quantiles of the keys' numbers)}`` in one aggregation."""
    grid = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
    sketched = (df.select(group.alias("g"), _number(key).alias("k")).groupBy("g")
                .agg(F.count("*").alias("n"), F.kll_sketch_agg_bigint("k", F.lit(SKETCH_SIZE)).alias("s"))
                .select("g", "n", F.kll_sketch_get_quantile_bigint("s", grid).alias("q")))
    return {r.g: (r.n, r.q) for r in collect_bounded(sketched, MAX_CLASSES, "classes")}


def _bracket(rank: int, n: int, grid: list[int]) -> tuple[int, int]:
    """Two grid points that should enclose a rank, one more to each side; open at the ends."""
    at = rank * GRID // n
    return (grid[at - 1] if at > 1 else 0), (grid[at + 2] if at + 2 < GRID else (1 << 4 * NUMBER_DIGITS) - 1)


def order_statistics(df: DataFrame, key: Column, group: Column, wanted: dict, grids: dict | None = None) -> dict:
    """Exact keys at 1-based ranks: ``wanted = {group: [rank, ...]}`` ->
    ``{(group, rank): key}``. Keys are hex strings of one length; rows with equal
    keys fall on the same side of a cut."""
    spark = df.sparkSession
    d = df.select(group.alias("g"), key.alias("key"))
    grids = grids or key_grids(df, key, group)
    todo = {}
    for g, ranks in wanted.items():
        for r in ranks:
            if not 1 <= r <= grids.get(g, (0, []))[0]:
                raise ValueError(f"rank {r} beyond the rows of class {g}")
            todo[(g, r)] = _bracket(r, *grids[g])
    done: dict = {}
    full = (0, (1 << 4 * NUMBER_DIGITS) - 1)
    kind = d.schema["g"].dataType.simpleString()
    while todo:
        targets = spark.createDataFrame([(g, r, lo, hi, (hi - lo) // BINS + 1) for (g, r), (lo, hi) in todo.items()],
                                        f"g {kind}, rank long, lo long, hi long, step long")
        k = F.col("k")
        bins = (d.withColumn("k", _number(F.col("key"))).join(F.broadcast(targets), "g").where("k <= hi")
                .withColumn("bin", F.when(k < F.col("lo"), -1).otherwise(F.expr("(k - lo) div step")))
                .groupBy("g", "rank", "bin")
                .agg(F.count("*").alias("n"), F.min("key").alias("least"), F.max("key").alias("most")))
        upto = F.sum("n").over(Window.partitionBy("g", "rank").orderBy("bin"))
        hits = (bins.withColumn("upto", upto).where("upto >= rank").groupBy("g", "rank")
                .agg(F.min_by(F.struct("bin", "n", "least", "most", "upto"), "bin").alias("b")).select("g", "rank", "b.*"))
        found = {(r.g, r["rank"]): r for r in hits.collect()}
        read, nxt = [], {}
        for target in todo:
            r = found.get(target)
            if r is None or r.bin < 0:
                nxt[target] = full  # the bracket missed its rank
            elif r.least == r.most:
                done[target] = r.least
            elif r.n <= READ_KEYS or r.least[:NUMBER_DIGITS] == r.most[:NUMBER_DIGITS]:
                read.append((*target, r.least, r.most, r.upto - r.n))
            else:
                nxt[target] = (int(r.least[:NUMBER_DIGITS], 16), int(r.most[:NUMBER_DIGITS], 16))
        if read:
            few = spark.createDataFrame(read, f"g {kind}, rank long, least string, most string, below long")
            keys = (d.join(F.broadcast(few), "g").where("key between least and most")
                    .groupBy("g", "rank", "key", "below").agg(F.count("*").alias("n")))
            upto = F.col("below") + F.sum("n").over(Window.partitionBy("g", "rank").orderBy("key"))
            for r in (keys.withColumn("upto", upto).where("upto >= rank").groupBy("g", "rank")
                      .agg(F.min("key").alias("key")).collect()):
                done[(r.g, r["rank"])] = r.key
        todo = nxt
    return done


@dataclass
class SplitPlan:
    """Cut keys per class: a row of class c with key k is test if
    k <= test_cut[c], val if k <= val_cut[c], else train; its fold is the
    number of fold cuts strictly below k."""
    seed: int
    counts: dict = field(default_factory=dict)
    test_cut: dict = field(default_factory=dict)
    val_cut: dict = field(default_factory=dict)
    fold_cuts: dict = field(default_factory=dict)
    sizes: dict = field(default_factory=dict)


def plan_split(df: DataFrame, seed: int = 1337, test_size: float = 0.1,
               valid_size: float = 0.1, folds: int = 3, key: str = "doc_id",
               label: str = "label", hashed: str | None = None) -> SplitPlan:
    """``hashed``: a column that holds the hash keys already."""
    hashed = hash_key(seed, key) if hashed is None else F.col(hashed)
    grids = key_grids(df, hashed, F.col(label))
    counts = {c: n for c, (n, _) in grids.items()}
    plan = SplitPlan(seed=seed, counts=counts)
    wanted = {}
    for c, n in counts.items():
        n_test = round_share(n, test_size)
        n_val = round_share(n - n_test, valid_size)
        m = n - n_test - n_val
        ends = [n_test + n_val + e for e in fold_ends(m, folds)] if folds > 1 and m > 0 else []
        plan.sizes[c] = (n_test, n_val, m)
        wanted[c] = sorted({r for r in [n_test, n_test + n_val, *ends] if 0 < r <= n})
    stats = order_statistics(df, hashed, F.col(label), wanted, grids)
    for c, n in counts.items():
        n_test, n_val, m = plan.sizes[c]
        plan.test_cut[c] = stats.get((c, n_test), "")
        plan.val_cut[c] = stats.get((c, n_test + n_val), plan.test_cut[c])
        ends = fold_ends(m, folds) if folds > 1 and m > 0 else []
        plan.fold_cuts[c] = [stats[(c, n_test + n_val + e)] for e in ends if n_test + n_val + e > 0]
    return plan


def _per_class(label: Column, values: dict, default) -> Column:
    expr = F.lit(default)
    for c, v in values.items():
        expr = F.when(label == F.lit(c), F.lit(v)).otherwise(expr)
    return expr


def assign_split(df: DataFrame, plan: SplitPlan, key: str = "doc_id",
                 label: str = "label", with_fold: bool = True, hashed: str | None = None) -> DataFrame:
    """Add ``split`` (test/val/train) and, for train rows, ``fold``."""
    k = hash_key(plan.seed, key) if hashed is None else F.col(hashed)
    y = F.col(label)
    split = (F.when(k <= _per_class(y, plan.test_cut, ""), F.lit("test"))
             .when(k <= _per_class(y, plan.val_cut, ""), F.lit("val"))
             .otherwise(F.lit("train")))
    out = df.withColumn("split", split)
    if with_fold:
        fold = F.lit(0)
        width = max((len(v) for v in plan.fold_cuts.values()), default=0)
        for i in range(width):
            cut_i = _per_class(y, {c: v[i] for c, v in plan.fold_cuts.items() if len(v) > i}, None)
            fold = fold + F.when(cut_i.isNotNull() & (k > cut_i), 1).otherwise(0)
        out = out.withColumn("fold", F.when(F.col("split") == "train", fold.cast("int")))
    return out


def stratified_split(df: DataFrame, seed: int = 1337, test_size: float = 0.1,
                     valid_size: float = 0.1, folds: int = 3, key: str = "doc_id",
                     label: str = "label") -> DataFrame:
    plan = plan_split(df, seed, test_size, valid_size, folds, key, label)
    return assign_split(df, plan, key, label)


def split_sql(source: str, seed: int = 1337, test_size: float = 0.1, valid_size: float = 0.1,
              folds: int = 3) -> str:
    """DuckDB statement of the same split (window ranks, for the oracle)."""
    t, v = round(test_size * _MICRO), round(valid_size * _MICRO)
    return (
        f"WITH r AS (SELECT doc_id, label, row_number() OVER (PARTITION BY label ORDER BY "
        f"md5('{seed}:' || CAST(doc_id AS VARCHAR))) AS rn, count(*) OVER (PARTITION BY label) AS n "
        f"FROM {source}), "
        f"s AS (SELECT *, (n * {t} + {_MICRO // 2}) // {_MICRO} AS n_test FROM r), "
        f"u AS (SELECT *, ((n - n_test) * {v} + {_MICRO // 2}) // {_MICRO} AS n_val FROM s) "
        f"SELECT doc_id, label, CASE WHEN rn <= n_test THEN 'test' WHEN rn <= n_test + n_val THEN 'val' "
        f"ELSE 'train' END AS split, CASE WHEN rn > n_test + n_val THEN "
        f"CAST(((rn - n_test - n_val - 1) * {folds}) // (n - n_test - n_val) AS INTEGER) END AS fold FROM u"
    )
