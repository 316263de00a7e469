"""Operator 13: sharding by a k-d tree over the metadata of documents.

A node of the tree holds the documents of some consecutive shards. It is cut along
the dimension in which its documents spread widest, at the weighted median (or the
weighted quantile that its shards on each side call for), until every leaf is one
shard; so shards are boxes of like documents with nearly equal bytes. All nodes of
a level are cut together: each round is one aggregation of (node, bin) weights with
``BINS`` bins a node, and narrows the bin that holds the cut, until its rows can be
sorted in one task; the driver sees one row a node. A cut is a place in the whole order (dimension, text hash, id, row), so
a run of equal values or of equal texts is cut in it only where the bytes call for
it, and copies stay together otherwise.

Dimensions: the length of the text (logarithm), language, source and ``doc_id``,
each scaled to [0, 2^30) over the table. Strings keep their order: a value is the
number that its first bytes after the common prefix of all values write.

Nulls and edges: a null text has no bytes, a null in a dimension is the least value,
a null id the least id. Ties and repeated rows are told apart by a number given to
each row when the keys are written, so a group of copies of any size can be cut. An
empty table gives an empty one; with fewer documents than shards some shards stay
empty. Other columns are carried on by ``write_shards`` inside one struct, whatever their names. A document larger than a shard's share makes its shard larger.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from textlab.llm.ordering import ordered, positions
from textlab.llm.shared import written

#: Bytes a record takes besides its text.
RECORD_BYTES = 16
BINS = 4096
SCALE = 1 << 30
#: Rows around a cut that are put in order in one task, to cut exactly.
SORT_ROWS = 50_000
#: Bytes of a string that count in its number.
PREFIX_BYTES = 6


@dataclass
class Cut:
    """Rows of shards [lo, hi) with key (dim, second, third) below ``at`` go to [lo, mid)."""

    lo: int
    hi: int
    mid: int
    dim: str
    at: tuple[int, int, int]


def _text_number(col: str, skip: int) -> Column:
    """The first bytes of a string after a common prefix, as a fraction of 256^PREFIX_BYTES."""
    raw = F.rpad(F.hex(F.substring(F.encode(F.col(col), "UTF-8"), skip + 1, PREFIX_BYTES)), 2 * PREFIX_BYTES, "0")
    return F.conv(raw, 16, 10).cast("double")


def _common_prefix(a: str | None, b: str | None) -> int:
    x, y, n = (a or "").encode(), (b or "").encode(), 0
    while n < min(len(x), len(y)) and x[n] == y[n]:
        n += 1
    return n


def keyed(docs: DataFrame, dims: tuple[str, ...], whole: bool = False) -> DataFrame:
    """The table of keys: doc_id, size, text_crc32, a scaled integer for each
    dimension and a number of the row (and, if ``whole``, the row itself as ``doc``);
    written, so that it is the same for all later jobs."""
    body = F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")
    base = docs.select("doc_id", (F.octet_length(body) + RECORD_BYTES).cast("long").alias("size"),
                       F.crc32(body).alias("text_crc32"), *[F.col(d).alias(f"k_{d}") for d in dims if d != "size"],
                       *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")] if whole else []))
    raw = written(base.withColumns({"_row": F.monotonically_increasing_id(), "_node": F.lit(0).cast("long")}), "shard-keys")
    kinds = dict(raw.dtypes)
    names = {d: "size" if d == "size" else f"k_{d}" for d in dims}
    ends = raw.agg(*[f(names[d]).alias(f"{w}_{d}") for d in dims for w, f in (("lo", F.min), ("hi", F.max))]).first()
    scaled = []
    for d in dims:
        c, lo, hi = names[d], ends[f"lo_{d}"], ends[f"hi_{d}"]
        if kinds[c] == "string":
            skip = _common_prefix(lo, hi)
            number, low, high = _text_number(c, skip), _first_bytes(lo, skip), _first_bytes(hi, skip)
        elif d == "size":
            number, low, high = F.log2(F.col(c).cast("double")), _log2(lo), _log2(hi)
        else:
            number, low, high = F.col(c).cast("double"), float(lo or 0), float(hi or 0)
        span = high - low
        place = F.floor((number - F.lit(low)) / F.lit(span) * F.lit(float(SCALE - 1))) if span > 0 else F.lit(0)
        scaled.append(F.coalesce(F.greatest(F.lit(0), F.least(F.lit(SCALE - 1), place)), F.lit(0)).cast("long")
                      .alias(f"d_{d}"))
    return raw.select("doc_id", "size", "text_crc32", "_row", "_node", *scaled, *(["doc"] if whole else []))


def _log2(x) -> float:
    return math.log2(x) if x else 0.0


def _first_bytes(x: str | None, skip: int) -> float:
    return float(int.from_bytes((x or "").encode()[skip:skip + PREFIX_BYTES].ljust(PREFIX_BYTES, b"\0"), "big"))


def _small(spark: SparkSession, names: str, rows: list[tuple]) -> DataFrame:
    """A table of a few numbers (one row a node), to be broadcast."""
    values = ", ".join("(" + ", ".join(f"{v}L" if isinstance(v, int) else f"{v!r}D" for v in r) + ")" for r in rows)
    return F.broadcast(spark.sql(f"select * from values {values} as t({names})"))


def _key(dims: tuple[str, ...]) -> list[Column]:
    """The order within dimension ``_dim`` (neighbouring ids count as one), in three longs."""
    d = F.element_at(F.array(*[F.col(f"d_{x}") for x in dims]), (F.col("_dim") + 1).cast("int"))
    return [F.shiftleft(d, 32) + F.col("text_crc32"),
            F.coalesce(F.shiftright(F.col("doc_id").cast("long"), 1), F.lit(-(1 << 62))), F.col("_row")]


def descend(rows: DataFrame, cuts: list[Cut], dims: tuple[str, ...]) -> DataFrame:
    """``rows`` with ``_node``, the first shard of the node they lie in, a level further
    down: a join with the few cuts of that level."""
    table = _small(rows.sparkSession, "_node, _dim, _mid, _a, _b, _c",
                   [(c.lo, dims.index(c.dim), c.mid, *c.at) for c in cuts])
    a, b, c = _key(dims)
    below = (a < F.col("_a")) | ((a == F.col("_a")) & ((b < F.col("_b")) | ((b == F.col("_b")) & (c < F.col("_c")))))
    node = F.when(F.col("_mid").isNull() | below, F.col("_node")).otherwise(F.col("_mid"))
    return rows.join(table, "_node", "left").select(*[c for c in rows.columns if c != "_node"], node.alias("_node"))


class _Spread(NamedTuple):
    bytes: int
    rows: int
    dim: str
    lo: int
    hi: int


def _spread(rows: DataFrame, dims: tuple[str, ...]) -> dict[int, _Spread]:
    """Of each node: its bytes and rows, the dimension in which it spreads widest, and the ends there."""
    got = rows.groupBy("_node").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"),
                                    *[F.min(f"d_{d}").alias(f"lo_{d}") for d in dims],
                                    *[F.max(f"d_{d}").alias(f"hi_{d}") for d in dims]).collect()
    out = {}
    for r in got:
        d = max(dims, key=lambda x: (r[f"hi_{x}"] - r[f"lo_{x}"], -dims.index(x)))
        out[r["_node"]] = _Spread(r.bytes, r.n, d, r[f"lo_{d}"], r[f"hi_{d}"])
    return out


@dataclass
class _Search:
    """The bracket [lo, hi] of a key part (with the parts before it fixed) that holds a
    cut, its rows, and the node's bytes below it."""

    lo: int
    hi: int
    rows: int
    part: int = 0
    fixed: tuple[int, ...] = ()
    below: int = 0


def _find_cuts(rows: DataFrame, cuts: dict[int, Cut], share: dict[int, float], search: dict[int, _Search],
               dims: tuple[str, ...]) -> None:
    """Sets ``at`` of all cuts of a level: the place below which ``share`` bytes of the node lie.

    Round by round a bracket shrinks to one of ``BINS`` bins; if a single value is
    left and it still has too many rows, the next part of the key is searched within
    it. A bracket of at most ``SORT_ROWS`` rows is put in order and cut exactly.
    """
    spark, key, part = rows.sparkSession, _key(dims), F.col("_part")

    def held(nodes: list[int]) -> DataFrame:
        table = _small(spark, "_node, _dim, _part, _f0, _f1, _lo, _hi, _step, _want",
                       [(n, dims.index(cuts[n].dim), s.part, *(*s.fixed, 0, 0)[:2], s.lo, s.hi,
                         -(-(s.hi - s.lo + 1) // BINS), float(share[n] - s.below)) for n in nodes for s in [search[n]]])
        return (rows.join(table, "_node")
                .withColumns({"_v": F.when(part == 0, key[0]).when(part == 1, key[1]).otherwise(key[2]),
                              "_next": F.when(part == 0, key[1]).otherwise(key[2])})
                .where(((part < 1) | (key[0] == F.col("_f0"))) & ((part < 2) | (key[1] == F.col("_f1"))))
                .where("_v between _lo and _hi"))

    def first_reaching(weights: DataFrame, order: list, take: list[str]) -> dict:
        """Of each node the first row, in this order, at which its wanted bytes are reached."""
        upto = F.sum("size").over(Window.partitionBy("_node").orderBy(*order))
        got = (weights.withColumn("upto", upto).where("upto >= _want").groupBy("_node")
               .agg(F.min_by(F.struct("size", "upto", *take), F.struct(*order)).alias("b")).select("_node", "b.*"))
        return {r["_node"]: r for r in got.collect()}

    while wide := [n for n, s in search.items() if s.rows > SORT_ROWS]:
        weights = (held(wide).groupBy("_node", "_want", F.expr("(_v - _lo) div _step").alias("_bin"))
                   .agg(F.sum("size").alias("size"), F.count("*").alias("n"), F.min("_v").alias("least"),
                        F.max("_v").alias("most"), F.min("_next").alias("next_least"), F.max("_next").alias("next_most")))
        for n, r in first_reaching(weights, ["_bin"], ["n", "least", "most", "next_least", "next_most"]).items():
            s = search[n]
            below = s.below + r["upto"] - r["size"]
            search[n] = (_Search(r.least, r.most, r.n, s.part, s.fixed, below) if r.least < r.most else
                         _Search(r.next_least, r.next_most, r.n, s.part + 1, (*s.fixed, r.least), below))
    ranked = held(list(search)).select("_node", "_want", "size", *[k.alias(f"_k{i}") for i, k in enumerate(key)])
    for n, r in first_reaching(ranked, ["_k0", "_k1", "_k2"], ["_k0", "_k1", "_k2"]).items():
        after = search[n].below + r["upto"]
        over = after - share[n] <= share[n] - (after - r["size"])
        cuts[n].at = (r["_k0"], r["_k1"], r["_k2"] + (1 if over else 0))


def grow_tree(keys: DataFrame, shards: int, dims: tuple[str, ...]) -> DataFrame:
    """``keys`` with the leaf (0 to ``shards`` - 1) each row falls in, as ``_node``."""
    rows = keys
    nodes = [(0, shards)]
    while nodes := [(lo, hi) for lo, hi in nodes if hi - lo > 1]:
        spread = _spread(rows, dims)
        cuts = {lo: Cut(lo, hi, lo + (hi - lo) // 2, spread[lo].dim, (0, 0, 0)) for lo, hi in nodes if lo in spread}
        if not cuts:  # no document
            break
        share = {n: spread[n].bytes * (c.mid - c.lo) / (c.hi - c.lo) for n, c in cuts.items()}
        search = {n: _Search(spread[n].lo << 32, (spread[n].hi << 32) + 0xFFFFFFFF, spread[n].rows) for n in cuts}
        _find_cuts(rows, cuts, share, search, dims)
        rows = descend(rows, list(cuts.values()), dims)
        nodes = [x for c in cuts.values() for x in ((c.lo, c.mid), (c.mid, c.hi))]
    return rows


def shard_documents(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None,
                    dims: tuple[str, ...] = ("size", "lang", "source", "doc_id")) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless from 0 in its shard, by
    doc_id) of every document; ``shards`` or as many as ``target_bytes`` calls for."""
    keys = keyed(docs, dims)
    if shards is None:
        total = keys.agg(F.sum("size")).first()[0] or 0
        shards = max(1, round(total / target_bytes))
    placed = grow_tree(keys, shards, dims).select(
        "doc_id", "size", "text_crc32", "_row", F.col("_node").cast("int").alias("shard"))
    rows = ordered(placed, "shard", [F.col("doc_id").asc_nulls_first(), F.col("_row")], "shards")
    return positions(rows, "shard", "slot").select("doc_id", "size", "text_crc32", "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int,
                 dims: tuple[str, ...] = ("size", "lang", "source", "doc_id"), files: int = 1) -> DataFrame:
    """The documents, all columns, as Parquet folders of one shard each under ``path``,
    ``files`` tasks and files a shard; returns the table read back, with the shard in
    a last column ``shard`` (``_shard``, if the documents have a column of that name)."""
    name = "shard"
    while name in docs.columns:
        name = "_" + name
    keys = keyed(docs, dims, whole=True)
    out = grow_tree(keys, shards, dims).select(
        "doc", F.col("_node").cast("int").alias("to"), (F.col("_row") % files).alias("file"))
    spark = docs.sparkSession
    (out.repartition(shards * files, "to", "file").select("doc.*", F.col("to").alias(name))
     .write.partitionBy(name).parquet(path))
    kinds = StructType([*docs.schema.fields, StructField(name, IntegerType())])
    return spark.read.schema(kinds).parquet(path)
