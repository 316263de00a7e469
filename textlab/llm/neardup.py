"""Operator 9: near-duplicate classes by MinHash with tensored banding.

Two collections A and B of m bands, each band r minhashes, give m * m tables:
table (i, j) is keyed by the pair (A_i, B_j), so 2 r m minhashes do the work of
2 r m^2 (Christiani, 2019, after Andoni and Indyk). A pair of similarity s
meets in some table with probability (1 - (1 - s^r)^m)^2; m is the smallest
number that lifts this to ``recall`` at the threshold. Every meeting is a
candidate only: links are confirmed on the full shingle sets.

Groups are never expanded into pairs:

1. documents with equal sets are one class, named by a hash of the set's digest;
2. a band value or a table key that one class alone has is dropped;
3. each class is compared with one pivot (the smallest class it shares a table
   bucket with), and links give components;
4. classes of buckets that still hold several components are compared with a few
   more pivots each, chosen by hash;
5. what still lies in buckets of several components is joined exactly by prefix
   filtering, and confirmed pairs of different components are links. So no
   candidate link is skipped, and a group of copies costs a few comparisons a class.

Text handling: A-Z lower-cased, words are runs of non-white-space bytes, a set
holds 64-bit hashes of the distinct k-word shingles.

Nulls and edges: a null or blank text has the empty set and is linked with
nothing; fewer than k words are one shingle; a null doc_id is kept as a row of
its own with a null component and ``kept`` true, and links nothing. Texts of
any length are taken whole. Rows that repeat a doc_id are each judged by their own
text: the component of a row is the smallest doc_id of any row reachable from that
text, whatever the order of the rows. An empty table gives an empty one; columns
besides id and text are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textlab.llm.components import connected_components
from textlab.llm.shared import drop_written, list_array, offsets_of, release_memory, row_chunks, text_column, written
from textlab.llm.spans import LOWER, NON_SPACE, grams, mix, span_hash, word_spans

def tables_needed(threshold: float, rows: int, recall: float) -> int:
    m = 1
    while (1 - (1 - threshold**rows) ** m) ** 2 < recall:
        m += 1
    return m


def shingle_sets(u8: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(flat sorted sets, row offsets) of the rows' distinct shingle hashes."""
    low = LOWER[u8]
    starts, ends = word_spans(low, offs, NON_SPACE)
    h = span_hash(low, starts, ends)
    row = np.searchsorted(starts, offs)
    g = grams(h, k)
    sets, n = [], np.zeros(len(offs) - 1, np.int64)
    for i, (a, b) in enumerate(zip(row[:-1].tolist(), row[1:].tolist())):
        if b - a >= k:
            s = np.unique(g[a:b - k + 1])
        elif b > a:
            s = grams(h[a:b], b - a) ^ np.uint64(b - a)
        else:
            continue
        sets.append(s)
        n[i] = len(s)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), offsets_of(n)


def _band_values(flat: np.ndarray, offs: np.ndarray, salts: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """(rows with a set, bands) uint64; seeds are (bands, minhashes)."""
    heads = offs[:-1][np.diff(offs) > 0]
    out = np.empty((len(heads), len(seeds)), np.uint64)
    for i, band in enumerate(seeds):
        v = np.full(len(heads), salts[i], np.uint64)
        for a in band:
            v = mix(v * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat((flat ^ (a >> np.uint64(7))) * a, heads))
        out[:, i] = v
    return out


def signatures(docs: DataFrame, k: int, rows: int, tables: int) -> DataFrame:
    """(doc_id, text_key, n, h1, h2, a, b): set size, set digest, band values."""
    rng = np.random.default_rng(9)
    seeds = rng.integers(1, 2**63, (2 * tables, rows), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    salts = rng.integers(1, 2**63, 2 * tables, dtype=np.uint64)

    def run(batches):
        for batch in batches:
            data, offs = text_column(batch, "text")
            for lo, hi in row_chunks(offs):
                flat, cut = shingle_sets(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], k)
                n = np.diff(cut)
                some = n > 0
                digest = np.zeros((2, hi - lo), np.uint64)
                bands = np.zeros((0, 2 * tables), np.uint64)
                if some.any():
                    heads = cut[:-1][some]
                    digest[0, some] = np.add.reduceat(mix(flat), heads)
                    digest[1, some] = np.add.reduceat(mix(flat ^ np.uint64(0x5851F42D4C957F2D)), heads)
                    bands = _band_values(flat, cut, salts, seeds)
                at = offsets_of(some * tables)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(batch.schema.get_field_index("text_key")).slice(lo, hi - lo),
                     pa.array(n), pa.array(digest[0].view(np.int64)),
                     pa.array(digest[1].view(np.int64)),
                     list_array(np.ascontiguousarray(bands[:, :tables]).reshape(-1).view(np.int64), at, pa.int64()),
                     list_array(np.ascontiguousarray(bands[:, tables:]).reshape(-1).view(np.int64), at, pa.int64())],
                    names=["doc_id", "text_key", "n", "h1", "h2", "a", "b"])
        release_memory()

    return docs.mapInArrow(run, "doc_id long, text_key long, n long, h1 long, h2 long, a array<long>, b array<long>")


def full_sets(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, s): the sorted distinct shingle hashes."""
    def run(batches):
        for batch in batches:
            data, offs = text_column(batch, "text")
            for lo, hi in row_chunks(offs):
                flat, cut = shingle_sets(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], k)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo),
                                                  list_array(flat.view(np.int64), cut, pa.int64())], names=["doc_id", "s"])
        release_memory()

    return docs.mapInArrow(run, "doc_id long, s array<long>")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (p, r) whose full sets reach the threshold."""
    one = sets.select(F.col("doc_id").alias("r"), F.col("s").alias("sr"))
    two = sets.select(F.col("doc_id").alias("p"), F.col("s").alias("sp"))
    both = F.size(F.array_intersect("sr", "sp"))
    return (pairs.join(one, "r").join(two, "p")
            .withColumn("i", both)
            .where(100 * F.col("i") >= percent * (F.size("sr") + F.size("sp") - F.col("i")))
            .select(*pairs.columns))


def _rest(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(p, r, cp, cr): pairs of different components that may reach the threshold, by
    prefix filtering (Chaudhuri et al., 2006) with positions (Xiao et al., 2008).

    Every set is ordered by the same order, rare shingles first. Two sets that
    reach the threshold share a shingle among the first n - ceil(t n) + 1 of
    each, and what follows the first such place must suffice for the overlap.
    Copies of one text differ in rare shingles, which come first, so a group of
    them does not meet in its common ones. No pair that is a link is lost."""
    shingles = open_.join(sets.withColumnRenamed("doc_id", "rep"), "rep").select(
        "rep", "component", F.size("s").alias("n"), F.explode("s").alias("x"))
    held = shingles.groupBy("x").agg(F.count("*").alias("d"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    place = F.row_number().over(Window.partitionBy("rep").orderBy("d", "x"))  # within one document
    least = F.floor((percent * F.col("n") + 99) / 100)
    prefix = (shingles.join(held, "x").withColumn("i", place)
              .where((F.col("i") <= F.col("n") - least + 1) & (F.col("lo") != F.col("hi")))
              .select("x", "rep", "component", "n", "i"))
    a, b = prefix.alias("a"), prefix.alias("b")
    after = 1 + F.least(F.col("a.n") - F.col("a.i"), F.col("b.n") - F.col("b.i"))
    return a.join(b, (F.col("a.x") == F.col("b.x")) & (F.col("a.rep") < F.col("b.rep")) &
                  (F.col("a.component") != F.col("b.component")) &
                  (100 * F.least("a.n", "b.n") >= percent * F.greatest("a.n", "b.n")) &
                  ((100 + percent) * after >= percent * (F.col("a.n") + F.col("b.n")))).select(
        F.col("a.rep").alias("p"), F.col("b.rep").alias("r"),
        F.col("a.component").alias("cp"), F.col("b.component").alias("cr")).distinct()


def _state(keyed: DataFrame, group: DataFrame) -> DataFrame:
    """(key, rep, n, component) of the table entries whose bucket holds several components."""
    state = written(keyed.join(group.withColumnRenamed("id", "rep"), "rep", "left").select(
        "key", "rep", "n", F.coalesce("component", "rep").alias("component")), "state")
    split = state.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    open_ = written(state.join(split.select("key"), "key", "left_semi"), "state")
    drop_written(state)
    return open_


def _further_pivots(open_: DataFrame, percent: int, most: int) -> DataFrame:
    """(p, r, cp, cr): each class with up to ``most`` classes of other components that
    are the pivot, chosen by hash, of a bucket it lies in."""
    pivot = open_.groupBy("key").agg(F.min(F.struct(
        F.xxhash64("key", "rep").alias("o"), "rep", "n", "component")).alias("p"))
    fits = 100 * F.least("n", "p.n") >= percent * F.greatest("n", "p.n")
    chosen = F.slice(F.sort_array(F.collect_set(F.struct(
        F.xxhash64("rep", "p.rep").alias("o"), F.col("p.rep").alias("rep"), F.col("p.component").alias("c")))), 1, most)
    return (open_.join(pivot, "key").where((F.col("p.component") != F.col("component")) & fits)
            .groupBy("rep", "component").agg(chosen.alias("q")).select("rep", "component", F.explode("q").alias("q"))
            .select(F.col("q.rep").alias("p"), F.col("rep").alias("r"), F.col("q.c").alias("cp"),
                    F.col("component").alias("cr")))


def _merged(group: DataFrame, links: DataFrame) -> DataFrame:
    """The components after links (cp, cr) between them; a class that was none of an
    edge is a component of its own name."""
    over = connected_components(links.select("cp", "cr").distinct(), "cp", "cr")
    old = over.select(F.col("id").alias("component"), F.col("component").alias("top"))
    moved = group.join(old, "component", "left").select("id", F.coalesce("top", "component").alias("component"))
    alone = over.join(group.select("id"), "id", "left_anti").select("id", "component")
    return written(moved.unionByName(alone), "components")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, rows: int = 3, recall: float = 0.999,
                    pivots: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, class_id (the smallest doc_id
    with an equal set), component_id, kept, text_key (64-bit hash of the text).
    ``pivots`` changes the work only: what it leaves open is joined exactly."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("text_key"))
    tables = tables_needed(percent / 100, rows, recall)
    sigs = written(signatures(docs, k, rows, tables), "minhash")
    full = sigs.where("n > 0 and doc_id is not null")
    classes = written(full.groupBy("h1", "h2", "n").agg(
        F.min(F.struct("doc_id", "text_key")).alias("least"), F.first("a").alias("a"), F.first("b").alias("b"))
        .select(F.xxhash64("h1", "h2", "n").alias("rep"), "h1", "h2", "n", "least", "a", "b"), "classes")

    # Band values that two classes share, then the tables of classes with some on either side.
    bands = classes.select("rep", "n", F.lit(0).alias("side"), F.explode("a").alias("v")).union(
        classes.select("rep", "n", F.lit(1).alias("side"), F.explode("b").alias("v")))
    common = bands.groupBy("v").agg(F.count("*").alias("c")).where("c > 1").select("v")
    live = (bands.join(common, "v", "left_semi").groupBy("rep", "n").agg(
        F.collect_list(F.when(F.col("side") == 0, F.col("v"))).alias("a"),
        F.collect_list(F.when(F.col("side") == 1, F.col("v"))).alias("b"))
        .where((F.size("a") > 0) & (F.size("b") > 0)))
    keyed = written(live.select("rep", "n", F.explode(F.flatten(F.transform(
        "a", lambda x: F.transform("b", lambda y: F.xxhash64(x, y))))).alias("key")), "tables")
    pivot = keyed.groupBy("key").agg(F.min(F.struct("rep", "n")).alias("p"), F.count("*").alias("c")).where("c > 1")
    fits = 100 * F.least("n", "p.n") >= percent * F.greatest("n", "p.n")
    met = keyed.join(pivot.select("key", "p"), "key")
    first = written(met.where((F.col("p.rep") != F.col("rep")) & fits).groupBy("rep").agg(
        F.min("p.rep").alias("p")).select("p", F.col("rep").alias("r")), "pairs")

    wanted = classes.select("rep", "least.*").join(met.select("rep").distinct(), "rep", "left_semi")
    one_text = docs.join(wanted, ["doc_id", "text_key"]).dropDuplicates(["rep"]).select(F.col("rep").alias("doc_id"), "text")
    sets = written(full_sets(one_text, k), "sets")
    links_to_pivots = written(_confirmed(first, sets, percent), "links")
    group = connected_components(links_to_pivots, "p", "r")

    # Most classes of a large group miss the first pivot only; some of the next ones link them.
    live = keyed.join(pivot.select("key"), "key", "left_semi")
    open_ = _state(live, group)
    second = written(_confirmed(written(_further_pivots(open_, percent, pivots), "pairs"), sets, percent), "links")
    group = _merged(group, second)
    # Classes of buckets that still hold several components: exact join of those, in place of all pairs.
    still = _state(live, group)
    more = written(_rest(still.select("rep", "component").distinct(), sets, percent), "pairs")
    third = written(_confirmed(more, sets, percent), "links")
    group = _merged(group, third)
    for table in (open_, still, keyed, sets, first, links_to_pivots, second, more, third):
        drop_written(table)
    members = written(classes.select("h1", "h2", F.col("n").alias("n_"), "rep", F.col("least.doc_id").alias("class_id")).join(
        group.withColumnRenamed("id", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep")), "members")
    least = members.groupBy("component").agg(F.min("class_id").alias("component_id"))
    members = members.join(least, "component").select("h1", "h2", "n_", "class_id", "component_id")
    out = sigs.select("doc_id", "text_key", "n", "h1", "h2").join(
        members, (sigs["h1"] == members["h1"]) & (sigs["h2"] == members["h2"]) & (F.col("n") == F.col("n_")) &
        F.col("doc_id").isNotNull() & (F.col("n") > 0), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"),
                      component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"), "text_key")
