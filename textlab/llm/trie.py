"""Operator 12: prefix trie of conversations, totals by time-forward processing.

A node is a distinct sequence of first turns (role, text); every conversation that
starts with it is a member. Nodes come from one aggregation over running prefix
hashes (128 bits, exclusive or of place-dependent turn hashes, so the parent's hash
is the node's without its last turn). A node is named by its smallest member and its
depth.

Totals over subtrees by time-forward processing (Chiang et al., 1995): nodes sorted
externally by reverse level order; each passes its totals to its parent as a
message in a priority queue ordered like the nodes, so a node finds its children's
messages at the queue's head. The trie is cut into shards: the number of member
turns below a node is known, and a shard is the subtree of a node with at most
``share`` of them whose parent has more. Shards are processed side by side; what
their roots pass on, and the few nodes above them (at most rows / ``share`` a
level), are processed in the same way, in bands of ``BAND`` levels, deepest first.
A queue keeps ``QUEUE`` messages in memory and spills the rest as sorted runs to
unnamed files of the task, which end with it.

Nulls and edges: a null role or text is empty; turns are ordered with nulls first,
then by role, the first ``TIE_CHARS`` characters of the text and a hash, so ties and
repeated rows have one order; rows without conv_id belong to no conversation and are
left out; an empty table has the root only (conv_id null, no members). Other columns
are ignored, whatever their names. The members that end at one node are hashed as a
stream of sorted pieces, never gathered.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textlab.llm.ordering import ordered, positions
from textlab.llm.shared import drop_written, written

WORD = r"[^\x20\x09-\x0D]+"
TIE_CHARS = 64
#: Turns whose prefix hashes run in one window.
BLOCK = 4096
#: Levels above the shards that are processed at a time.
BAND = 1 << 16
#: Messages that a queue keeps in memory, and least turns of a shard worth cutting.
QUEUE, LEAST_SHARE = 200_000, 200
#: Ids joined into one piece before they are hashed.
PIECE = 8192


# ------------------------------------------------------------------- sequences
def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, t1, t2, words): the place of every turn in its conversation, from
    1, and two hashes of its role and text. Texts themselves are not shuffled."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), F.substring(text, 1, TIE_CHARS).alias("tie"),
        F.xxhash64(F.lit(1), role, text).alias("t1"), F.xxhash64(F.lit(2), role, text).alias("t2"),
        F.size(F.regexp_extract_all(text, F.lit(WORD), 0)).alias("words"))
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("tie"), F.col("t1"), F.col("t2")]
    rows = positions(ordered(rows, "conv_id", order, "turns"), "conv_id", "at")
    return rows.select("conv_id", (F.col("at") + 1).alias("at"), "t1", "t2", "words")


def _prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, n, words, h1, h2, p1, p2): every turn with the hashes of the
    sequence that ends with it and of the one before. ``n``: turns of the conversation."""
    rows = turns.select("conv_id", "depth", "n", "words", F.xxhash64("depth", "t1").alias("o1"),
                        F.xxhash64("depth", "t2").alias("o2"), F.expr(f"(depth - 1) div {BLOCK}").alias("block"))
    run = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"r1": F.expr("bit_xor(o1)").over(run), "r2": F.expr("bit_xor(o2)").over(run)})
    long_ones = rows.where(F.col("n") > BLOCK)
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (long_ones.groupBy("conv_id", "block").agg(F.expr("bit_xor(o1)").alias("x1"), F.expr("bit_xor(o2)").alias("x2"))
               .select("conv_id", "block", F.coalesce(F.expr("bit_xor(x1)").over(before), F.lit(0)).alias("c1"),
                       F.coalesce(F.expr("bit_xor(x2)").over(before), F.lit(0)).alias("c2")))
    whole = (long_ones.join(carried, ["conv_id", "block"])
             .withColumns({"r1": F.col("r1").bitwiseXOR(F.col("c1")), "r2": F.col("r2").bitwiseXOR(F.col("c2"))})
             .drop("c1", "c2").unionByName(rows.where(F.col("n") <= BLOCK)))
    return whole.select("conv_id", "depth", "n", "words", F.col("r1").alias("h1"), F.col("r2").alias("h2"),
                        F.col("r1").bitwiseXOR(F.col("o1")).alias("p1"), F.col("r2").bitwiseXOR(F.col("o2")).alias("p2"))


# ------------------------------------------------------------ time-forward part
class SpillingQueue:
    """A priority queue of (key, value) whose messages beyond ``most`` lie in sorted
    runs on disk. Keys are pushed in no order, popped in ascending order."""

    def __init__(self, most: int = QUEUE):
        self.most, self.heap, self.runs, self.heads = most, [], [], []

    def push(self, key: tuple, value: tuple) -> None:
        heapq.heappush(self.heap, (key, value))
        if len(self.heap) > self.most:
            run = tempfile.TemporaryFile()  # unnamed; it ends with the task
            self.heap.sort()
            for item in self.heap:
                pickle.dump(item, run)
            run.seek(0)
            self.heap = []
            self.runs.append(run)
            self._advance(len(self.runs) - 1)

    def _advance(self, k: int) -> None:
        try:
            heapq.heappush(self.heads, (*pickle.load(self.runs[k]), k))
        except EOFError:
            self.runs[k].close()

    def pop_all(self, key: tuple) -> Iterator[tuple]:
        """The values of all messages with this key."""
        while self.heap and self.heap[0][0] == key:
            yield heapq.heappop(self.heap)[1]
        while self.heads and self.heads[0][0] == key:
            _, value, k = heapq.heappop(self.heads)
            self._advance(k)
            yield value


_NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "words", "e1", "e2"]
_SUMS = ["n_children", "n_leaves", "saved_tokens"]
_KINDS = ", ".join([*[f"{c} long" for c in _NODE], *[f"{c} long" for c in _SUMS], "out boolean"])


def _time_forward(queue: int):
    """Nodes and messages in reverse level order, by shard; gives every node with its
    totals (``out`` false) and every message that leaves its shard (``out`` true, to
    the node (parent_conv_id, depth))."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, waiting, open_node = object(), None, None
        done: list[tuple] = []

        def close() -> None:
            # all that this node is told has come: pass its totals on
            conv, depth, parent, n_convs, words, e1, e2, top, sums = open_node
            children, leaves, saved = sums
            leaves = leaves if children else 1
            saved += (n_convs - 1) * words
            done.append((conv, depth, parent, n_convs, words, e1, e2, children, leaves, saved, False))
            if parent is None:
                return
            if depth > top:
                waiting.push((-(depth - 1), parent), (leaves, saved))
            else:
                done.append((None, depth - 1, parent, None, None, None, None, 1, leaves, saved, True))

        for batch in batches:
            cols = batch.to_pydict()
            for row in zip(*[cols[c] for c in ("shard", "top", *_NODE, *_SUMS, "is_message")], strict=True):
                key, top, conv, depth, parent, n_convs, words, e1, e2, children, leaves, saved, message = row
                if message:  # sorted behind its node
                    for k, v in enumerate((children, leaves, saved)):
                        open_node[-1][k] += v
                    continue
                if open_node is not None:
                    close()
                if key != shard:
                    shard, waiting = key, SpillingQueue(queue)
                sums = [0, 0, 0]
                for more_leaves, more_saved in waiting.pop_all((-depth, conv)):
                    sums[0] += 1
                    sums[1] += more_leaves
                    sums[2] += more_saved
                open_node = (conv, depth, parent, n_convs, words, e1, e2, top, sums)
            if done:
                yield _rows(done)
                done = []
        if open_node is not None:
            close()
        if done:
            yield _rows(done)
    return run


def _rows(done: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*done, strict=True))
    arrays = [pa.array(c, pa.int64()) for c in cols[:-1]] + [pa.array(cols[-1], pa.bool_())]
    return pa.RecordBatch.from_arrays(arrays, [*_NODE, *_SUMS, "out"])


def _process(nodes: DataFrame, messages: DataFrame | None, queue: int) -> DataFrame:
    """``nodes`` have ``shard`` and ``top`` (depth of the shard's root); ``messages``
    are (conv_id, depth, shard, sums) to nodes among them."""
    rows = nodes.select("shard", "top", *_NODE, *[F.lit(0).cast("long").alias(c) for c in _SUMS],
                        F.lit(False).alias("is_message"))
    if messages is not None:
        given = {"shard", "conv_id", "depth", *_SUMS}
        rows = rows.unionByName(messages.select(
            *[F.col(c) if c in given else F.lit(None).cast("long").alias(c) for c in rows.columns[:-1]],
            F.lit(True).alias("is_message")))
    rows = rows.repartition(F.col("shard")).sortWithinPartitions("shard", F.desc("depth"), "conv_id", "is_message")
    return rows.mapInArrow(_time_forward(queue), _KINDS)


def subtree_totals(nodes: DataFrame, heads: DataFrame, queue: int = QUEUE, band: int = BAND) -> DataFrame:
    """Nodes with n_children, n_leaves and saved_tokens of their subtrees.

    ``nodes``: ``_NODE``, ``heavy``; ``heads`` (conv_id, shard, top): the shard that the
    light nodes named after a conversation lie in."""
    light = nodes.where("not heavy").join(heads, "conv_id")
    below = written(_process(light, None, queue), "trie")
    parts, frames = [below.where("not out")], [below]
    above = nodes.where("heavy")
    deepest = above.agg(F.max("depth")).first()[0]
    for lo in range((deepest or 0) // band * band, -1, -band) if deepest is not None else ():
        told = frames[0].where("out") if len(frames) == 1 else frames[0].where("out").unionByName(frames[-1].where("out"))
        told = (told.where((F.col("depth") >= lo) & (F.col("depth") < lo + band))
                .groupBy(F.col("parent_conv_id").alias("conv_id"), "depth").agg(*[F.sum(c).alias(c) for c in _SUMS])
                .withColumn("shard", F.lit(0).cast("long")))
        level = above.where((F.col("depth") >= lo) & (F.col("depth") < lo + band)).select(
            *_NODE, F.lit(0).cast("long").alias("shard"), F.lit(lo).cast("long").alias("top"))
        frames.append(written(_process(level, told, queue), "trie"))
        parts.append(frames[-1].where("not out"))
    return reduce(DataFrame.unionByName, parts).drop("out")


# -------------------------------------------------------------------- members
def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (e1, e2, conv_id) rows as pieces of comma-joined ids."""
    key, ids, first = None, [], None
    names = ["e1", "e2", "first", "ids"]

    def piece() -> tuple:
        return (*key, first, ",".join(map(str, ids)))

    def batch_of(out) -> pa.RecordBatch:
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names)

    for batch in batches:
        out = []
        for a, b, c in zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True):
            if (a, b) != key or len(ids) >= PIECE:
                if ids:
                    out.append(piece())
                key, ids, first = (a, b), [], c
            ids.append(c)
        if out:
            yield batch_of(out)
    if ids:
        yield batch_of([piece()])


def _hash_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, digest = None, None

    def batch_of(out) -> pa.RecordBatch:
        kinds = [pa.int64()] * 2 + [pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                          ["e1", "e2", "ends_sha256"])

    for batch in batches:
        out = []
        for a, b, _, ids in zip(*[batch.column(k).to_pylist() for k in range(4)], strict=True):
            if (a, b) != key:
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = (a, b), hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if out:
            yield batch_of(out)
    if key is not None:
        yield batch_of([(*key, digest.hexdigest())])


def ends_digest(ends: DataFrame, n: int) -> DataFrame:
    """(e1, e2, ends_sha256) of (e1, e2, conv_id): the members that end at a node. Ids
    are sorted in ranges, so those of one node may lie in many tasks; pieces of
    ``PIECE`` ids then meet, in order, in one."""
    pieces = (ends.repartitionByRange(n, "e1", "e2", "conv_id").sortWithinPartitions("e1", "e2", "conv_id")
              .mapInArrow(_join_ids, "e1 long, e2 long, first long, ids string"))
    return (pieces.repartition(F.col("e1"), F.col("e2")).sortWithinPartitions("e1", "e2", "first")
            .mapInArrow(_hash_pieces, "e1 long, e2 long, ends_sha256 string"))


# ------------------------------------------------------------------- operator
def conversation_trie(turns: DataFrame, conv_ids: DataFrame, share: int | None = None, queue: int = QUEUE,
                      band: int = BAND) -> DataFrame:
    """One row a node: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns``: (conv_id, depth from 1 without gaps, t1, t2, words, n), as ``ordered_turns``
    makes them, ``n`` the turns of the conversation; ``conv_ids``: every conversation
    once, with those without turns."""
    spark = turns.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = written(_prefixes(turns), "prefixes")
    convs = written(conv_ids.select(F.col("conv_id").cast("long").alias("conv_id")), "convs")
    left = F.col("n") - F.col("depth") + 1
    found = rows.groupBy("h1", "h2", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").cast("long").alias("words"),
        F.sum(left).alias("turns_below"), F.first("p1").alias("p1"), F.first("p2").alias("p2"))
    total = rows.count()
    share = share or max(LEAST_SHARE, total // (4 * n))  # a few shards a task
    found = written(found.withColumn("heavy", F.col("turns_below") > share), "found")
    parents = found.select(F.col("h1").alias("p1"), F.col("h2").alias("p2"), (F.col("depth") + 1).alias("depth"),
                           F.col("conv_id").alias("parent_conv_id"))
    least = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    root_id = least.first()
    nodes = (found.where("depth > 1").join(parents, ["p1", "p2", "depth"])
             .unionByName(found.where("depth = 1").withColumn("parent_conv_id", F.lit(root_id.conv_id).cast("long")))
             .select("conv_id", F.col("depth").cast("long").alias("depth"), "parent_conv_id", "n_convs", "words",
                     F.col("h1").alias("e1"), F.col("h2").alias("e2"), "heavy"))
    root = least.select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
                        "n_convs", F.lit(0).cast("long").alias("words"), F.lit(0).cast("long").alias("e1"),
                        F.lit(0).cast("long").alias("e2"), F.lit(True).alias("heavy"))
    nodes = written(nodes.unionByName(root), "nodes")
    # the first light node of a conversation names the shard of the light nodes below it
    heavy = found.where("heavy").select("h1", "h2", "depth")
    tops = rows.join(heavy, ["h1", "h2", "depth"], "left_semi").groupBy("conv_id").agg(F.max("depth").alias("last"))
    first_light = rows.join(tops, "conv_id", "left").where(F.col("depth") == F.coalesce("last", F.lit(0)) + 1)
    heads = first_light.select("conv_id", F.xxhash64("h1", "h2").alias("shard"), F.col("depth").cast("long").alias("top"))
    totals = subtree_totals(nodes, heads, queue, band)
    for table in (nodes, found):
        drop_written(table)
    ends = rows.where("depth = n").select(F.col("h1").alias("e1"), F.col("h2").alias("e2"), "conv_id")
    bare = convs.join(rows.where("depth = 1"), "conv_id", "left_anti").select(
        F.lit(0).cast("long").alias("e1"), F.lit(0).cast("long").alias("e2"), "conv_id")
    digests = ends_digest(ends.unionByName(bare), n)
    out = totals.join(digests, ["e1", "e2"], "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def plain_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the conversations as they are."""
    turns = written(ordered_turns(conversations), "ordered")
    sizes = turns.groupBy("conv_id").agg(F.max("at").alias("n"))
    return conversation_trie(turns.join(sizes, "conv_id").withColumnRenamed("at", "depth"), sizes.select("conv_id"))


def rebased_trie(conversations: DataFrame, group: int = 20, heads: int = 4) -> DataFrame:
    """The trie of conversations rebuilt on shared heads: conversation c begins with the
    first h turns of conversation c - c % ``group`` (all if it has fewer, none if it is
    absent), h = crc32(decimal c) % ``heads``, then has its own turns after its first h."""
    turns = written(ordered_turns(conversations), "ordered")
    sizes = turns.groupBy("conv_id").agg(F.max("at").alias("own"))
    base = sizes.select(F.col("conv_id").alias("base"), F.col("own").alias("base_turns"))
    convs = (sizes.select("conv_id", "own", (F.col("conv_id") - F.col("conv_id") % group).alias("base"),
                          (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h"))
             .join(base, "base", "left")
             .withColumn("lead", F.least("h", F.coalesce("base_turns", F.lit(0)))))
    convs = written(convs.withColumn("n", F.col("lead") + F.greatest(F.lit(0), F.col("own") - F.col("h"))), "plans")
    facts = ["t1", "t2", "words"]
    lead = (convs.where("lead > 0").select("conv_id", "base", "lead", "n")
            .join(turns.where(F.col("at") < heads).select(F.col("conv_id").alias("base"), "at", *facts), "base")
            .where("at <= lead").select("conv_id", F.col("at").alias("depth"), *facts, "n"))
    own = (turns.join(convs.select("conv_id", "h", "lead", "n"), "conv_id").where("at > h")
           .select("conv_id", (F.col("lead") + F.col("at") - F.col("h")).alias("depth"), *facts, "n"))
    return conversation_trie(lead.unionByName(own), convs.select("conv_id"))
