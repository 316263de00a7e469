"""Operator 4: benchmark passages in documents, by CGK embedding and LSH.

Items and texts become words (runs of ASCII letters, digits and non-ASCII
bytes, A-Z lower-cased). A document holds an item of n words if some window of
n of its words (the whole document, if shorter) is within edit distance
floor((1 - similarity) * n) of it, counted in words.

The CGK embedding (Chakraborty, Goldenberg, Koucky, 2016) walks a sequence with
shared random bits: at step j it writes the current word and moves on if the bit
of (j, word) is one. Edit distance becomes Hamming distance with constant
probability a walk, so ``walks`` independent walks are taken. In each, ``tables``
random samples of ``sampled`` places are the LSH keys. A window that meets
an item in any table is a candidate, and is verified by exact edit distance.
At the defaults the tests hold recall to 0.97 at least, with edits up to the distance
allowed.

Windows are not taken at every place of the corpus. Of the d + 1 blocks into
which an item is cut, one must be intact in any window within distance d; so
only windows near an occurrence of a block can match, and others are never
embedded. This loses nothing and adds nothing.

The benchmark is a stated query set against all rows, in blocks of
``BLOCK_ITEMS`` items: each block is a small broadcast index of fixed bound and
one pass over the documents.

Nulls and edges: null or wordless texts and items match nothing; items of
fewer than five words must occur exactly; texts of any length are taken whole;
repeated rows give repeated rows; an empty table on either side gives no row.
Other columns are ignored by ``benchmark_matches`` and kept by ``clean_documents``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.llm.shared import ragged, row_chunks, text_column, written
from textlab.llm.spans import ALNUM, LOWER, grams, mix, span_hash, word_spans

BLOCK_ITEMS = 5_000
_PAD = np.uint64(0x6A09E667F3BCC909)


def _bits(step: int, walk: int, word: np.ndarray) -> np.ndarray:
    return (mix(word + np.uint64((step * 0x9E3779B9 + walk * 0x85EBCA6B + 1) & (2**63 - 1))) >> np.uint64(63)).astype(np.int64)


def cgk(seqs: np.ndarray, walk: int) -> np.ndarray:
    """(rows, 3 n) embedding of the (rows, n) sequences."""
    rows, n = seqs.shape
    out = np.full((rows, 3 * n), _PAD, np.uint64)
    at, every = np.zeros(rows, np.int64), np.arange(rows)
    for j in range(3 * n):
        live = at < n
        if not live.any():
            break
        word = seqs[every[live], at[live]]
        out[live, j] = word
        at[live] += _bits(j, walk, word)
    return out


def lsh_keys(seqs: np.ndarray, walks: int, tables: int, sampled: int) -> np.ndarray:
    """(rows, walks * tables) keys; the places depend on the length only."""
    rows, n = seqs.shape
    keys = np.empty((rows, walks * tables), np.uint64)
    for w in range(walks):
        e = cgk(seqs, w)
        # Steps past the expected end of the walk (2 n) are mostly padding that all rows share.
        places = np.random.default_rng((n, w)).integers(0, max(1, 2 * n - n // 4), (tables, sampled))
        for t, p in enumerate(places):
            h = np.full(rows, (n << 20) + w * tables + t, np.uint64)
            for j in sorted(p.tolist()):
                h = mix(h * np.uint64(0x9E3779B97F4A7C15) + e[:, j])
            keys[:, w * tables + t] = h
    return keys


def edit_distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Levenshtein distance of the rows of x (rows, a) and y (rows, b)."""
    a, b = x.shape[1], y.shape[1]
    kind = np.int16 if a + b < 2**15 else np.int32
    prev = np.broadcast_to(np.arange(b + 1, dtype=kind), (len(x), b + 1)).copy()
    steps = np.arange(b + 1, dtype=kind)
    for i in range(1, a + 1):
        cur = np.empty_like(prev)
        cur[:, 0] = i
        np.minimum(prev[:, :-1] + (y != x[:, i - 1:i]), prev[:, 1:] + 1, out=cur[:, 1:])
        # Insertions: running minimum of cur[j] - j.
        prev = np.minimum.accumulate(cur - steps, axis=1) + steps
    return prev[:, -1].astype(np.int64)


def words_of(u8: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, row offsets into them)."""
    low = LOWER[u8]
    starts, ends = word_spans(low, offs, ALNUM)
    return span_hash(low, starts, ends), np.searchsorted(starts, offs)


def allowed(n: int, similarity: float) -> int:
    return int((1 - similarity) * n + 1e-9)


@dataclass
class Index:
    """Items of one block: their words, their blocks by length, their LSH tables."""
    ids: np.ndarray
    words: list[np.ndarray]
    seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    tables: dict[int, tuple[np.ndarray, np.ndarray]]
    most: dict[int, int]
    shape: tuple[int, int, int]


def build_index(items: list[tuple[int, np.ndarray]], similarity: float, walks: int, tables: int, sampled: int) -> Index:
    by_q: dict[int, list[tuple[int, int, int, int]]] = {}
    by_n: dict[int, list[int]] = {}
    most = {}
    for k, (_, w) in enumerate(items):
        n = len(w)
        d = allowed(n, similarity)
        most[n] = d
        by_n.setdefault(n, []).append(k)
        cuts = np.linspace(0, n, d + 2).astype(int)
        q = int(np.diff(cuts).min())
        g = grams(w, q)
        for o in cuts[:-1]:
            by_q.setdefault(q, []).append((int(g[o]), int(o), n, d))
    seeds = {}
    for q, rows in by_q.items():
        rows = sorted(set(rows))
        key = np.array([r[0] for r in rows], np.uint64)
        bitmap = np.zeros(1 << 22, bool)
        bitmap[(key >> np.uint64(42)).astype(np.int64)] = True
        seeds[q] = (key, *(np.array([r[i] for r in rows], np.int64) for i in (1, 2, 3)), bitmap)
    lsh = {}
    for n, ks in by_n.items():
        keys = lsh_keys(np.stack([items[k][1] for k in ks]), walks, tables, sampled)
        owner = np.repeat(np.array(ks, np.int64), keys.shape[1])
        flat = keys.reshape(-1)
        order = np.argsort(flat, kind="stable")
        lsh[n] = (flat[order], owner[order])
    return Index(np.array([i for i, _ in items], np.int64), [w for _, w in items], seeds, lsh, most,
                 (walks, tables, sampled))


def find_items(h: np.ndarray, row: np.ndarray, index: Index) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, item, first word, distance) arrays of verified windows of a chunk
    of texts, given its word hashes and row offsets."""
    starts, sizes = [], []
    for q, (key, offset, size, slack, bitmap) in index.seeds.items():
        g = grams(h, q)
        if not len(g):
            continue
        j = np.flatnonzero(bitmap[(g >> np.uint64(42)).astype(np.int64)])
        lo, hi = np.searchsorted(key, g[j], "left"), np.searchsorted(key, g[j], "right")
        j, lo, hi = j[hi > lo], lo[hi > lo], hi[hi > lo]
        which = ragged(lo, hi - lo)
        j = np.repeat(j, hi - lo)
        r = np.searchsorted(row, j, "right") - 1
        inside = j + q <= row[r + 1]
        j, which, r = j[inside], which[inside], r[inside]
        s, n = slack[which], size[which]
        for shift in range(-int(s.max(initial=0)), int(s.max(initial=0)) + 1):
            use = np.abs(shift) <= s
            p = j[use] - offset[which[use]] + shift
            last = np.maximum(row[r[use] + 1] - n[use], row[r[use]])
            starts.append(np.clip(p, row[r[use]], last))
            sizes.append(n[use])
    if not starts:
        return
    start, size = np.concatenate(starts), np.concatenate(sizes)
    walks, tables, sampled = index.shape
    for n in np.unique(size).tolist():
        p = np.unique(start[size == n])
        for at in range(0, len(p), 4096):
            part = p[at:at + 4096]
            r = np.searchsorted(row, part, "right") - 1
            have = np.minimum(row[r + 1] - part, n)
            full = have == n
            place = np.minimum(part[:, None] + np.arange(n), len(h) - 1)
            seqs = np.where(np.arange(n) < have[:, None], h[place], _PAD)
            keys = lsh_keys(seqs, walks, tables, sampled)
            known, owner = index.tables[n]
            lo, hi = np.searchsorted(known, keys, "left"), np.searchsorted(known, keys, "right")
            hits = (hi - lo).reshape(-1)
            w = np.repeat(np.repeat(np.arange(len(part)), keys.shape[1]), hits)
            pairs = np.unique(np.stack([w, owner[ragged(lo.reshape(-1), hits)]]), axis=1)
            if not pairs.shape[1]:
                continue
            w, k = pairs
            y = np.stack([index.words[i] for i in k.tolist()])
            d = edit_distance(seqs[w], y)
            if not full.all():  # padding counts as nothing: a short text is compared as it is
                for i in np.flatnonzero(~full[w]).tolist():
                    d[i] = edit_distance(seqs[w[i]:w[i] + 1, :have[w[i]]], y[i:i + 1])[0]
            good = d <= index.most[n]
            yield r[w[good]], k[good], part[w[good]] - row[r[w[good]]], d[good]


def best_matches(h: np.ndarray, row: np.ndarray, index: Index) -> list[tuple[int, int, int, int]]:
    """(row, item, first word, distance): the closest, first window of every
    row and item that match."""
    best: dict[tuple[int, int], tuple[int, int]] = {}
    for r, k, p, d in find_items(h, row, index):
        for a, b, c, e in zip(r.tolist(), k.tolist(), p.tolist(), d.tolist()):
            if (a, b) not in best or (e, c) < best[a, b]:
                best[a, b] = (e, c)
    return sorted((a, b, c, e) for (a, b), (e, c) in best.items())


def _item_blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Blocks of at most BLOCK_ITEMS items with words, read one after another."""
    block = []
    rows = benchmark.select(F.col(id_col).cast("long").alias("i"), F.col(text_col).alias("t")).where(
        "i is not null and t is not null")
    for x in rows.toLocalIterator():
        raw = np.frombuffer(x.t.encode("utf-8"), np.uint8)
        w, _ = words_of(raw, np.array([0, len(raw)]))
        if len(w):
            block.append((x.i, w))
        if len(block) == BLOCK_ITEMS:
            yield block
            block = []
    if block:
        yield block


def _indexes(benchmark: DataFrame, similarity: float, walks: int, tables: int, sampled: int) -> Iterator[Index]:
    for block in _item_blocks(benchmark, "item_id", "text"):
        yield build_index(block, similarity, walks, tables, sampled)


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, walks: int = 4,
                      tables: int = 32, sampled: int = 2) -> DataFrame:
    """(doc_id, item_id, first_word, n_words, distance), one row for each
    document and benchmark item that it holds."""
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, first_word long, n_words long, distance long"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out, shared = spark.createDataFrame([], schema), None
    for index in _indexes(benchmark, similarity, walks, tables, sampled):
        if shared is not None:  # one block's index at a time
            out = written(out, "matches")
            shared.destroy()
        shared = spark.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            for batch in batches:
                data, offs = text_column(batch, "text")
                for lo, hi in row_chunks(offs):
                    h, row = words_of(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
                    found = best_matches(h, row, shared.value)
                    if found:
                        r, k, p, d = map(list, zip(*found))
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(pa.array([lo + x for x in r])),
                             pa.array(shared.value.ids[k]), pa.array(p, pa.int64()),
                             pa.array([len(shared.value.words[x]) for x in k], pa.int64()), pa.array(d, pa.int64())],
                            names=["doc_id", "item_id", "first_word", "n_words", "distance"])

        out = out.union(rows.mapInArrow(run, schema))
    return out


def clean_documents(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8, walks: int = 4,
                    tables: int = 32, sampled: int = 2) -> DataFrame:
    """The rows of ``docs`` (all columns) whose text holds no benchmark item."""
    shared = None
    for index in _indexes(benchmark, similarity, walks, tables, sampled):
        if shared is not None:  # one block's index at a time
            docs = written(docs, "clean")
            shared.destroy()
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches, shared=shared):
            for batch in batches:
                data, offs = text_column(batch, "text")
                clean = np.ones(batch.num_rows, bool)
                for lo, hi in row_chunks(offs):
                    h, row = words_of(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
                    for r, *_ in find_items(h, row, shared.value):
                        clean[lo + r] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


