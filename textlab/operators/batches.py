"""N-gram counts and TF-IDF weights of many documents at once, in Arrow batches.

A task goes through its documents in slices of bounded length. In a slice tokens (or
characters) are numbered by a dictionary, an n-gram is the integer of its numbers, and
one sort of (n-gram, document) integers counts all of them; numbers that would not fit
64 bits are replaced by their rank among the slice's own first, so integers are exact
names of n-grams, no hashes. Strings are made once a distinct term of a slice.

* ``term_counts``: ``(block, term, df, ttf)`` a slice, to be summed by term.
* ``term_batches``: a row for each term of a slice with its documents and counts, and
  a row with the slice's documents.
* ``Weighed`` joins the terms of slices with the vocabulary; ``class_sums`` and
  ``document_rows`` weigh whole slices. No posting is a row and none is shuffled. A
  term is in a slice once, so no key of a shuffle join with the vocabulary is hot.

The functions that run in tasks are closures, so they ship by value.
"""

from __future__ import annotations

from copy import copy

from pyspark.sql import Column, DataFrame, functions as F

from ..session import written
from .common import BROADCAST_MAX_BYTES, sized_broadcast
from .tfidf import CHAR, WORD, TfidfParams, hot_terms

#: Characters of a slice (a longer text is a slice of its own) and its documents (16 bits).
SLICE_CHARS, SLICE_DOCS = 1 << 21, 1 << 16
#: The block of the row that holds a slice's documents.
DOCS = -1
BATCH_SCHEMA = ("batch long, block int, term string, docs binary, tfs binary, n_terms long, ids binary, tags binary, "
                "dense binary")


def _counter(p: TfidfParams, blocks: tuple):
    """``slice_terms(wtok, norm)``: for each block its distinct terms, where each one's
    postings begin, and the postings (document in the slice, count) by term."""
    word, char, spans = WORD, CHAR, {WORD: p.word_ngrams, CHAR: p.char_ngrams}

    def grams(ids, lens, size, lo, hi):
        import numpy as np
        bits, doc_bits = max(1, int(size - 1).bit_length()), max(1, int(len(lens) - 1).bit_length())
        doc = np.repeat(np.arange(len(lens), dtype=np.uint64), lens)
        ids = ids.astype(np.uint64)
        code, width, ranks = ids, bits, {}
        for n in range(1, hi + 1):
            if len(ids) < n:
                return
            if n > 1:
                if width + bits + doc_bits > 63:
                    ranks[n], code = np.unique(code, return_inverse=True)
                    code, width = code.astype(np.uint64), max(1, int(len(ranks[n]) - 1).bit_length())
                code, width = (code[:-1] << np.uint64(bits)) | ids[n - 1:], width + bits
            if n < lo:
                continue
            here = doc[:len(doc) - n + 1]
            inside = here == doc[n - 1:]
            keys = (code[inside] << np.uint64(doc_bits)) | here[inside]
            if not len(keys):
                continue
            if width + doc_bits <= 32:
                keys = keys.astype(np.uint32)
            keys.sort()
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            tf = np.diff(np.append(first, len(keys)))
            keys = keys[first].astype(np.uint64)
            docs = (keys & np.uint64((1 << doc_bits) - 1)).astype(np.uint16)
            keys >>= np.uint64(doc_bits)
            at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            digits, rest = [], keys[at]
            for k in range(n, 1, -1):
                digits.append(rest & np.uint64((1 << bits) - 1))
                rest = rest >> np.uint64(bits)
                if k in ranks:
                    rest = ranks[k][rest.astype(np.int64)]
            yield [rest, *reversed(digits)], at, docs, tf

    def merged(terms, at, docs, tf):
        """One entry a term, where tokens hold blanks and different n-grams are the same string."""
        import numpy as np
        enc = terms.dictionary_encode()
        term = np.repeat(enc.indices.to_numpy().astype(np.int64), np.diff(np.append(at, len(docs))))
        keys = (term << 16) | docs
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        keys, tf = keys[first], np.add.reduceat(tf[order], first)
        term = keys >> 16
        return (enc.dictionary, np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])),
                (keys & 0xFFFF).astype(np.uint16), tf)

    def block_terms(ids, lens, dictionary, lo, hi, sep):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        parts, shift = [], 0
        for digits, at, docs, tf in grams(ids, lens, len(dictionary), lo, hi):
            strings = [dictionary.take(pa.array(d.astype(np.int64))) for d in digits]
            parts.append((strings[0] if len(strings) == 1 else pc.binary_join_element_wise(*strings, sep),
                          at + shift, docs, tf))
            shift += len(docs)
        if not parts:
            return None
        terms, at, docs, tf = (pa.concat_arrays([x[0] for x in parts]),
                               *(np.concatenate([x[i] for x in parts]) for i in (1, 2, 3)))
        if sep and hi > 1 and pc.any(pc.match_substring(dictionary, sep)).as_py():
            return merged(terms, at, docs, tf)
        return terms, at, docs, tf

    def words(wtok):
        enc = wtok.flatten().cast("string").dictionary_encode()
        return enc.indices.to_numpy(), enc.dictionary

    def characters(norm):
        import numpy as np
        import pyarrow as pa
        text = "".join(norm.to_pylist())
        points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        place = np.zeros(0x110000, dtype=np.int32)
        place[points] = 1
        used = np.flatnonzero(place)
        place[used] = np.arange(len(used), dtype=np.int32)
        return place[points], pa.array([chr(c) for c in used], pa.string())

    def slice_terms(wtok, norm):
        import pyarrow.compute as pc
        for block in blocks:
            column = wtok if block == word else norm
            lens = (pc.list_value_length if block == word else pc.utf8_length)(column).to_numpy(zero_copy_only=False)
            if not int(lens.sum()):
                continue
            ids, dictionary = (words if block == word else characters)(column)
            found = block_terms(ids, lens, dictionary, *spans[block], " " if block == word else "")
            if found is not None:
                yield block, *found
    return slice_terms


def _slicer():
    most, docs = SLICE_CHARS, SLICE_DOCS

    def slices(batches):
        """Record batches cut into slices, each of at most ``most`` characters or one text."""
        import numpy as np
        import pyarrow.compute as pc
        for batch in batches:
            ends = np.cumsum(pc.utf8_length(batch.column("norm")).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < batch.num_rows:
                done = int(ends[at - 1]) if at else 0
                to = min(max(at + 1, int(np.searchsorted(ends, done + most, "right"))), at + docs, batch.num_rows)
                yield batch.slice(at, to - at)
                at = to
    return slices


def term_counts(train: DataFrame, p: TfidfParams, blocks=(WORD, CHAR)) -> DataFrame:
    """``(block, term, df, ttf)`` of the rows of ``train`` (``wtok``, ``norm``): slices
    summed by term."""
    slice_terms, slices = _counter(p, tuple(blocks)), _slicer()

    def count(batches):
        import numpy as np
        import pyarrow as pa
        for part in slices(batches):
            for block, terms, at, docs, tf in slice_terms(part.column("wtok"), part.column("norm")):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), block, np.int32)), terms, pa.array(np.diff(np.append(at, len(docs)))),
                     pa.array(np.add.reduceat(tf, at))], ["block", "term", "df", "ttf"])
    counts = train.select("wtok", "norm").mapInArrow(count, "block int, term string, df long, ttf long")
    return counts.groupBy("block", "term").agg(F.sum("df").alias("df"), F.sum("ttf").alias("ttf"))


def term_batches(rows: DataFrame, p: TfidfParams, blocks=(WORD, CHAR)) -> DataFrame:
    """``rows`` (``doc_id``, ``tag``, ``dense`` array, ``wtok``, ``norm``) as slices: a row a
    term, and one of block ``DOCS`` with the documents and the number of the other rows."""
    slice_terms, slices, schema, docs_block = _counter(p, tuple(blocks)), _slicer(), BATCH_SCHEMA, DOCS

    def packed(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        names = [c.split()[0] for c in schema.split(", ")]
        kinds = [pa.int64(), pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]

        def binary(values, ends):
            offsets = (np.concatenate([[0], ends]) * values.itemsize).astype(np.int32)
            return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(values.tobytes())])

        number = (TaskContext.get().partitionId() << 33) - 1
        for part in slices(batches):
            number += 1
            n_terms = 0
            for block, terms, at, docs, tf in slice_terms(part.column("wtok"), part.column("norm")):
                n, ends = len(at), np.append(at[1:], len(docs))
                n_terms += n
                wide = tf.max() > 255  # four bytes a count, else one
                tfs = binary(tf.astype(np.uint32 if wide else np.uint8), ends)
                none = [pa.nulls(n, k) for k in kinds[5:]]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, number)), pa.array(np.full(n, block, np.int32)), terms,
                                                  binary(docs, ends), tfs, *none], names)
            ids = pa.RecordBatch.from_arrays([part.column("doc_id")], ["doc_id"])  # keys of any type, nulls too
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, ids.schema) as out:
                out.write_batch(ids)
            tags = part.column("tag").to_numpy(zero_copy_only=False).astype(np.int32)
            dense = part.column("dense").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], k) for x, k in zip([number, docs_block, str(number), None, None, n_terms, sink.getvalue().to_pybytes(),
                                                   tags.tobytes(), dense.tobytes()], kinds)], names)
    return rows.select("doc_id", "tag", "dense", "wtok", "norm").mapInArrow(packed, schema)


def _weigher():
    """``weigh(ids, tags, dense, blocks)``: (ids, tags, dense, document of each weight, its
    idx, its new_idx or -1, weight) of a slice. ``blocks``: for each the documents and
    counts of its postings, how many each term has, and the terms' idx, idf and new_idx."""
    def weigh(ids, tags, dense, blocks):
        import numpy as np
        out = []
        for docs, tf, n, idx, idf, new in blocks:
            docs = docs.astype(np.int64)
            r = (1.0 + np.log(tf.astype(np.float64))) * np.repeat(idf, n)
            norm = np.sqrt(np.bincount(docs, r * r, len(ids)))
            out.append((docs, np.repeat(idx, n), np.repeat(new, n), r / norm[docs]))
        if not out:
            none = np.empty(0, np.int64)
            out = [(none, none, none, np.empty(0))]
        return ids, tags, dense, *(np.concatenate([o[i] for o in out]) for i in range(4))
    return weigh


def _in_place():
    """``slices(batches)``: the weighed slices of rows of ``term_batches`` that have met a
    broadcast vocabulary; the rows of a slice come one after the other."""
    docs_block, weigh = DOCS, _weigher()
    columns = ["batch", "block", "docs", "tfs", "n_terms", "ids", "tags", "dense", "idx", "idf", "new_idx"]

    def flat(column, kind):
        """All values of a binary column, end to end."""
        import numpy as np
        buffers = column.buffers()
        offsets = np.frombuffer(buffers[1], np.int32)[column.offset:column.offset + len(column) + 1]
        return np.frombuffer(buffers[2], np.uint8)[offsets[0]:offsets[-1]].view(kind)

    def whole(rows):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        table = pa.Table.from_batches(rows).combine_chunks()
        head = table.filter(pc.equal(table["block"], docs_block)).to_pylist()
        terms = table.filter(pc.not_equal(table["block"], docs_block))
        if len(head) != 1 or terms.num_rows != head[0]["n_terms"]:
            raise RuntimeError("the rows of a slice are not together")
        head = head[0]
        ids = pa.ipc.open_stream(head["ids"]).read_all().column(0).combine_chunks()
        tags = np.frombuffer(head["tags"], np.int32)
        blocks = []
        terms = terms.filter(pc.is_valid(terms["idx"]))
        for block in pc.unique(terms["block"]).to_pylist():
            t = terms.filter(pc.equal(terms["block"], block)).combine_chunks()
            docs, tfs, idx, idf, new = (t[c].chunk(0) for c in ("docs", "tfs", "idx", "idf", "new_idx"))
            n = pc.binary_length(docs).to_numpy() // 2
            wide = int(pc.sum(pc.binary_length(tfs)).as_py()) > int(n.sum())
            blocks.append((flat(docs, np.uint16), flat(tfs, np.uint32 if wide else np.uint8), n, idx.to_numpy(), idf.to_numpy(),
                           pc.fill_null(new, -1).to_numpy()))
        return weigh(ids, tags, np.frombuffer(head["dense"], np.float64).reshape(len(ids), -1), blocks)

    def slices(batches):
        import numpy as np
        held, number = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = batch.select(columns)
            of = batch.column("batch").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(of[1:] != of[:-1]) + 1, [len(of)]])
            for a, b in zip(cuts[:-1], cuts[1:]):
                if held and of[a] != number:
                    yield whole(held)
                    held = []
                number = of[a]
                held.append(batch.slice(a, b - a))
        if held:
            yield whole(held)
    return slices


def _looked_up(p: TfidfParams, blocks: tuple):
    """``slice(rows, found)``: a weighed slice from its documents and the rows of the
    vocabulary that its terms have."""
    slice_terms, weigh = _counter(p, blocks), _weigher()

    def one(rows, found):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        flat = lambda c: c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c
        rows, found = rows.combine_chunks(), found.combine_chunks()
        parts = []
        for block, terms, at, docs, tf in slice_terms(flat(rows["wtok"]), flat(rows["norm"])):
            known = found.filter(pc.equal(found["block"], block))
            place = pc.index_in(terms, value_set=flat(known["term"]))
            some = pc.is_valid(place).to_numpy(zero_copy_only=False)
            if not some.any():
                continue
            place, n = place.drop_null().to_numpy(), np.diff(np.append(at, len(docs)))
            kept = np.repeat(some, n)
            idx, idf, new = (flat(known[c]).fill_null(-1).to_numpy()[place] for c in ("idx", "idf", "new_idx"))
            parts.append((docs[kept], tf[kept], n[some], idx, idf, new))
        ids = flat(rows["doc_id"])
        dense = flat(rows["dense"]).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(ids), -1)
        return weigh(ids, rows["tag"].to_numpy(), dense, parts)
    return one


class Weighed:
    """The weights of ``rows`` (``doc_id``, ``tag``, ``dense`` array, ``wtok``, ``norm``) by a
    vocabulary ``(block, term, df, idx, idf)``, slice by slice.

    A vocabulary of at most ``most_bytes`` is broadcast, and slices stay where they are.
    With a larger one only the distinct terms of a slice are joined with it, by a shuffle;
    what they find and the texts of the slice meet by the number of the slice, and the
    slice is counted again there. So no posting is shuffled either way."""

    def __init__(self, rows: DataFrame, vocab: DataFrame, p: TfidfParams, blocks=(WORD, CHAR),
                 most_bytes: int = BROADCAST_MAX_BYTES):
        self.p, self.blocks, self.met, self.texts, self.found, self.id = p, tuple(blocks), None, None, None, id_field(rows)
        v = vocab.select("block", "term", "idx", "idf")
        if hot_terms(vocab.select("block", "term", "df", "idx", "idf"), most_bytes) is None:
            self.met = term_batches(rows, p, blocks).join(F.broadcast(v), ["block", "term"], "left")
        else:
            self.texts = numbered(rows)
            # a partition's share of the vocabulary is hashed: the slices' terms, many times as many, are not sorted
            self.found = written(slice_terms_of(self.texts, p, self.blocks).join(v.hint("shuffle_hash"), ["block", "term"])
                                 .select("batch", "block", "term", "idx", "idf"), "found")

    def select(self, selected: DataFrame | None) -> "Weighed":
        """The same weights with ``(idx, new_idx)`` of the features that are selected."""
        out = copy(self)
        for name in ("met", "found"):
            side = getattr(self, name)
            if side is not None:
                new = F.lit(None).cast("long").alias("new_idx")
                setattr(out, name, side.select("*", new) if selected is None
                        else side.join(sized_broadcast(selected.select("idx", "new_idx")), "idx", "left"))
        return out

    def among(self, rows: Column) -> "Weighed":
        """The same weights where only ``rows`` matter to the caller: others may be left out."""
        out = copy(self)
        if self.texts is not None:
            out.texts = self.texts.where(rows)
        return out

    def map(self, emit, schema: str) -> DataFrame:
        """The rows that ``emit`` makes of each weighed slice, one record batch each."""
        if self.met is not None:
            # the rows of a slice stay together through broadcast joins
            slices = _in_place()
            return self.met.mapInArrow(lambda batches: (emit(*s) for s in slices(batches)), schema)
        one = _looked_up(self.p, self.blocks)

        def group(rows, found):
            import pyarrow as pa
            return pa.Table.from_batches([emit(*one(rows, found))])
        return self.texts.groupBy("batch").cogroup(self.found.groupBy("batch")).applyInArrow(group, schema)


def id_field(rows: DataFrame) -> str:
    """The key of ``rows``, of whatever type it is, as a field of a schema."""
    return f"doc_id {rows.schema['doc_id'].dataType.simpleString()}"


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with the number of their slice, written: both sides of the look-up read them."""
    slices = _slicer()

    def number(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        at = (TaskContext.get().partitionId() << 33) - 1
        for part in slices(batches):
            at += 1
            yield pa.RecordBatch.from_arrays([pa.array(np.full(part.num_rows, at)), *part.columns], ["batch", *part.schema.names])
    schema = f"batch long, {id_field(rows)}, tag int, dense array<double>, wtok array<string>, norm string"
    return written(rows.select("doc_id", "tag", "dense", "wtok", "norm").mapInArrow(number, schema), "slices")


def slice_terms_of(texts: DataFrame, p: TfidfParams, blocks: tuple) -> DataFrame:
    """``(batch, block, term)``: the distinct terms of each slice of ``numbered`` rows."""
    slice_terms = _counter(p, blocks)

    def terms(batches):
        import numpy as np
        import pyarrow as pa
        for part in batches:
            of = part.column("batch").to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(of[1:] != of[:-1]) + 1, [len(of)]])
            for a, b in zip(cuts[:-1], cuts[1:]):
                rows = part.slice(a, b - a)
                for block, names, at, _, _ in slice_terms(rows.column("wtok"), rows.column("norm")):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), of[a])), pa.array(np.full(len(at), block, np.int32)),
                                                      names], ["batch", "block", "term"])
    # a slice may be read in parts, each with its own terms: the look-up takes the first of equal rows
    return texts.select("batch", "wtok", "norm").mapInArrow(terms, "batch long, block int, term string")


def class_sums(weighed: Weighed, tags_a_class: int, counted: int) -> DataFrame:
    """``(idx, class, w)``: sums of the weights, a row a slice, term and class; the class
    of a document is ``tag div tags_a_class``, and it counts if the rest is below ``counted``."""
    def sums(ids, tags, dense, docs, idx, new, w):
        import numpy as np
        import pyarrow as pa
        keep = (tags % tags_a_class < counted)[docs]
        docs, idx, w = docs[keep], idx[keep], w[keep]
        classes = tags.astype(np.int64) // tags_a_class
        n = int(classes.max()) + 1 if len(classes) else 1
        # the weights of a term stand together, so its runs are numbered without a sort
        first = np.flatnonzero(np.concatenate([[True], idx[1:] != idx[:-1]])) if len(idx) else np.empty(0, np.int64)
        known, at = idx[first], np.repeat(np.arange(len(first)), np.diff(np.append(first, len(idx))))
        total = np.bincount(at * n + classes[docs], w, len(known) * n).astype(float)
        some = np.flatnonzero(total)
        return pa.RecordBatch.from_arrays([pa.array(known[some // n]), pa.array((some % n).astype(np.int32)),
                                           pa.array(total[some])], ["idx", "class", "w"])
    return weighed.among(F.col("tag") % tags_a_class < counted).select(None).map(sums, "idx long, class int, w double")


def document_rows(weighed: Weighed, selected: DataFrame | None = None) -> DataFrame:
    """``(doc_id, tag, dense, indices, values)``, a row a document, indices ascending.
    ``selected``: ``(idx, new_idx)`` of the only features to give, under their ``new_idx``."""
    few = selected is not None

    def rows(ids, tags, dense, docs, idx, new, w):
        import numpy as np
        import pyarrow as pa
        if few:
            keep = new >= 0
            docs, idx, w = docs[keep], new[keep], w[keep]
        order = np.lexsort((idx, docs))
        ends = np.concatenate([[0], np.cumsum(np.bincount(docs, minlength=len(ids)))]).astype(np.int32)
        many = np.arange(len(ids) + 1, dtype=np.int32) * dense.shape[1]
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(tags), pa.ListArray.from_arrays(pa.array(many), pa.array(dense.ravel())),
             pa.ListArray.from_arrays(pa.array(ends), pa.array(idx[order])),
             pa.ListArray.from_arrays(pa.array(ends), pa.array(w[order]))], ["doc_id", "tag", "dense", "indices", "values"])
    return weighed.select(selected).map(rows, f"{weighed.id}, tag int, dense array<double>, indices array<long>, values array<double>")
