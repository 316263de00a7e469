"""Operator 8: SentencePiece encoding and decoding by suffix-array matching.

The texts of a batch are cut into units no piece can span, the units not yet
known are concatenated, and their suffixes are sorted. Every piece of the
vocabulary is binary-searched for the range of its occurrences; the occurrences
are the edges of a lattice over the text. Edges are sorted by end position and
relaxed in that order.

The relaxation is that of the model at hand, a byte-pair model, where the best
path is not a sum of scores: the encoding of a prefix that ends in piece t has,
before t, the encoding of the shorter prefix, and its last piece s must be one
that the merges leave apart from t, i.e. "s t" alone is encoded as (s, t). One
edge at each end satisfies this. Whether a pair stays apart is found by merging
its two pieces once and kept in a table of fixed size.

A character without a piece is an edge of its own and becomes its UTF-8 bytes.
Spaces are the piece mark; a mark is put before the text; decoding joins pieces,
turns marks into spaces and drops the first. A literal mark (U+2581) in a text
thus decodes to a space, as in the library.

Nulls and edges: a null or empty text has no ids; a null list of ids decodes
to null. Texts of any length are encoded whole. Results depend on the text
alone, so repeated rows are equal, and an empty table gives an empty one. All
input columns are kept; the columns added replace ones of the same name.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from textlab.llm.shared import list_array, offsets_of, ragged, row_chunks, text_column
from textlab.llm.spans import UnitStore

_MARK = "▁"
_MARK_BYTES = np.frombuffer(_MARK.encode(), np.uint8)
_SLOTS = 1 << 21
CHUNK = 4 << 20


def _windows(u8: np.ndarray, words: int) -> list[np.ndarray]:
    """Big-endian 64-bit windows at each byte and at 8, 16, ... bytes further."""
    n = len(u8)
    pad = np.concatenate([u8, np.full(8 * words, 0xFF, np.uint8)]).astype(np.uint64)
    one = np.zeros(n + 8 * (words - 1), np.uint64)
    for j in range(8):
        one = (one << np.uint64(8)) | pad[j:j + len(one)]
    return [one[8 * k:8 * k + n] for k in range(words)]


class PieceModel:
    """Vocabulary of a byte-pair SentencePiece model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.get_piece_size()
        self.unknown, self.start = self.size, self.size + 1
        self.byte_id = np.zeros(256, np.int32)
        self.id_of: dict[str, int] = {}
        self.score = {}
        raw: list[bytes] = []
        for i in range(self.size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[1:-1], 16)] = i
                raw.append(bytes([int(piece[1:-1], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                raw.append(b"")
            else:
                piece = piece.replace(_MARK, " ")
                self.id_of[piece] = i
                self.score[i] = sp.get_score(i)
                raw.append(piece.encode())
        self.text_of = {i: p for p, i in self.id_of.items()}
        if any(c not in self.id_of for p in self.id_of for c in p):
            raise ValueError("a piece holds a character that is no piece")
        self.piece_bytes = np.frombuffer(b"".join(raw), np.uint8)
        self.piece_len = np.fromiter(map(len, raw), np.int64, self.size)
        self.piece_at = np.cumsum(self.piece_len) - self.piece_len
        self._index_pieces()
        self._key = np.full(_SLOTS, -1, np.int64)
        self._apart = np.zeros(_SLOTS, bool)
        self.store = UnitStore(self._encode_units)

    def _index_pieces(self) -> None:
        ids = np.fromiter(self.text_of, np.int64, len(self.text_of))
        raw = [self.text_of[i].encode() for i in ids.tolist()]
        self.words = max(1, -(-max(map(len, raw)) // 8))
        width = 8 * self.words
        low = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in raw), ">u8").reshape(-1, self.words)
        high = np.frombuffer(b"".join(p.ljust(width, b"\xff") for p in raw), ">u8").reshape(-1, self.words)
        self.low, self.high = low.astype(np.uint64), high.astype(np.uint64)
        self.ids, self.lens = ids, np.fromiter(map(len, raw), np.int64, len(raw))
        # Byte pairs at character boundaries inside pieces; text is cut at all others.
        self.joined = np.zeros(1 << 16, bool)
        for p in self.text_of.values():
            b = [c.encode() for c in p]
            for x, y in zip(b, b[1:]):
                self.joined[x[-1] << 8 | y[0]] = True

    # -- pairs that merges leave apart --------------------------------------

    def merge(self, text: str) -> list[str]:
        """The pieces of a short text by repeated best merges, leftmost first."""
        parts = list(text)
        while len(parts) > 1:
            best, where = None, -1
            for k in range(len(parts) - 1):
                i = self.id_of.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.score[i] > best):
                    best, where = self.score[i], k
            if best is None:
                break
            parts[where:where + 2] = [parts[where] + parts[where + 1]]
        return parts

    def _stay_apart(self, s: int, t: int) -> bool:
        if t == self.unknown:
            return True
        right = self.text_of[t]
        if s >= self.size:
            return self.merge(right) == [right]
        left = self.text_of[s]
        return self.merge(left + right) == [left, right]

    def apart(self, s: np.ndarray, t: np.ndarray) -> np.ndarray:
        key = s * np.int64(self.size + 2) + t
        slot = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(43)).astype(np.int64)
        out = self._apart[slot]
        miss = np.flatnonzero(self._key[slot] != key)
        if len(miss):
            uniq, first, inv = np.unique(key[miss], return_index=True, return_inverse=True)
            at = miss[first]
            val = np.fromiter((self._stay_apart(a, b) for a, b in zip(s[at].tolist(), t[at].tolist())), bool, len(at))
            out[miss] = val[inv]
            self._key[slot[at]] = uniq
            # Two new keys may share a slot: keep the value of the key that stayed.
            stayed = self._key[slot[at]] == uniq
            self._apart[slot[at][stayed]] = val[stayed]
        return out

    # -- suffix matching ----------------------------------------------------

    def occurrences(self, u8: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, piece id) of every occurrence of every piece."""
        win = _windows(u8, self.words)
        heads = np.flatnonzero((u8 & 0xC0) != 0x80)
        heads = heads[u8[heads] != 0xFF]
        order = heads[np.lexsort([w[heads] for w in reversed(win)])]
        first = win[0][order]
        lo = np.searchsorted(first, self.low[:, 0], "left")
        hi = np.searchsorted(first, self.high[:, 0], "right")
        for k in range(1, self.words):  # longer pieces narrow their range by the next eight bytes
            long = np.flatnonzero((self.lens > 8 * k) & (hi > lo))
            if not len(long):
                break
            w = win[k][order]
            a, b = lo[long].copy(), hi[long].copy()
            lo[long] = self._bound(w, a, b, self.low[long, k], False)
            hi[long] = self._bound(w, a, b, self.high[long, k], True)
        n = np.maximum(hi - lo, 0)
        return order[ragged(lo, n)], np.repeat(self.lens, n), np.repeat(self.ids, n)

    @staticmethod
    def _bound(w: np.ndarray, lo: np.ndarray, hi: np.ndarray, key: np.ndarray, right: bool) -> np.ndarray:
        lo, hi = lo.copy(), hi.copy()
        while (open_ := lo < hi).any():
            mid = (lo + hi) // 2
            v = w[np.minimum(mid, len(w) - 1)]
            up = open_ & ((v <= key) if right else (v < key))
            lo = np.where(up, mid + 1, lo)
            hi = np.where(open_ & ~up, mid, hi)
        return lo

    def _encode_units(self, u8: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, counts) of the units by relaxing the sorted edges."""
        lens = ends - starts
        begin = np.cumsum(lens + 1) - lens - 1
        text = np.full(int(lens.sum()) + len(lens), 0xFF, np.uint8)
        text[ragged(begin, lens)] = u8[ragged(starts, lens)]
        s, n, t = self.occurrences(text)
        heads = np.flatnonzero((text & 0xC0) != 0x80)
        step = np.diff(np.append(heads, len(text)))
        real = text[heads] != 0xFF
        heads, step = heads[real], step[real]
        width = np.zeros(len(text), np.int64)
        width[heads] = step
        known = np.zeros(len(text), bool)
        known[s[n == width[s]]] = True
        odd = heads[~known[heads]]
        s = np.concatenate([s, odd])
        n = np.concatenate([n, width[odd]])
        t = np.concatenate([t, np.full(len(odd), self.unknown)])
        unit_of = np.repeat(np.arange(len(lens)), lens + 1)
        rel = s + n - begin[unit_of[s]]
        small = rel.astype(np.uint16) if len(rel) and rel.max() < 1 << 16 else rel
        order = np.argsort(small, kind="stable")
        s, n, t, rel = s[order], n[order], t[order], rel[order]
        last = np.full(len(text) + 1, -1, np.int64)
        back = np.zeros(len(text) + 1, np.int64)
        last[begin] = self.start
        cuts = np.append(np.flatnonzero(np.diff(rel, prepend=-1)), len(rel))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            before = last[s[a:b]]
            ok = before >= 0
            ok[ok] = self.apart(before[ok], t[a:b][ok])
            end = s[a:b][ok] + n[a:b][ok]
            last[end] = t[a:b][ok]
            back[end] = s[a:b][ok]
        return self._trace(text, begin, begin + lens, last, back)

    def _trace(self, text, begin, end, last, back) -> tuple[np.ndarray, np.ndarray]:
        units, ids, at = [], [], []
        unit, cur = np.arange(len(begin)), end.copy()
        while len(unit):
            if (last[cur] < 0).any():
                raise ValueError("a text has no path of pieces")
            units.append(unit)
            ids.append(last[cur])
            at.append(back[cur])
            cur = back[cur]
            more = cur > begin[unit]
            unit, cur = unit[more], cur[more]
        if not units:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        unit, tok, pos = np.concatenate(units), np.concatenate(ids), np.concatenate(at)
        order = np.lexsort([pos, unit])
        unit, tok, pos = unit[order], tok[order], pos[order]
        lead = text[pos]
        size = np.where(tok == self.unknown, 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0), 1)
        flat = np.repeat(tok, size)
        place = np.flatnonzero(np.repeat(tok == self.unknown, size))
        flat[place] = self.byte_id[text[ragged(pos, size)[place]]]
        return flat.astype(np.int32), np.bincount(unit, size, len(begin)).astype(np.int64)

    # -- texts --------------------------------------------------------------

    def encode(self, u8: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, row offsets) of the texts of a chunk."""
        u8, offs = self.marked(u8, offs)
        if not len(u8):
            return np.zeros(0, np.int32), np.zeros(len(offs), np.int64)
        cut = np.ones(len(u8) + 1, bool)
        cut[1:-1] = ~self.joined[(u8[:-1].astype(np.int64) << 8) | u8[1:]] & ((u8[1:] & 0xC0) != 0x80)
        cut[offs] = True
        edge = np.flatnonzero(cut)
        flat, n = self.store.ids(u8, edge[:-1], edge[1:])
        return flat, offsets_of(n)[np.searchsorted(edge[:-1], offs)]

    @staticmethod
    def spaced(u8: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The texts with literal marks as spaces."""
        m = np.flatnonzero((u8[:-2] == _MARK_BYTES[0]) & (u8[1:-1] == _MARK_BYTES[1]) & (u8[2:] == _MARK_BYTES[2])) \
            if len(u8) > 2 else np.zeros(0, np.int64)
        if not len(m):
            return u8, offs
        drop = np.ones(len(u8), bool)
        drop[m + 1] = drop[m + 2] = False
        u8 = u8.copy()
        u8[m] = 0x20
        return u8[drop], offs - 2 * np.searchsorted(m, offs)

    def marked(self, u8: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The texts with a space before each that is not empty."""
        u8, offs = self.spaced(u8, offs)
        some = np.diff(offs) > 0
        return np.insert(u8, offs[:-1][some], 0x20), offs + offsets_of(some)

    def decode(self, flat: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(UTF-8 bytes, row offsets) of the rows of ids."""
        flat = flat.astype(np.int64)
        n = self.piece_len[flat]
        out = self.piece_bytes[ragged(self.piece_at[flat], n)]
        cut = offsets_of(n)[offs]
        lead = cut[:-1][np.diff(cut) > 0]
        lead = lead[out[lead] == 0x20]
        return np.delete(out, lead), cut - np.searchsorted(lead, cut, "left")


_MODELS: dict[str, PieceModel] = {}


def piece_model(path: str) -> PieceModel:
    """The process's model of a file."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def _with(batch: pa.RecordBatch, added: dict[str, pa.Array], drop: tuple[str, ...] = ()) -> pa.RecordBatch:
    names = [c for c in batch.schema.names if c not in added and c not in drop]
    cols = [batch.column(batch.schema.get_field_index(c)) for c in names]
    return pa.RecordBatch.from_arrays(cols + list(added.values()), names=names + list(added))


def _schema(df: DataFrame, added: list[tuple[str, T.DataType]]) -> T.StructType:
    new = {c for c, _ in added}
    return T.StructType([f for f in df.schema.fields if f.name not in new] + [T.StructField(c, t) for c, t in added])


def encode_documents(docs: DataFrame, model: str, text_col: str = "text", check: bool = False) -> DataFrame:
    """``docs`` with ``ids`` (array of int), ``n_tokens`` and ``ids_crc32`` (of
    the ids as little-endian unsigned 32-bit integers); with ``check`` also
    ``round_trip``: whether the ids decode to the text."""
    added = [("ids", T.ArrayType(T.IntegerType())), ("n_tokens", T.LongType()), ("ids_crc32", T.LongType())]
    added += [("round_trip", T.BooleanType())] * check

    def run(batches):
        m = piece_model(model)
        for batch in batches:
            data, offs = text_column(batch, text_col)
            for lo, hi in row_chunks(offs, CHUNK):
                u8, cut = data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
                flat, at = m.encode(u8, cut)
                raw = flat.astype("<u4").tobytes()
                new = {"ids": list_array(flat, at, pa.int32()), "n_tokens": pa.array(np.diff(at)),
                       "ids_crc32": pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())],
                                             pa.int64())}
                if check:
                    want, want_at = m.spaced(u8, cut)
                    got, got_at = m.decode(flat, at)
                    if (want_at == got_at).all():
                        wrong = np.append(0, np.cumsum(want != got))
                        same = wrong[want_at[1:]] == wrong[want_at[:-1]]
                    else:
                        same = np.array([bytes(want[a:b]) == bytes(got[c:d]) for a, b, c, d in
                                         zip(want_at[:-1], want_at[1:], got_at[:-1], got_at[1:])], bool)
                    new["round_trip"] = pa.array(same)
                yield _with(batch.slice(lo, hi - lo), new)

    return docs.mapInArrow(run, _schema(docs, added))


def decode_ids(df: DataFrame, model: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with the text of its ids; bytes that are no UTF-8 become U+FFFD."""
    def run(batches):
        m = piece_model(model)
        for batch in batches:
            col = batch.column(batch.schema.get_field_index(ids_col))
            texts = []
            for k in range(len(col)):
                ids = col[k].values
                if not col[k].is_valid:
                    texts.append(None)
                    continue
                flat = ids.to_numpy(zero_copy_only=False).astype(np.int64)
                out, _ = m.decode(flat, np.array([0, len(flat)]))
                texts.append(out.tobytes().decode("utf-8", "replace"))
            yield _with(batch, {text_col: pa.array(texts, pa.string())})

    return df.mapInArrow(run, _schema(df, [(text_col, T.StringType())]))
