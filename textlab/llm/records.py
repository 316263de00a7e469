"""Operator 1: token ids as length-delimited binary records.

A shard is a plain file of frames

    length   8 bytes, unsigned little-endian: bytes of the payload
    check    4 bytes: masked CRC-32 of the length's 8 bytes
    payload  the ids, each as an unsigned little-endian integer of 2 or 4 bytes
    check    4 bytes: masked CRC-32 of the payload

with ``mask(c) = rotate_right(c, 15) + 0xa282ead8 (mod 2**32)``, so a file that
stores checksums of checksums does not look sound by chance. Beside it lies an
offset index (one 24-byte entry a record: doc_id, offset, number of ids), so a
reader can take records in any order with one seek each.

Shards follow ascending doc_id: rows are range-partitioned and sorted (equal
doc_ids by text, null doc_ids first). Every task writes under a private name
and then moves the file to its final one, so a repeated task replaces a file
by an equal one.

Nulls: a null text is empty, and an empty text is a record of the end id alone;
a null doc_id is stored as the smallest 64-bit integer and read back as null.
Texts of any length are one record; repeated rows are repeated records; an
empty table gives no shard. Columns besides id and text are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textlab.llm.shared import filesystem, fresh_folder, offsets_of, row_chunks, text_column, written
from textlab.llm.spans import LOWER, UnitStore

NO_ID = -(2**63)
_INDEX = np.dtype([("doc_id", "<i8"), ("offset", "<i8"), ("n_tokens", "<i8")])
_WIDTH = {2: np.dtype("<u2"), 4: np.dtype("<u4")}


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return (((c >> 15) | (c << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return b"".join((head, struct.pack("<I", masked(head)), payload, struct.pack("<I", masked(payload))))


def unframe(read) -> bytes | None:
    """The next payload from ``read(n)``; None at the end. Damage raises."""
    head = read(12)
    if not head:
        return None
    if len(head) < 12 or struct.unpack("<I", head[8:])[0] != masked(head[:8]):
        raise ValueError("damaged record length")
    n = struct.unpack("<Q", head[:8])[0]
    body = read(n + 4)
    if len(body) < n + 4 or struct.unpack("<I", body[n:])[0] != masked(body[:n]):
        raise ValueError("damaged record")
    return body[:n]


# ---- encoding -------------------------------------------------------------

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LETTER = np.zeros(256, bool)
for _a, _b in ("AZ", "az"):
    _LETTER[ord(_a):ord(_b) + 1] = True
_ASCII_OTHER = np.zeros(256, bool)
_ASCII_OTHER[:128] = ~_LETTER[:128]


def _latin_letter_ends(u8: np.ndarray) -> np.ndarray:
    """Last bytes of the letters U+00C0 to U+00FF (0xC3 and another byte)."""
    out = np.zeros(len(u8), bool)
    out[1:] = (u8[:-1] == 0xC3) & (u8[1:] != 0x97) & (u8[1:] != 0xB7)
    return out


def lowered(u8: np.ndarray) -> np.ndarray:
    """A-Z and the Latin-1 capitals in lower case, as the tokenizer makes them;
    other characters are left to the tokenizer."""
    out = LOWER[u8]
    if len(u8):
        out[_latin_letter_ends(u8) & (u8 <= 0x9E)] += 32
    return out


def text_units(u8: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans whose ids, joined, are the ids of the text for a tokenizer that
    splits at white space and at the end of letter runs: cut at ASCII white
    space (dropped) and between a letter (ASCII or Latin-1) and another ASCII
    character."""
    if not len(u8):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    space = _SPACE[u8]
    cut = np.zeros(len(u8) + 1, bool)
    cut[0] = cut[-1] = True
    cut[1:-1] = space[1:] | space[:-1] | ((_LETTER[u8] | _latin_letter_ends(u8))[:-1] & _ASCII_OTHER[u8[1:]])
    cut[offs] = True
    edge = np.flatnonzero(cut)
    starts, ends = edge[:-1], edge[1:]
    keep = ~space[starts]
    return starts[keep], ends[keep]


_STORES: dict[str, UnitStore] = {}
_WHOLE: dict[str, tuple] = {}


def unit_store(path: str) -> UnitStore:
    """The process's tokenizer of a file of the tokenizers library."""
    if path not in _STORES:
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        whole = Tokenizer.from_file(path)
        # Units are ordinary text; a text with the string of a special token is encoded whole.
        tok.encode_special_tokens = True

        def encode_new(u8, starts, ends):
            raw = u8.tobytes()
            enc = tok.encode_batch_fast([raw[a:b].decode("utf-8") for a, b in zip(starts.tolist(), ends.tolist())],
                                        add_special_tokens=False)
            ids = [e.ids for e in enc]
            n = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.fromiter((i for x in ids for i in x), np.int32, int(n.sum()))
            return flat, n

        _STORES[path] = UnitStore(encode_new)
        _WHOLE[path] = (whole, [t.content.encode("utf-8") for t in whole.get_added_tokens_decoder().values()])
    return _STORES[path]


def rows_with_special(raw: bytes, offs: np.ndarray, strings: list[bytes]) -> list[int]:
    """The rows that hold one of the strings."""
    rows = set()
    for x in strings:
        at = raw.find(x)
        while at >= 0:
            row = int(np.searchsorted(offs, at, "right")) - 1
            if at + len(x) <= offs[row + 1]:
                rows.add(row)
                at = raw.find(x, int(offs[row + 1]))
            else:  # it begins in one row and ends in another
                at = raw.find(x, at + 1)
    return sorted(rows)


def encode_rows(tokenizer: str, u8: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(flat ids, row offsets into them) of the texts of a chunk."""
    store = unit_store(tokenizer)
    whole, strings = _WHOLE[tokenizer]
    raw = u8.tobytes()
    special = rows_with_special(raw, offs, strings)
    u8 = lowered(u8)
    starts, ends = text_units(u8, offs)
    flat, n = store.ids(u8, starts, ends)
    row_first = np.searchsorted(starts, offs)
    cut = offsets_of(n)[row_first]
    if not special:
        return flat, cut
    parts = [flat[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
    for r in special:
        text = raw[offs[r]:offs[r + 1]].decode("utf-8")
        parts[r] = np.array(whole.encode(text, add_special_tokens=False).ids, flat.dtype)
    return np.concatenate(parts), offsets_of(np.array([len(x) for x in parts]))


# ---- files ----------------------------------------------------------------

_SHARD = "shard long, path string, first_id long, n_docs long, n_tokens long"


def write_records(docs: DataFrame, folder: str, tokenizer: str, end_id: int, vocabulary: int,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write shards and indexes under ``folder`` (a full URI); one row a shard.

    The tokenizer is one that lower-cases and splits at white space and letter
    runs; see ``text_units``."""
    wide = _WIDTH[2 if vocabulary <= 1 << 16 else 4]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def write(batches):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        part = TaskContext.get().partitionId()
        out = index = None
        at = n_docs = n_tokens = 0
        first = None
        end = np.array([end_id], wide).tobytes()
        fs, base = filesystem(folder)
        tmp = f"{base}/.part-{part:06d}-{uuid.uuid4().hex}"
        for batch in batches:
            data, offs = text_column(batch, "text")
            ids = batch.column(0).fill_null(NO_ID).to_numpy()
            for lo, hi in row_chunks(offs):
                if out is None:
                    fs.create_dir(base, recursive=True)
                    out, index, first = fs.open_output_stream(tmp), fs.open_output_stream(f"{tmp}.idx"), int(ids[lo])
                flat, cut = encode_rows(tokenizer, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
                body = flat.astype(wide).tobytes()
                frames, entry = [], np.zeros(hi - lo, _INDEX)
                for k, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist())):
                    frames.append(frame(body[a * wide.itemsize:b * wide.itemsize] + end))
                    entry[k] = (ids[lo + k], at, b - a + 1)
                    at += len(frames[-1])
                n_docs += hi - lo
                n_tokens += int(entry["n_tokens"].sum())
                out.write(b"".join(frames))
                index.write(entry.tobytes())
        if out is not None:
            out.close()
            index.close()
            final = f"{base}/part-{part:06d}"
            fs.move(f"{tmp}.idx", f"{final}.idx")
            fs.move(tmp, f"{final}.rec")
            yield pa.RecordBatch.from_pydict({
                "shard": [part], "path": [f"{folder}/part-{part:06d}"],
                "first_id": [first], "n_docs": [n_docs], "n_tokens": [n_tokens]})

    return written(rows.mapInArrow(write, _SHARD), "shards")


def read_records(shards: DataFrame, id_bytes: int, keep_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every record, one task a
    shard; ``start`` is the number of ids before the record over all shards.
    Without ``keep_ids`` the id lists are empty.
    Lengths and checksums are checked, and the index against the records."""
    before = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    # One row a file, not a document: the running sum over them is small.
    ahead = shards.select("shard", "path", F.coalesce(before, F.lit(0)).alias("before"))
    n = max(1, shards.count())
    wide = _WIDTH[id_bytes]

    def read(batches):
        for batch in batches:
            for path, start in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                fs, base = filesystem(path)
                with fs.open_input_stream(f"{base}.rec") as rec, fs.open_input_stream(f"{base}.idx") as idx:
                    at = 0
                    while raw := idx.read(_INDEX.itemsize * 512):
                        entries = np.frombuffer(raw, _INDEX)
                        out = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": [], "ids": []}
                        for doc, offset, n_ids in entries.tolist():
                            body = unframe(rec.read)
                            if body is None or offset != at or len(body) != n_ids * wide.itemsize:
                                raise ValueError(f"index and records of {path} differ")
                            ids = np.frombuffer(body, wide)
                            out["doc_id"].append(None if doc == NO_ID else doc)
                            out["start"].append(start)
                            out["n_tokens"].append(n_ids)
                            out["ids_crc32"].append(zlib.crc32(ids.astype("<u4").tobytes()))
                            out["ids"].append(ids.astype(np.int32) if keep_ids else ids[:0].astype(np.int32))
                            at += len(body) + 16
                            start += n_ids
                        cuts = offsets_of(np.array(list(map(len, out["ids"]))))
                        yield pa.RecordBatch.from_arrays([
                            pa.array(out["doc_id"], pa.int64()), pa.array(out["start"], pa.int64()),
                            pa.array(out["n_tokens"], pa.int64()), pa.array(out["ids_crc32"], pa.int64()),
                            pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(np.concatenate(out["ids"])))],
                            names=list(out))

    return ahead.repartition(n).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long, ids array<int>")


def read_at(path: str, number: int, id_bytes: int) -> tuple[int | None, np.ndarray]:
    """(doc_id, ids) of one record by its number, for shuffled readers."""
    fs, base = filesystem(path)
    with fs.open_input_file(f"{base}.idx") as idx:
        doc, offset, _ = np.frombuffer(idx.read_at(_INDEX.itemsize, number * _INDEX.itemsize), _INDEX)[0].tolist()
    with fs.open_input_file(f"{base}.rec") as rec:
        rec.seek(offset)
        return (None if doc == NO_ID else doc), np.frombuffer(unframe(rec.read), _WIDTH[id_bytes])


def token_records(docs: DataFrame, tokenizer: str, end_id: int = 2, vocabulary: int = 49_408,
                  folder: str | None = None, keep_ids: bool = True) -> DataFrame:
    """Write all documents as records, then read every shard back."""
    folder = folder or fresh_folder(docs.sparkSession, "records")
    shards = write_records(docs, folder, tokenizer, end_id, vocabulary)
    return read_records(shards, 2 if vocabulary <= 1 << 16 else 4, keep_ids)
