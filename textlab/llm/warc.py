"""Operator 5: WARC archives, and the normaliser of monolithic gzip.

Archives that were compressed as one gzip stream cannot be read at a record.
The normaliser inflates such a file once, front to back, writes every record as
a gzip member of its own, and puts an offset index beside the file: one line
``offset <tab> length <tab> record id`` a member. A reader then takes any record
with one seek.

``write_archives`` makes the (monolithic) archives of a page table. Of records
with equal payloads of at least ``MIN_REVISIT`` bytes, the one with the largest
page_id is a response and the others are revisits that name it and carry its
HTTP head only; smaller payloads are always responses. Equality is that of
SHA-1 and length, found by a map-side combined aggregation, so payloads
themselves meet nowhere and a payload with a third of all rows is no hot group.

Files are streamed: memory is bounded by one record. Tasks write under private
names and move files to their final ones, so a repeated task replaces a file by
an equal one.

Nulls and edges: a null payload is empty; a null url leaves out the target
header; a null page_id is never named by a revisit and is read back as null. A
payload of any length is one record. Rows that repeat the page_id and payload of
a response are responses as well. An empty table gives no archive and no rows;
further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.llm.shared import filesystem, fresh_folder, text_column, written

MIN_REVISIT = 1000
LEVEL = 6
DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the URL name space of RFC 4122
_FILES = "path string, n_records long"


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'page:{page_id}:{digest}')}>"


def _safe(url: str) -> str:
    return "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace"))
                   for c in url)


def build_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; ``digest`` is the hex SHA-1 of the full payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {record_id(page_id, digest)}", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
            "Content-Type: application/http; msgtype=response"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_safe(url)}")
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest)}",
                 f"X-Refers-To-Page-Id: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_head(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/1."):
        raise ValueError("no WARC record")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


class Inflated:
    """Bytes of a gzip file, whatever its members, from ``read(n)``."""

    def __init__(self, read, chunk: int = 1 << 20):
        self._read, self._chunk = read, chunk
        self._z, self._raw, self._out = zlib.decompressobj(31), b"", b""

    def _more(self) -> bool:
        """Adds some bytes; False at the end of the file."""
        while True:
            if not self._raw:
                self._raw = self._read(self._chunk)
                if not self._raw:
                    if not self._z.eof and self._began:
                        raise ValueError("the gzip stream ends early")
                    return False
            if self._z.eof:
                self._z = zlib.decompressobj(31)
            got = self._z.decompress(self._raw, self._chunk)
            self._began = True
            self._raw = self._z.unused_data if self._z.eof else self._z.unconsumed_tail
            if got:
                self._out += got
                return True

    _began = False

    def until(self, mark: bytes) -> bytes:
        """Bytes up to and with ``mark``; empty at the end."""
        seen = 0
        while (at := self._out.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self._out)
            if not self._more():
                if self._out:
                    raise ValueError("a record ends early")
                return b""
        return self.take(at + len(mark))

    def take(self, n: int) -> bytes:
        if len(self._out) < n:
            parts, have = [self._out], len(self._out)
            while have < n:
                self._out = b""
                if not self._more():
                    raise ValueError("a record ends early")
                parts.append(self._out)
                have += len(self._out)
            self._out = b"".join(parts)
        got, self._out = self._out[:n], self._out[n:]
        return got


def records(read) -> Iterator[tuple[dict[str, str], bytes]]:
    """(head, whole record) of every record of a gzip file."""
    src = Inflated(read)
    while raw := src.until(b"\r\n\r\n"):
        head = parse_head(raw[:-4])
        yield head, raw + src.take(int(head["content-length"]) + 4)


def page_of(head: dict[str, str], record: bytes) -> dict:
    """Digest columns of a record; a response's digest is checked."""
    block = record[record.index(b"\r\n\r\n") + 4:-4]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = base64.b32decode(head["warc-payload-digest"].partition(":")[2]).hex()
    size = next(int(x.partition(":")[2]) for x in http.decode("latin-1").split("\r\n")[1:]
                if x.lower().startswith("content-length:"))
    kind = head["warc-type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("a payload and its digest differ")
    number = lambda name: int(head[name]) if name in head else None
    return {"page_id": number("x-page-id"), "payload_bytes": size, "payload_digest": digest, "record_type": kind,
            "refers_to": number("x-refers-to-page-id"), "url": head.get("warc-target-uri"), "payload": payload}


def revisits(pages: DataFrame, least: int = MIN_REVISIT) -> DataFrame:
    """(page_id, digest, n, refers_to) of the pages whose payload another holds."""
    keys = pages.select("page_id", "digest", "n").where((F.col("n") >= least) & F.col("page_id").isNotNull())
    owner = keys.groupBy("digest", "n").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("c")).where("c > 1")
    return keys.distinct().join(owner.drop("c"), ["digest", "n"]).where("page_id <> refers_to")


def write_archives(pages: DataFrame, folder: str, level: int = LEVEL) -> DataFrame:
    """Monolithic gzip archives of (page_id, url, html); one row a file."""
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", body.alias("payload")).select(
        "page_id", "url", "payload", F.sha1("payload").alias("digest"), F.octet_length("payload").cast("long").alias("n"))
    again = revisits(rows)
    rows = rows.join(again, ["page_id", "digest", "n"], "left")

    def write(batches):
        fs, base = filesystem(folder)
        part, n, out = TaskContext.get().partitionId(), 0, None
        tmp, z = f"{base}/.mono-{part:06d}-{uuid.uuid4().hex}", zlib.compressobj(level, zlib.DEFLATED, 31)
        for batch in batches:
            data, offs = text_column(batch, "payload")
            get = {c: batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("page_id", "url", "digest", "refers_to")}
            for k in range(batch.num_rows):
                if out is None:
                    fs.create_dir(base, recursive=True)
                    out = fs.open_output_stream(tmp)
                out.write(z.compress(build_record(get["page_id"][k], get["url"][k], data[offs[k]:offs[k + 1]].tobytes(),
                                                  get["digest"][k], get["refers_to"][k])))
                n += 1
        if out is not None:
            out.write(z.flush())
            out.close()
            fs.move(tmp, f"{base}/mono-{part:06d}.warc.gz")
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/mono-{part:06d}.warc.gz"], "n_records": [n]})

    return written(rows.mapInArrow(write, _FILES), "archives")


def _spread(files: DataFrame) -> DataFrame:
    """One task a file."""
    return files.select("path").repartition(max(1, files.count()))


def normalise(files: DataFrame, folder: str, level: int = LEVEL) -> DataFrame:
    """Rewrite each archive record by record with its index; one row a file."""
    def rewrite(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, src = filesystem(path)
                to_fs, base = filesystem(folder)
                to_fs.create_dir(base, recursive=True)
                name = src.rsplit("/", 1)[1].replace("mono-", "record-")
                tmp, at, n = f"{base}/.{name}-{uuid.uuid4().hex}", 0, 0
                with fs.open_input_stream(src, compression=None) as raw, \
                        to_fs.open_output_stream(tmp, compression=None) as out, to_fs.open_output_stream(f"{tmp}.idx") as idx:
                    for head, record in records(raw.read):
                        member = zlib.compress(record, level, 31)
                        out.write(member)
                        idx.write(f"{at}\t{len(member)}\t{head['warc-record-id']}\n".encode())
                        at += len(member)
                        n += 1
                to_fs.move(f"{tmp}.idx", f"{base}/{name}.idx")
                to_fs.move(tmp, f"{base}/{name}")
                yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "n_records": [n]})

    return written(_spread(files).mapInArrow(rewrite, _FILES), "archives")


def read_at(path: str, offset: int, length: int) -> dict:
    """The page of one record of a normalised archive."""
    fs, base = filesystem(path)
    with fs.open_input_file(base) as f:
        record = zlib.decompress(f.read_at(length, offset), 31)
    return page_of(parse_head(record[:record.index(b"\r\n\r\n")]), record)


def read_archives(files: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url) of
    every record of normalised archives, taken by their indexes."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]

    def read(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, base = filesystem(path)
                with fs.open_input_stream(f"{base}.idx") as f, fs.open_input_file(base) as data:
                    rest, rows = b"", []
                    while got := f.read(1 << 16):
                        *lines, rest = (rest + got).split(b"\n")
                        for line in lines:
                            offset, length, rid = line.decode().split("\t")
                            record = zlib.decompress(data.read_at(int(length), int(offset)), 31)
                            head = parse_head(record[:record.index(b"\r\n\r\n")])
                            if head["warc-record-id"] != rid:
                                raise ValueError(f"index and records of {path} differ")
                            page = page_of(head, record)
                            rows.append([page[c] for c in names])
                        if rows:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
                            rows = []

    return _spread(files).mapInArrow(
        read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string")


def archive_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write, normalise and read back the archives of a page table."""
    folder = folder or fresh_folder(pages.sparkSession, "warc")
    return read_archives(normalise(write_archives(pages, f"{folder}/mono"), f"{folder}/records"))
