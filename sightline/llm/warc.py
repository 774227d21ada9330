"""WARC archives: written as whole-file gzip streams, normalised to one gzip member a record, read through an index.

Spark decides which rows are `response` and which `revisit` another (a grouped maximum over payload
hashes), and deals rows out; tasks write archives. A whole-file gzip stream can't be entered anywhere
but at its start, so the normaliser inflates it once, in small steps, and writes every record as a
member of its own with a line of a sidecar index: offset, length, type, id. Later readers seek.

Files lie in the shared folder, under names of their own for each attempt of a task; only those that a
finished task reports are read. A lost executor's files are written anew under other names.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_folder, small_batches, written

#: Plain bytes after which a task begins another archive.
ARCHIVE_BYTES = 1 << 28
STEP = 1 << 20
#: Headers longer than this are no record.
MOST_HEADER = 1 << 20
#: A payload that holds this part of all rows is hot; there are at most so many of them.
HOT_PARTS = 1000
LEVEL = 6
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


class BrokenArchive(ValueError):
    """What follows in an archive is no whole record."""


def _system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path within it."""
    path = re.sub(r"^file:/+", "/", path)
    return (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)


def _create(path: str) -> BinaryIO:
    system, at = _system(path)
    system.create_dir(at.rpartition("/")[0], recursive=True)
    return system.open_output_stream(at, compression=None)


def _open(path: str) -> BinaryIO:
    system, at = _system(path)
    return system.open_input_file(at)


# ---- records ----


def named(key: object) -> str:
    """A record's URN: the id in percent-encoding, nothing for a null id."""
    return f"<urn:page:{'' if key is None else quote(str(key), safe='') or '%'}>"


def key_of(name: str | None) -> str | None:
    """The id in a record's URN, as text."""
    key = name[len("<urn:page:") : -1] if name else ""
    return ("" if key == "%" else unquote(key)) if key else None


def _visible(text: str) -> str:
    """Control characters in percent-encoding, so that no value ends its header line."""
    return re.sub(r"[\x00-\x1f\x7f\x85  ]", lambda m: quote(m.group()), text)


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record(key: object, url: str | None, payload: bytes | None, size: int, sha1: bytes, refers_to: object = None, date: str = DATE) -> Iterator[bytes]:
    """A `response` with its payload, or, without one, a `revisit` of the record of `refers_to`, in pieces.

    The block is an HTTP answer; of a revisit it ends after the HTTP headers, which keep the payload's length.
    """
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if payload is None else 'response'}", f"WARC-Record-ID: {named(key)}", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_visible(url)}")
    lines.append(f"WARC-Payload-Digest: sha1:{base32_sha1(sha1)}")
    if payload is None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {named(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(http) + len(payload or b'')}"]
    yield "\r\n".join(lines).encode() + b"\r\n\r\n"
    yield http
    if payload:
        yield payload
    yield b"\r\n\r\n"


class Inflated:
    """The plain bytes of a gzip stream of one or many members, read forward in steps of bounded size."""

    def __init__(self, source: BinaryIO):
        self.source, self.held, self.member, self.left = source, bytearray(), None, b""

    def _more(self) -> bool:
        """Add at most STEP bytes to `held`; False at the end of a whole stream."""
        while True:
            data = self.left or self.source.read(STEP)
            if not data:
                if self.member is not None:
                    raise BrokenArchive("the gzip stream ends within a member")
                return False
            if self.member is None:
                self.member = zlib.decompressobj(31)
            try:
                out = self.member.decompress(data, STEP)
            except zlib.error as problem:
                raise BrokenArchive(f"no gzip data: {problem}") from problem
            self.left = self.member.unused_data if self.member.eof else self.member.unconsumed_tail
            if self.member.eof:
                self.member = None
            if out:
                self.held += out
                return True

    def header(self) -> bytes | None:
        """Up to and with the next empty line; None at the end."""
        seen = 0
        while (end := self.held.find(b"\r\n\r\n", seen)) < 0:
            seen = max(0, len(self.held) - 3)
            if len(self.held) > MOST_HEADER:
                raise BrokenArchive("a header without an end")
            if not self._more():
                if self.held:
                    raise BrokenArchive("the archive ends within a header")
                return None
        return self.take(end + 4)

    def take(self, n: int) -> bytes:
        out = bytes(self.held[:n])
        del self.held[:n]
        return out

    def block(self, n: int) -> Iterator[bytes]:
        """The next n bytes, in pieces."""
        while n:
            if not self.held and not self._more():
                raise BrokenArchive("the archive ends within a record")
            piece = self.take(min(n, len(self.held)))
            n -= len(piece)
            yield piece


def fields(header: bytes) -> dict[str, str]:
    """Named fields of a record's header, names in lower case."""
    first, *lines = header.decode("utf-8", "replace").split("\r\n")
    if not first.startswith("WARC/"):
        raise BrokenArchive("no WARC version where a record should begin")
    out = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if colon:
            out[name.strip().lower()] = value.strip()
    if not re.fullmatch("[0-9]+", out.get("content-length", "")):
        raise BrokenArchive("a record without Content-Length")
    return out


def normalise_stream(source: BinaryIO, sink: BinaryIO, level: int = LEVEL) -> Iterator[dict]:
    """Write each record of `source` to `sink` as a gzip member; yield its index line once it is written whole.

    Raises BrokenArchive where the stream ends early or is no WARC; the members before are whole then, and
    the broken record is not written.
    """
    plain, offset = Inflated(source), 0
    while (header := plain.header()) is not None:
        known = fields(header)
        member, pieces = zlib.compressobj(level, zlib.DEFLATED, 31), []
        pieces.append(member.compress(header))
        for piece in plain.block(int(known["content-length"])):
            pieces.append(member.compress(piece))
        if b"".join(plain.block(4)) != b"\r\n\r\n":
            raise BrokenArchive("a record without its two line ends")
        pieces += [member.compress(b"\r\n\r\n"), member.flush()]
        length = sum(map(len, pieces))
        for piece in pieces:
            sink.write(piece)
        yield {
            "offset": offset, "length": length, "type": known.get("warc-type"), "id": known.get("warc-record-id"),
            "digest": known.get("warc-payload-digest"), "uri": known.get("warc-target-uri")
        }
        offset += length


# ---- Spark ----


def decided(pages: DataFrame, id_col: str, url_col: str, payload_col: str, least: int) -> DataFrame:
    """(id, url, payload, size, sha1, refers_to) of each row; payload is null where it revisits `refers_to`."""
    text = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), text.alias("payload"))
    rows = rows.withColumn("size", F.octet_length("payload").cast("long")).withColumn("key", F.unhex(F.sha2("payload", 256)))
    groups = rows.where(F.col("size") >= least).groupBy("key").agg(F.max("id").alias("leader"), F.count("*").alias("copies"))
    shared = written(groups.where("copies > 1 AND leader IS NOT NULL"), "warc-leaders")
    total = pages.count()
    # At most HOT_PARTS rows, whatever the table: each stands for that part of all rows. They never shuffle by their key.
    hot = F.broadcast(shared.where(F.col("copies") * HOT_PARTS >= total).select("key", F.col("leader").alias("hot")))
    rows = rows.join(hot, "key", "left").withColumn("sha1", F.unhex(F.sha1("payload")))
    revisits_hot = F.col("hot").isNotNull() & ~F.coalesce(F.col("id") == F.col("hot"), F.lit(False))
    rows = rows.withColumn("payload", F.when(~revisits_hot, F.col("payload")))
    # Rows of hot payloads are dealt out by their place instead; such keys of 8 bytes meet none of 32.
    place = F.unhex(F.lpad(F.hex(F.monotonically_increasing_id()), 16, "0"))
    rows = rows.withColumn("key", F.when(F.col("hot").isNull(), F.col("key")).otherwise(place))
    rows = rows.join(shared.where(F.col("copies") * HOT_PARTS < total).select("key", "leader"), "key", "left")
    leader = F.coalesce("hot", "leader")
    revisits = leader.isNotNull() & ~F.coalesce(F.col("id") == leader, F.lit(False))
    return rows.select("id", "url", F.when(~revisits, F.col("payload")).alias("payload"), "size", "sha1", F.when(revisits, leader).alias("refers_to"))


def write_streams(rows: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES, level: int = LEVEL) -> DataFrame:
    """Write the rows of `decided` as archives of one gzip stream each; one row (path, records) for each archive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sink = stream = path = None
        records = filled = 0

        def closed() -> pa.RecordBatch:
            sink.write(stream.flush())
            sink.close()
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([records])], names=["path", "records"])

        for batch in batches:
            for key, url, payload, size, sha1, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if sink is None:
                    path, records, filled = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    sink, stream = _create(path), zlib.compressobj(level, zlib.DEFLATED, 31)
                body = None if payload is None else payload.encode()
                for piece in record(key, url, body, size, sha1, refers_to):
                    sink.write(stream.compress(piece))
                    filled += len(piece)
                records += 1
                if filled >= archive_bytes:
                    yield closed()
                    sink = None
        if sink is not None:
            yield closed()

    return rows.mapInArrow(run, "path string, records long")


def normalise(archives: DataFrame, folder: str, level: int = LEVEL) -> DataFrame:
    """(source, path, index, records, error) of each archive of `archives(path)`, rewritten into `folder`.

    An archive is one task's, as its stream has one entrance; memory is bounded by the largest record's
    compressed form. Streams of many members and mixed ones are taken too. `error` is null, or says why
    reading stopped; whole records before that are kept, and an archive without any gives an empty file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source in batch.column(0).to_pylist():
                path = f"{folder}/{uuid.uuid4().hex}.warc.gz"
                records, error = 0, None
                with _open(source) as plain, _create(path) as sink, _create(path + ".index") as index:
                    try:
                        for line in normalise_stream(plain, sink, level):
                            index.write(json.dumps(line).encode() + b"\n")
                            records += 1
                    except BrokenArchive as problem:
                        error = str(problem)
                columns = [[source], [path], [path + ".index"], [records], [error]]
                types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)], names=["source", "path", "index", "records", "error"]
                )

    return archives.select("path").mapInArrow(run, "source string, path string, index string, records long, error string")


def index_lines(reports: DataFrame) -> DataFrame:
    """(path, offset, length) of every record of `reports(path, index)`, in the archives' order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, index in zip(*(c.to_pylist() for c in batch.columns)):
                with _open(index) as lines:
                    known = [json.loads(line) for line in lines.read().splitlines()]
                columns = [pa.array([path] * len(known), pa.string()), *(pa.array([k[n] for k in known], pa.int64()) for n in ("offset", "length"))]
                yield pa.RecordBatch.from_arrays(columns, names=["path", "offset", "length"])

    return reports.select("path", "index").mapInArrow(run, "path string, offset long, length long")


def read_records(index: DataFrame, payloads: bool = False) -> DataFrame:
    """The records at `index(path, offset, length)`, each inflated alone: (id, uri, record_type, payload_bytes, payload_digest, refers_to[, payload]).

    Ids are text. A payload is hashed anew; one that isn't what its header says raises BrokenArchive.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, handle = None, None
        for batch in batches:
            out = []
            for path, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if path != opened:
                    if handle:
                        handle.close()
                    opened, handle = path, _open(path)
                handle.seek(offset)
                out.append(_read_member(handle.read(length), payloads))
            yield pa.RecordBatch.from_pylist(out, schema=schema)
        if handle:
            handle.close()

    names = ["id", "uri", "record_type", "payload_digest", "refers_to"]
    schema = pa.schema([(n, pa.string()) for n in names] + [("payload_bytes", pa.int64())] + ([("payload", pa.binary())] if payloads else []))
    kinds = ", ".join(f"{n} string" for n in names) + ", payload_bytes long" + (", payload binary" if payloads else "")
    return index.select("path", "offset", "length").mapInArrow(run, kinds)


def _read_member(member: bytes, payloads: bool) -> dict:
    plain = zlib.decompress(member, 31)
    header, _, rest = plain.partition(b"\r\n\r\n")
    known = fields(header)
    http, _, payload = rest[: int(known["content-length"])].partition(b"\r\n\r\n")
    digest, revisit = known["warc-payload-digest"].removeprefix("sha1:"), known["warc-type"] == "revisit"
    if not revisit and base32_sha1(hashlib.sha1(payload).digest()) != digest:
        raise BrokenArchive(f"the payload of {known['warc-record-id']} does not have its digest")
    size = int(re.search(rb"(?i)content-length: *([0-9]+)", http)[1]) if revisit else len(payload)
    out = {
        "id": key_of(known["warc-record-id"]), "uri": known.get("warc-target-uri"), "record_type": known["warc-type"], "payload_digest": digest,
        "refers_to": key_of(known.get("warc-refers-to")), "payload_bytes": size
    }
    return out | ({"payload": None if revisit else payload} if payloads else {})


def archive(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 0, archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Write a record for each row, normalise the archives; (source, path, index, records, error) of each.

    Of rows with equal payloads of at least `least` bytes those with the largest id are `response`, the
    others revisit it, null ids among them; where all ids are null, and for smaller payloads, all are
    `response`. A null payload is an empty one; a null url leaves its header out, and control characters
    of a url are written in percent-encoding. A table without rows gives no archives. Other columns are
    ignored.
    """
    small_batches(pages.sparkSession)
    folder = f"{shared_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    streams = written(write_streams(decided(pages, id_col, url_col, payload_col, least), f"{folder}/streams", archive_bytes), "warc-streams")
    files = streams.count()
    reports = written(normalise(streams.repartition(max(1, files)), folder), "warc-reports")
    if files:
        system, at = _system(f"{folder}/streams")
        system.delete_dir(at)
    return reports


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """(id, payload_bytes, payload_digest, record_type, refers_to) of each row of `pages`, read back from its archives through their indexes."""
    reports = archive(pages, id_col, url_col, payload_col, least, archive_bytes)
    broken = reports.where("error IS NOT NULL").select("source", "error").first()
    if broken:
        raise BrokenArchive(f"{broken['source']}: {broken['error']}")
    kind = dict(pages.dtypes)[id_col]
    found = read_records(index_lines(reports.repartition(max(1, reports.count()))))
    return found.select(
        F.col("id").cast(kind).alias(id_col), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to")
    )
