"""WARC archives: a writer with revisit records and a reader that salvages damaged files.

The reader walks a file from record to record and checks each one in full. After a failed check it
searches for the next gzip member or version line at which a whole valid record starts, goes on
there, and logs the bytes between as a quarantined gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from listmill.engine import cut
from listmill.llm.files import new_folder, opened

#: Payloads of fewer bytes are always written in full.
REVISIT_BYTES = 1000
#: An archive that has reached this size is closed and a new one begun.
ARCHIVE_BYTES = 64 << 20
#: Bytes read at a time.
READ_BYTES = 4 << 20

VERSION = b"WARC/1.1\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Fields that the format asks of every record.
REQUIRED = {"warc-type", "warc-record-id", "warc-date", "content-length"}
_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r\n")
_CONTROL = re.compile(r"[\x00-\x20\x7f]")

MANIFEST = "path string, records bigint, bytes bigint"
RECORDS = (
    "path string, first_byte bigint, n_bytes bigint, problem string, record_type string, page_id bigint, refers_to bigint,"
    " url string, payload_bytes bigint, payload_digest string, payload binary"
)


def _digest(sha1: bytes) -> str:
    return "sha1:" + base64.b32encode(sha1).decode()


def _page_urn(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid4()}>" if page_id is None else f"<urn:page:{page_id}>"


def _page_of(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def record_bytes(fields: dict[str, str | None], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None)
    return b"".join([VERSION, head.encode(), f"Content-Length: {len(block)}\r\n\r\n".encode(), block, b"\r\n\r\n"])


def page_record(page_id: int | None, url: str | None, payload: bytes, original: int | None, date: str) -> bytes:
    """A response, or with ``original`` (the page that holds the payload) a revisit without it."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if original is not None else http + payload
    return record_bytes(
        {
            "WARC-Type": "response" if original is None else "revisit",
            "WARC-Record-ID": _page_urn(page_id),
            "WARC-Date": date,
            "WARC-Target-URI": None if url is None else _CONTROL.sub(lambda c: f"%{ord(c[0]):02X}", url),
            "WARC-Payload-Digest": _digest(hashlib.sha1(payload).digest()),
            "WARC-Block-Digest": _digest(hashlib.sha1(block).digest()),
            "WARC-Profile": None if original is None else REVISIT_PROFILE,
            "WARC-Refers-To": None if original is None else _page_urn(original),
            "Content-Type": "application/http; msgtype=response",
        },
        block,
    )


def member(record: bytes) -> bytes:
    """A record as a gzip member of its own."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def with_originals(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """page_id, url, payload and, for rows whose payload another row holds, that row's id as ``original``.

    Equal payloads are found by their SHA-1. Groups are counted before anything is joined, and only
    payloads that occur more than once are looked up, so pages without copies are not shuffled;
    where they are, a frequent payload's rows can be split, the other side has one row a payload.
    """
    payload = F.encode(F.coalesce(F.col(html_column), F.lit("")), "UTF-8")
    rows = pages.select(
        F.col(id_column).cast("bigint").alias("page_id"), F.col(url_column).alias("url"), payload.alias("payload")
    ).withColumn("digest", F.when(F.octet_length("payload") >= REVISIT_BYTES, F.sha1("payload")))
    shared = (
        rows.where("digest is not null")
        .groupBy("digest")
        .agg(F.max("page_id").alias("original"), F.count("*").alias("n"))
        .where("n > 1 and original is not null")
        .select("digest", "original")
    )
    joined = rows.join(cut(shared), "digest", "left")
    is_original = F.col("page_id").eqNullSafe(F.col("original"))
    return joined.select("page_id", "url", "payload", F.when(~is_original, F.col("original")).alias("original"))


def write_archives(rows: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes a record per row of page_id, url, payload and original into gzip archives; returns the
    stored manifest: path, records, bytes.

    A null payload is empty, a null id gets a random record id. Every attempt of a task writes files
    of its own, and the manifest names those of the attempts that ended well, so a task that is run
    again leaves files that nobody reads. A partition without rows writes nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened(folder)
        store.create_dir(base, recursive=True)
        out, path, count, size = None, "", 0, 0
        done: list[tuple[str, int, int]] = []
        for batch in batches:
            for page_id, url, payload, original in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    path, count, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{base}/{path}", compression=None)
                data = member(page_record(page_id, url, payload or b"", original, date))
                out.write(data)
                count, size = count + 1, size + len(data)
                if size >= archive_bytes:
                    out.close()
                    done.append((path, count, size))
                    out = None
        if out is not None:
            out.close()
            done.append((path, count, size))
        if done:
            names, counts, sizes = zip(*done)
            yield pa.RecordBatch.from_arrays(
                [pa.array([f"{folder}/{n}" for n in names]), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())],
                names=["path", "records", "bytes"],
            )

    return cut(rows.select("page_id", "url", "payload", "original").mapInArrow(run, MANIFEST))


class Damaged(ValueError):
    """A record that fails a check."""


@dataclass
class Record:
    fields: dict[str, str]
    block: bytes

    @property
    def kind(self) -> str:
        return self.fields.get("warc-type", "")

    def http(self) -> tuple[int | None, bytes]:
        """Content-Length of the HTTP header, and what follows the header."""
        head, found, body = self.block.partition(b"\r\n\r\n")
        if not found:
            raise Damaged("no HTTP header")
        length = re.search(rb"(?im)^content-length:\s*(\d+)", head)
        return int(length[1]) if length else None, body


class Window:
    """A file read front to back through a buffer that keeps what lies behind the current place."""

    def __init__(self, file, size: int):
        self.file, self.size, self.start, self.data = file, size, 0, b""

    def drop(self, before: int) -> None:
        if before - self.start > READ_BYTES or before > self.start + len(self.data):
            self.data, self.start = self.data[before - self.start :], before

    def upto(self, end: int) -> None:
        """Bytes up to ``end``, as far as the file goes."""
        end = min(end, self.size)
        have = self.start + len(self.data)
        if end > have:
            self.file.seek(have)
            self.data += self.file.read(max(end - have, min(READ_BYTES, self.size - have)))

    def slice(self, a: int, b: int) -> bytes:
        self.upto(b)
        return self.data[a - self.start : b - self.start]


def _parsed(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {}
    for line in lines[1:]:
        name, found, value = line.partition(":")
        if not found:
            raise Damaged("a header line without a colon")
        fields[name.strip().lower()] = value.strip()
    if missing := REQUIRED - fields.keys():
        raise Damaged(f"no {', '.join(sorted(missing))}")
    if not re.fullmatch(r"[0-9]+", fields["content-length"]):
        raise Damaged("no content length")
    return fields


def _checked(fields: dict[str, str], block: bytes) -> Record:
    digest = fields.get("warc-block-digest")
    if digest and digest.startswith("sha1:") and digest != _digest(hashlib.sha1(block).digest()):
        raise Damaged("block digest differs")
    return Record(fields, block)


def _read_plain(window: Window, at: int) -> tuple[Record, int]:
    """The record whose version line starts at a byte, and where it ends."""
    head, step = b"", 4096
    while (end := head.find(b"\r\n\r\n")) < 0:
        if at + len(head) >= window.size or len(head) > READ_BYTES:
            raise Damaged("no end of the header")
        head = window.slice(at, at + len(head) + step)
        step *= 2
    fields = _parsed(head[:end])
    first, length = at + end + 4, int(fields["content-length"])
    if first + length + 4 > window.size:
        raise Damaged("cut off")
    if window.slice(first + length, first + length + 4) != b"\r\n\r\n":
        raise Damaged("no record end behind the block")
    return _checked(fields, window.slice(first, first + length)), first + length + 4


def _read_member(window: Window, at: int) -> tuple[Record, int]:
    unpacker, end, parts = zlib.decompressobj(31), at, []
    try:
        while not unpacker.eof:
            piece = window.slice(end, end + (64 << 10))
            if not piece:
                raise Damaged("cut off")
            parts.append(unpacker.decompress(piece))
            end += len(piece)
    except zlib.error as error:
        raise Damaged(f"gzip: {error}") from None
    end -= len(unpacker.unused_data)
    data = b"".join(parts)
    if not re.match(rb"WARC/1\.[01]\r\n", data):
        raise Damaged("a member without a version line")
    head, found, rest = data.partition(b"\r\n\r\n")
    if not found:
        raise Damaged("no end of the header")
    fields = _parsed(head)
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise Damaged("no record end behind the block")
    return _checked(fields, rest[:length]), end


def _read_at(window: Window, at: int) -> tuple[Record, int]:
    start = window.slice(at, at + 10)
    if start.startswith(b"\x1f\x8b\x08"):
        return _read_member(window, at)
    if _START.match(start):
        return _read_plain(window, at)
    raise Damaged("no record starts here")


def walk(window: Window) -> Iterator[tuple[int, int, Record | str]]:
    """(first byte, bytes, record or, for a gap, what was wrong there) over the whole file, in order."""
    at = 0
    while at < window.size:
        window.drop(at)
        try:
            record, end = _read_at(window, at)
        except Damaged as problem:
            gap, reason = at, str(problem)
            record, at, end = _search(window, at + 1)
            yield gap, at - gap, reason
        if record is not None:
            yield at, end - at, record
        at = end


def _search(window: Window, at: int) -> tuple[Record | None, int, int]:
    """The next whole valid record from a byte on, with its first and last byte; None at the file's end."""
    while at < window.size:
        window.drop(at)
        window.upto(at + READ_BYTES)
        found = _START.search(window.data, at - window.start)
        if found is None:
            at = max(at + 1, window.start + len(window.data) - 9)  # a start may lie across the border
            if window.start + len(window.data) >= window.size:
                break
            continue
        at = window.start + found.start()
        try:
            record, end = _read_at(window, at)
            return record, at, end
        except Damaged:
            at += 1
    return None, window.size, window.size


def _row(path: str, first: int, size: int, found: Record | str, keep_payload: bool) -> tuple:
    if isinstance(found, str):
        return path, first, size, found, None, None, None, None, None, None, None
    payload, digest, length = None, found.fields.get("warc-payload-digest", ""), None
    if found.kind in ("response", "revisit"):
        length, body = found.http()
        if found.kind == "response":
            payload, length, sha1 = body, len(body), hashlib.sha1(body).digest()
            if digest.startswith("sha1:") and digest != _digest(sha1):
                raise Damaged("payload digest differs")
            digest = sha1.hex()
        else:
            digest = base64.b32decode(digest.removeprefix("sha1:")).hex()
    fields = found.fields
    return (
        path, first, size, None, found.kind, _page_of(fields.get("warc-record-id")), _page_of(fields.get("warc-refers-to")),
        fields.get("warc-target-uri"), length, digest or None, payload if keep_payload else None,
    )


def read_archives(manifest: DataFrame, keep_payload: bool = True) -> DataFrame:
    """A row per record and per gap of the archives that ``manifest`` (path) names.

    path, first_byte and n_bytes say where; ``problem`` is null for records and says for gaps why
    the bytes were set aside; the rest is null for gaps. A record counts if its gzip checksum,
    content length, record end and digests hold. Records that lie whole in the payload of a damaged
    record are recovered as well. An empty file gives no rows. Archives are dealt out one by one.
    """
    rows_per_batch = 500

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                folder, _, name = path.rpartition("/")
                store, base = opened(folder)
                size = store.get_file_info(f"{base}/{name}").size
                rows, held = [], 0
                with store.open_input_file(f"{base}/{name}") as file:
                    for first, n, found in walk(Window(file, size)):
                        try:
                            row = _row(path, first, n, found, keep_payload)
                        except Damaged as problem:
                            row = _row(path, first, n, str(problem), keep_payload)
                        rows.append(row)
                        held += n
                        if len(rows) >= rows_per_batch or held > READ_BYTES:
                            yield packed(rows)
                            rows, held = [], 0
                if rows:
                    yield packed(rows)

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        types = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
        columns = [c.split() for c in RECORDS.split(",")]
        return pa.RecordBatch.from_arrays(
            [pa.array(v, types[kind]) for v, (_, kind) in zip(zip(*rows), columns)], names=[name for name, _ in columns]
        )

    paths = manifest.select("path")
    tasks = max(1, min(paths.count(), 100_000))
    return paths.repartition(tasks).mapInArrow(run, RECORDS)


def archive_pages(pages: DataFrame) -> DataFrame:
    """Writes every page into archives below the shared folder and reads them back.

    One row per page: page_id, payload_bytes, payload_digest, record_type, refers_to. Of equal
    payloads of at least 1000 bytes the largest page_id's is a response (all of them if that id is
    repeated), the others are revisits; null ids sort below all others, and if all ids of a group
    are null, each is a response. Null html is an empty payload. Gaps raise an error, as these
    archives were just written.
    """
    spark = pages.sparkSession
    manifest = write_archives(with_originals(pages), new_folder(spark, "warc"))
    read = read_archives(manifest, keep_payload=False)
    whole = F.when(F.col("problem").isNotNull(), F.raise_error(F.col("problem"))).otherwise(F.col("record_type"))
    return read.select("page_id", "payload_bytes", "payload_digest", whole.alias("record_type"), "refers_to")
