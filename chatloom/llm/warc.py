"""WARC archives: writing records, normalising whole-file gzip, reading by offset.

``write_archives`` writes a record per page into archives that are one gzip
stream each, as a naive crawler leaves them.  ``normalise`` inflates such a
stream once, from start to end, and rewrites every record as a gzip member of
its own beside an index of member offsets, so that any record can be read
alone.  ``read_archives`` reads records back through that index.

Equal payloads are stored once: of the pages with equal payloads the one with
the largest page_id is the response, the others are revisit records that name
it.  Which is which is decided on ids and digests alone; of a revisit neither the
payload is moved nor read again.  All files lie in the shared folder; a task writes under a temporary name
and renames, so a task that runs again leaves the same files.
"""

from __future__ import annotations

import base64
import hashlib
import io
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import delete, discard, in_batches, new_path, with_columns_of, written

#: Fixed values of the WARC format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")

CHUNK = 1 << 20
PAGE = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


class Folder:
    """A folder in the shared store: local paths by open(), others by pyarrow's file systems."""

    def __init__(self, path: str):
        self.path = path
        self.local = path.startswith(("/", "file:"))
        if self.local:
            self.root = "/" + re.sub(r"^file:/*", "", path).lstrip("/") if path.startswith("file:") else path
            os.makedirs(self.root, exist_ok=True)
        else:
            from pyarrow import fs

            self.fs, self.root = fs.FileSystem.from_uri(path)
            self.fs.create_dir(self.root, recursive=True)

    def write(self, name: str):
        return open(f"{self.root}/{name}", "wb") if self.local else self.fs.open_output_stream(f"{self.root}/{name}")

    def read(self, name: str):
        return open(f"{self.root}/{name}", "rb") if self.local else self.fs.open_input_file(f"{self.root}/{name}")

    def rename(self, old: str, new: str) -> None:
        if self.local:
            os.replace(f"{self.root}/{old}", f"{self.root}/{new}")
        else:
            self.fs.move(f"{self.root}/{old}", f"{self.root}/{new}")

    def remove(self, name: str) -> None:
        if self.local:
            os.remove(f"{self.root}/{name}")
        else:
            self.fs.delete_file(f"{self.root}/{name}")


class _Out:
    """A file under a temporary name, renamed when it is whole; counts its bytes."""

    def __init__(self, folder: Folder, name: str):
        self.folder, self.name, self.temp = folder, name, f".{name}.{uuid.uuid4().hex}"
        self.file, self.at = folder.write(self.temp), 0

    def write(self, data: bytes) -> None:
        self.file.write(data)
        self.at += len(data)

    def close(self) -> None:
        self.file.close()
        self.folder.rename(self.temp, self.name)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url, payload: bytes, sha: str, size: int, refers_to=None) -> tuple[bytes, bytes]:
    """Head and payload of a record; a revisit (refers_to) has no payload. The HTTP head keeps the payload's full length in a revisit too."""
    url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else f"urn:page:{page_id}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = [
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(NAMESPACE, f'page:{page_id}')}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{sha}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(http) + len(payload)}",
    ]
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(NAMESPACE, f'page:{refers_to}')}>", f"X-Refers-To-Page-Id: {refers_to}"]
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + http, payload


def headers(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:] if x)}


def _write_part(folder_path: str, level: int, roll: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        folder, part = Folder(folder_path), TaskContext.get().partitionId()
        out = gz = None
        done: list[tuple[str, int]] = []
        n = size = 0

        def close():
            nonlocal out, gz
            if out is not None:
                out.write(gz.flush())
                out.close()
                done.append((out.name, n))
                out = gz = None

        for batch in batches:
            for page_id, url, html, sha, n_bytes, refers_to in zip(*(batch.column(c) for c in ("page_id", "url", "html", "sha", "n_bytes", "refers_to")), strict=True):
                if out is not None and size >= roll:
                    close()
                if out is None:
                    out, gz, n, size = _Out(folder, f"part-{part:06d}-{len(done):04d}.warc.gz"), zlib.compressobj(level, zlib.DEFLATED, 31), 0, 0
                sha32 = base64.b32encode(bytes.fromhex(sha.as_py())).decode()
                head, body = record(page_id.as_py(), url.as_py(), html.as_py() or b"", sha32, n_bytes.as_py(), refers_to.as_py())
                for x in (head, body, b"\r\n\r\n"):
                    out.write(gz.compress(x))
                size += len(head) + len(body)
                n += 1
        close()
        yield pa.RecordBatch.from_pydict({"file": [x for x, _ in done], "records": [x for _, x in done]}, pa.schema([("file", pa.string()), ("records", pa.int64())]))

    return run


def _inflated(file) -> Iterator[bytes]:
    """The bytes of a gzip file of one member or more, in bounded pieces."""
    z = zlib.decompressobj(31)
    data = file.read(CHUNK)
    while data:
        out = z.decompress(data, CHUNK)
        if out:
            yield out
        data = z.unconsumed_tail
        if z.eof:
            data, z = z.unused_data, zlib.decompressobj(31)
        if not data:
            data = file.read(CHUNK)
    out = z.flush()
    if out:
        yield out


class _Stream:
    def __init__(self, chunks: Iterator[bytes]):
        self.chunks, self.buf = chunks, bytearray()

    def more(self) -> bool:
        for x in self.chunks:
            self.buf += x
            return True
        return False

    def head(self) -> bytes | None:
        """Up to and with the empty line that ends a record's head; None at the end."""
        while (at := self.buf.find(b"\r\n\r\n")) < 0:
            if not self.more():
                if self.buf.strip():
                    raise ValueError("the archive ends within a record's head")
                return None
        out = bytes(self.buf[: at + 4])
        del self.buf[: at + 4]
        return out

    def take(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.buf and not self.more():
                raise ValueError("the archive ends within a record")
            out = bytes(self.buf[:n])
            del self.buf[: len(out)]
            n -= len(out)
            yield out


def normalise_file(source: Folder, name: str, target: Folder, level: int = 6) -> tuple[str, str, int]:
    """Rewrite one archive with a gzip member a record; return its name, its index's and the number of records.

    The index has a line a record: offset, length, type and record id, tab-separated.
    A record is copied in pieces, so memory doesn't grow with a record.
    """
    index_name = re.sub(r"\.gz$", "", name) + ".idx"
    with source.read(name) as file:
        stream, out, index, n = _Stream(_inflated(file)), _Out(target, name), _Out(target, index_name), 0
        while (head := stream.head()) is not None:
            h = headers(head)
            gz, start = zlib.compressobj(level, zlib.DEFLATED, 31), out.at
            out.write(gz.compress(head))
            for piece in stream.take(int(h["content-length"])):
                out.write(gz.compress(piece))
            if b"".join(stream.take(4)) != b"\r\n\r\n":
                raise ValueError("a record doesn't end in two empty lines")
            out.write(gz.compress(b"\r\n\r\n") + gz.flush())
            index.write(f"{start}\t{out.at - start}\t{h['warc-type']}\t{h['warc-record-id']}\n".encode())
            n += 1
        out.close()
        index.close()
    return name, index_name, n


def parse_record(member: bytes) -> dict:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, url and payload of one member."""
    data = zlib.decompress(member, 31)
    at = data.index(b"\r\n\r\n") + 4
    h = headers(data[:at])
    block = data[at : at + int(h["content-length"])]
    cut = block.index(b"\r\n\r\n") + 4
    http = headers(block[:cut])
    revisit = h["warc-type"] == "revisit"
    payload, stated = block[cut:], h["warc-payload-digest"].removeprefix("sha1:")
    if not revisit and digest(payload) != stated:
        raise ValueError(f"the payload of {h['warc-record-id']} doesn't have its digest")
    number = lambda x: int(x) if x is not None else None
    return {
        "page_id": number(h.get("x-page-id")), "payload_bytes": int(http["content-length"]), "payload_digest": stated, "record_type": h["warc-type"],
        "refers_to": number(h.get("x-refers-to-page-id")), "url": h["warc-target-uri"], "payload": None if revisit else payload,
    }


def write_archives(pages: DataFrame, min_revisit_bytes: int = 0, level: int = 1, roll_bytes: int = 64 << 20) -> tuple[str, DataFrame]:
    """Write the pages; return the folder and a frame of (file, records).

    A null html is an empty payload. Payloads under ``min_revisit_bytes`` are
    always responses. Rows that repeat the largest page_id are all responses;
    a null page_id is never the largest. Payload digests are compared, not texts.
    """
    spark = pages.sparkSession
    base = with_columns_of(pages, {"page_id": "long", "url": "string", "html": "string"})
    base = base.withColumn("html", F.coalesce(F.col("html"), F.lit("")).cast("binary")).withColumn("sha", F.sha1("html")).withColumn("n_bytes", F.octet_length("html"))
    # A row a payload that repeats; written, so that Spark can split the pages of one with many copies in the joins after it.
    repeats = base.filter(F.col("n_bytes") >= min_revisit_bytes).groupBy("sha").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
    repeats = written(repeats.filter((F.col("n") > 1) & F.col("keeper").isNotNull()).select(F.col("sha").alias("repeated"), "keeper"), "warc-repeats")
    revisits = base.select("page_id", "url", "sha", "n_bytes").join(repeats.hint("shuffle_hash"), F.col("sha") == F.col("repeated")).filter(~F.col("keeper").eqNullSafe(F.col("page_id")))
    revisits = written(revisits.select("page_id", "url", "sha", "n_bytes", "keeper"), "warc-revisits")
    # Payloads are dealt by id and digest, which no copies share. A row of an id and digest is a revisit or a response, and so are all that repeat it.
    gone = revisits.select(F.col("page_id").alias("r_page"), F.col("sha").alias("r_sha")).distinct().hint("shuffle_hash")
    responses = base.join(gone, F.col("page_id").eqNullSafe(F.col("r_page")) & (F.col("sha") == F.col("r_sha")), "left_anti")
    rows = responses.withColumn("keeper", F.lit(None).cast("long")).unionByName(revisits.withColumn("html", F.lit(None).cast("binary")))
    folder = new_path(spark, "warc-raw")
    listed = written(in_batches(rows.withColumnRenamed("keeper", "refers_to"), _write_part(folder, level, roll_bytes), "file string, records long"), "warc-raw-list")
    discard(repeats, revisits)
    return folder, listed


def normalise(folder: str, files: DataFrame, level: int = 6, keep_source: bool = False) -> tuple[str, DataFrame]:
    """Normalise every listed archive; return the new folder and a frame of (file, index_file, records)."""
    target = new_path(files.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = Folder(folder), Folder(target)
        for batch in batches:
            rows = [normalise_file(a, x, b, level) for x in batch.column("file").to_pylist()]
            yield pa.RecordBatch.from_pydict({"file": [x[0] for x in rows], "index_file": [x[1] for x in rows], "records": [x[2] for x in rows]}, pa.schema([("file", pa.string()), ("index_file", pa.string()), ("records", pa.int64())]))

    n = max(1, files.count())
    out = written(in_batches(files.select("file").repartition(min(n, 10_000)), run, "file string, index_file string, records long"), "warc-list")
    if not keep_source:
        delete(folder)
    return target, out


def read_archives(folder: str, files: DataFrame, with_payload: bool = False) -> DataFrame:
    """A row a record, read member by member through the indexes."""
    schema = PAGE + (", url string, payload binary" if with_payload else "")
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    arrow = pa.schema([(x.split()[0], kinds[x.split()[1]]) for x in schema.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = Folder(folder)
        for batch in batches:
            for file, index in zip(batch.column("file").to_pylist(), batch.column("index_file").to_pylist(), strict=True):
                with source.read(index) as f:
                    lines = io.BytesIO(f.read()).readlines()
                rows, held = [], 0
                with source.read(file) as f:
                    for line in lines:
                        at, length = map(int, line.split(b"\t")[:2])
                        f.seek(at)
                        rows.append(parse_record(f.read(length)))
                        held += len(rows[-1]["payload"] or b"") if with_payload else 100
                        if held > 4 * CHUNK:
                            yield pa.RecordBatch.from_pydict({k: [r[k] for r in rows] for k in names}, arrow)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pydict({k: [r[k] for r in rows] for k in names}, arrow)

    return in_batches(files.select("file", "index_file").repartition(max(1, min(files.count(), 10_000))), run, schema)


def archive_pages(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Write, normalise and read back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    An empty table gives no row; columns other than page_id, url and html are ignored.
    """
    raw, listed = write_archives(pages, min_revisit_bytes)
    folder, files = normalise(raw, listed)
    discard(listed)
    return read_archives(folder, files)


_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_B32 = " || ".join(f"substr('{_ALPHABET}', CAST((('0x' || substr(sha, {5 * k + 1}, 5))::BIGINT // {32**j}) % 32 AS INTEGER) + 1, 1)" for k in range(8) for j in (3, 2, 1, 0))
SQL = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS sha FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY sha) AS keeper FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, {_B32} AS payload_digest,
       CASE WHEN keeper IS NULL OR page_id IS NOT DISTINCT FROM keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN keeper IS NULL OR page_id IS NOT DISTINCT FROM keeper THEN NULL ELSE keeper END AS refers_to
FROM k
"""
