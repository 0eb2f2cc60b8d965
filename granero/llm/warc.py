"""WARC archives: written once per distinct payload, read back as a table of chunks."""

from __future__ import annotations

import hashlib
import io
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granero.llm.common import map_arrow, put_aside
from granero.session import scratch_path

CHUNK = 1 << 16  # bytes of payload held at once
SEGMENT = 4 << 20  # an archive is read in pieces of about this many bytes, cut between records
MIN_SHARED = 1000  # smaller payloads are never replaced by a revisit
# Fixed values of the format.
CRLF = b"\r\n"
VERSION = b"WARC/1.1"
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CHUNKS = T.StructType([
    T.StructField("record_id", T.StringType()), T.StructField("chunk_no", T.LongType()),
    T.StructField("chunk", T.BinaryType()), T.StructField("bytes_so_far", T.LongType()),
    T.StructField("digest_so_far", T.StringType()), T.StructField("is_last", T.BooleanType()),
    T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.StringType()),
    T.StructField("url", T.StringType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType())])


def record_roles(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html",
                 min_shared: int = MIN_SHARED) -> DataFrame:
    """Each page with its payload bytes, digest and role: the one holding a payload, or a revisit of it.

    Holders are found by a maximum per digest, combined before the shuffle; only digests with more than one page are
    kept, and that stored list is joined back, so a digest of a third of all pages is split by the skew join.
    """
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    base = pages.select(F.col(key).alias("_key"), F.col(url).cast("string").alias("_url"), body.alias("_payload")).select(
        "*", F.octet_length("_payload").cast("long").alias("_bytes"), F.lower(F.sha1("_payload")).alias("_digest"))
    holders = base.filter(F.col("_bytes") >= min_shared).groupBy("_digest").agg(
        F.max("_key").alias("_holder"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    holders = put_aside(holders, "warc-holders")
    return base.join(holders, "_digest", "left").select(
        F.col("_key").cast("string").alias("record_id"),
        F.when(F.col("_holder") != F.col("_key"), F.col("_holder").cast("string")).when(
            F.col("_key").isNull(), F.col("_holder").cast("string")).alias("refers_to"),
        F.col("_url").alias("url"), F.col("_bytes").alias("payload_bytes"), F.col("_digest").alias("payload_digest"),
        F.when((F.col("_holder") == F.col("_key")) | F.col("_holder").isNull(), F.col("_payload")).alias("payload"))


def _urn(key: str) -> bytes:
    return f"<urn:granero:{quote(key, safe='')}>".encode()


def _key(urn: str) -> str:
    return unquote(urn[len("<urn:granero:"):-1])


def _head(row: dict) -> tuple[bytes, int]:
    """WARC and HTTP headers of one record, and the bytes of its block."""
    http = CRLF.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8",
                      b"Content-Length: %d" % row["payload_bytes"]]) + 2 * CRLF
    revisit = row["refers_to"] is not None
    block = len(http) + (0 if revisit else row["payload_bytes"])
    lines = [VERSION, b"WARC-Type: " + (b"revisit" if revisit else b"response"), b"WARC-Date: 1970-01-01T00:00:00Z"]
    if row["record_id"] is not None:
        lines.append(b"WARC-Record-ID: " + _urn(row["record_id"]))
    if row["url"] is not None:
        lines.append(b"WARC-Target-URI: " + quote(row["url"], safe=":/?#[]@!$&'()*+,;=%~").encode())
    if revisit:
        lines += [b"WARC-Refers-To: " + _urn(row["refers_to"]), b"WARC-Profile: " + PROFILE]
    lines += [b"WARC-Payload-Digest: sha1:" + row["payload_digest"].encode(),
              b"Content-Type: application/http; msgtype=response", b"Content-Length: %d" % block]
    return CRLF.join(lines) + 2 * CRLF + http, block


def _writer(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc"
        segments, start, at, out = [], 0, 0, None
        for batch in batches:
            columns = [batch.column(c) for c in batch.schema.names]
            for i in range(batch.num_rows):
                out = out or fs.open_output_stream(f"{base}/{name}")
                row = {c: v[i].as_py() for c, v in zip(batch.schema.names, columns) if c != "payload"}
                head, _ = _head(row)
                out.write(head)
                at += len(head)
                if row["refers_to"] is None:
                    body = batch.column("payload")[i].as_buffer()  # a view; slices go out one by one
                    for lo in range(0, body.size, CHUNK):
                        out.write(body.slice(lo, min(CHUNK, body.size - lo)))
                    at += body.size
                out.write(2 * CRLF)
                at += 2 * len(CRLF)
                if at - start >= SEGMENT:
                    segments.append((start, at))
                    start = at
        if out is not None:
            out.close()
            if at > start:
                segments.append((start, at))
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(segments), pa.string()), pa.array([s for s, _ in segments], pa.int64()),
                 pa.array([e for _, e in segments], pa.int64())], ["file", "start", "end"])
    return write


def write_archives(roles: DataFrame) -> tuple[str, DataFrame]:
    """Archives of all records in a new shared folder, and the stored index of their segments.

    One file per task attempt under a name of its own; a file counts only if the index names it, so a task that ran
    twice or was lost leaves nothing that readers see.
    """
    folder = scratch_path(roles.sparkSession, "warc")
    index = map_arrow(roles, _writer(folder), "file string, start long, end long")
    return folder, put_aside(index, "warc-index")


class _Segment(io.RawIOBase):
    """Bytes `start`..`end` of an open file as a stream."""

    def __init__(self, file, start: int, end: int):
        self.file, self.left = file, end - start
        file.seek(start)

    def readable(self) -> bool:
        return True

    def readinto(self, into) -> int:
        data = self.file.read(min(len(into), self.left))
        into[:len(data)] = data
        self.left -= len(data)
        return len(data)


def _headers(stream: io.BufferedReader) -> dict[str, str]:
    found = {}
    while (line := stream.readline().rstrip(CRLF)):
        name, _, value = line.decode().partition(": ")
        found[name.lower()] = value
    return found


def _records(stream: io.BufferedReader, chunk: int) -> Iterator[tuple]:
    """Chunk rows of every record in a segment; one chunk is held at a time."""
    while (line := stream.readline()):
        if line == CRLF:
            continue
        if line.rstrip(CRLF) != VERSION:
            raise ValueError(f"no record starts at {line[:40]!r}")
        head = _headers(stream)
        stream.readline()  # HTTP status
        http = _headers(stream)
        revisit = head["warc-type"] == "revisit"
        length = int(http["content-length"])
        left, so_far, sha, n = 0 if revisit else length, 0, hashlib.sha1(), 0
        declared = head["warc-payload-digest"].removeprefix("sha1:")
        urn, refers, url = head.get("warc-record-id"), head.get("warc-refers-to"), head.get("warc-target-uri")
        while True:
            data = stream.read(min(chunk, left))
            if left and not data:
                raise ValueError("the archive ends inside a record")
            sha.update(data)
            left -= len(data)
            so_far += len(data)
            digest = declared if revisit else sha.hexdigest()
            if not left and digest != declared:
                raise ValueError(f"payload digest of {urn} does not hold")
            yield (_key(urn) if urn else None, n, data, so_far, digest, not left, head["warc-type"],
                   _key(refers) if refers else None, url, length, declared)
            n += 1
            if not left:
                break


def _reader(folder: str, chunk: int):
    schema = pa.schema([("record_id", pa.string()), ("chunk_no", pa.int64()), ("chunk", pa.binary()),
                        ("bytes_so_far", pa.int64()), ("digest_so_far", pa.string()), ("is_last", pa.bool_()),
                        ("record_type", pa.string()), ("refers_to", pa.string()), ("url", pa.string()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for segment in batch.to_pylist():
                with fs.open_input_file(f"{base}/{segment['file']}") as file:
                    stream = io.BufferedReader(_Segment(file, segment["start"], segment["end"]), CHUNK)
                    rows, size = [], 0
                    for row in _records(stream, chunk):
                        rows.append(row)
                        size += len(row[2]) + 200
                        if size >= SEGMENT:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)
                            rows, size = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)
    return read


def read_archives(folder: str, index: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Chunk table of the archives: one row per record and chunk of at most `chunk` bytes.

    `digest_so_far` and `bytes_so_far` cover the payload up to and with the chunk; the last row of a record is checked
    against the digest in its header. A revisit, like an empty payload, has one empty chunk; a revisit's digest and
    length are those its header gives for the full payload.
    """
    spread = index.repartition(max(1, index.count()))  # one segment per task
    return map_arrow(spread, _reader(folder, chunk), CHUNKS)


def archive_pages(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html",
                  min_shared: int = MIN_SHARED, chunk: int = CHUNK) -> DataFrame:
    """One WARC record per page, written and read back as chunk rows (`record_id` is the key as text).

    General: the programme's own tables hold no web pages; its site export has the same shape (key, url, html).
    Of pages with equal payloads of at least `min_shared` bytes, that with the largest key is the response and the
    others revisit it. A null payload is empty, a null url leaves its header out, a null key leaves the record id out
    (such a page revisits the largest key of its payload, or is a response if there is none). Repeated rows of the
    largest key are all responses. Other columns are ignored; an empty table gives no rows.
    """
    folder, index = write_archives(record_roles(pages, key, url, payload, min_shared))
    return read_archives(folder, index, chunk)
