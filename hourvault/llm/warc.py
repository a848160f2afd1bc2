"""WARC archives with a Zstandard dictionary in front and records compressed one by one."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourvault.llm.common import map_rows, stored, texts
from hourvault.llm.registry import query, table
from hourvault.session import shared_dir

#: Fixed values of the format: magic number of the skippable frame that holds the dictionary, and of zstandard frames.
DICTIONARY_FRAME = 0x184D2A5D
PLAIN_FRAME = 0xFD2FB528

DICTIONARY_BYTES = 32 << 10
#: Pieces of so many bytes train a file's dictionary, so many bytes in all, drawn evenly from all of its records.
SAMPLE_BYTES = 1 << 20
PIECE_BYTES = 4 << 10
#: A file is closed once it holds this much, so that one reader gets through it in good time.
FILE_BYTES = 64 << 20
LEVEL = 3
#: Smallest payload of which repeats become revisit records.
LEAST_REVISIT_BYTES = 0

FILES = "path string, records bigint, bytes bigint"
RECORDS = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string, file string, offset bigint"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, kind: str, refers_to: int | None, sha: str) -> bytes:
    """One WARC/1.1 record; a revisit carries no payload but keeps its digest and length."""
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{target}:{sha}')}>",
             "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{sha}",
             f"X-Page-Id: {'' if page_id is None else page_id}"]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"X-Refers-To-Page-Id: {'' if refers_to is None else refers_to}"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return b"WARC/1.1\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes

    @staticmethod
    def parse(data: bytes) -> Record:
        head, _, rest = data.partition(b"\r\n\r\n")
        version, *lines = head.decode("utf-8").split("\r\n")
        if version != "WARC/1.1":
            raise ValueError(f"not a WARC record: {version[:20]!r}")
        headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
        size = int(headers["Content-Length"])
        if len(rest) != size + 4:
            raise ValueError("record length and Content-Length differ")
        return Record(headers, rest[:size])

    @property
    def payload(self) -> bytes:
        return self.block.partition(b"\r\n\r\n")[2]

    @property
    def stated_bytes(self) -> int:
        """Content-Length of the archived response; a revisit has it though it has no payload."""
        http = self.block.partition(b"\r\n\r\n")[0].decode().split("\r\n")
        return int(next(x.split(": ")[1] for x in http if x.startswith("Content-Length: ")))


def train(records: list[bytes]) -> bytes:
    """A dictionary of pieces from all places of all records; too few or too uniform ones give their own bytes as the dictionary.

    The records stand in a row, and a piece begins at every so many bytes of it: long records give many, from their
    beginnings, middles and ends.
    """
    ends = np.cumsum([len(r) for r in records])
    size = int(ends[-1]) if len(records) else 0
    places = np.arange(0, size, max(PIECE_BYTES, -(-size * PIECE_BYTES // SAMPLE_BYTES)))
    which = np.searchsorted(ends, places, side="right")
    samples = [records[k][at:at + PIECE_BYTES] for k, at in zip(which.tolist(), (places - (ends - [len(r) for r in records])[which]).tolist(), strict=True)]
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(1024, sum(map(len, samples)) // 8)), samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def compressed(records: list[bytes], dictionary: bytes) -> list[bytes]:
    """Each record as one frame, with its content size and without the dictionary's number."""
    known = zstandard.ZstdCompressionDict(dictionary) if len(dictionary) >= 8 else None
    options = {"dict_data": known} if known else {}
    made = zstandard.ZstdCompressor(level=LEVEL, write_dict_id=False, write_checksum=True, **options)
    return [made.compress(r) for r in records]


def file_head(dictionary: bytes) -> bytes:
    """The leading skippable frame, with the dictionary itself compressed."""
    packed = zstandard.ZstdCompressor(level=LEVEL).compress(dictionary)
    return struct.pack("<II", DICTIONARY_FRAME, len(packed)) + packed


def frames(source) -> Iterator[tuple[int, bytes]]:
    """(offset, record) of an archive, read as a stream: one record is in memory at a time."""
    magic, size = struct.unpack("<II", source.read(8))
    if magic != DICTIONARY_FRAME:
        raise ValueError("no dictionary frame at the start")
    dictionary = zstandard.ZstdDecompressor().decompress(source.read(size))
    options = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if len(dictionary) >= 8 else {}
    offset, rest, ended = 8 + size, b"", False
    while True:
        unpack, parts, start = zstandard.ZstdDecompressor(**options).decompressobj(), [], offset
        while not unpack.eof:
            if not rest:
                rest = source.read(1 << 20)
                if not rest:
                    ended = True
                    break
            parts.append(unpack.decompress(rest))
            offset += len(rest) - len(unpack.unused_data)
            rest = unpack.unused_data
        if ended:
            if offset != start:
                raise ValueError("the last record is cut")
            return
        yield start, b"".join(parts)


def write_archives(rows: DataFrame, folder: str) -> DataFrame:
    """Write (page_id, url, html, payload_digest, record_type, refers_to) as archives; returns the files.

    Each task writes files of its own with new names and reports them when they are whole, and the list of files is
    stored: what a lost or repeated attempt leaves behind is in no list and is never read. The folder may lie on any
    file system that pyarrow opens.
    """
    def flush(target, root: str, records: list[bytes]) -> tuple[str, int, int]:
        dictionary = train(records)
        name = f"{root}/{uuid.uuid4().hex}.warc.zst"
        size = 0
        with target.open_output_stream(name) as out:
            for part in (file_head(dictionary), *compressed(records, dictionary)):
                out.write(part)
                size += len(part)
        return name, len(records), size

    def over(batches):
        target, root = fs.FileSystem.from_uri(folder)
        target.create_dir(root, recursive=True)
        done, waiting, size = [], [], 0
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in ("page_id", "url", "payload_digest", "record_type", "refers_to")]
            for (page_id, url, sha, kind, refers_to), payload in zip(zip(*columns, strict=True), texts(batch, "html"), strict=True):
                waiting.append(record(page_id, url, payload, kind, refers_to, sha))
                size += len(waiting[-1])
                if size >= FILE_BYTES:
                    done.append(flush(target, root, waiting))
                    waiting, size = [], 0
        if waiting:
            done.append(flush(target, root, waiting))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done, strict=True), (pa.string(), pa.int64(), pa.int64()), strict=True)],
                                             names=["path", "records", "bytes"])

    return stored(rows.mapInArrow(over, FILES), "warc-files")


def read_archives(files: DataFrame, folder: str) -> DataFrame:
    """Every record of the listed files; payload digests of responses are computed again and must agree."""
    def over(batches):
        source, _ = fs.FileSystem.from_uri(folder)
        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()),
                            ("refers_to", pa.int64()), ("url", pa.string()), ("file", pa.string()), ("offset", pa.int64())])
        number = lambda x: int(x) if x else None
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows = []
                with source.open_input_stream(path) as data:
                    for offset, raw in frames(data):
                        r = Record.parse(raw)
                        sha = r.headers["WARC-Payload-Digest"].removeprefix("sha1:")
                        kind = r.headers["WARC-Type"]
                        if kind == "response" and digest(r.payload) != sha:
                            raise ValueError(f"digest of the record at {offset} in {path} does not agree")
                        rows.append((number(r.headers["X-Page-Id"]), len(r.payload) if kind == "response" else r.stated_bytes, sha, kind,
                                     number(r.headers.get("X-Refers-To-Page-Id")), r.headers["WARC-Target-URI"], path, offset))
                        if len(rows) >= 5000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    # A number of tasks of its own: the list of files is short, and adaptive plans would read them all in one.
    tasks = min(files.count(), 16 * files.sparkSession.sparkContext.defaultParallelism)
    return files.repartition(max(1, tasks), "path").mapInArrow(over, RECORDS)


def archived(pages: DataFrame, folder: str, least_revisit_bytes: int = LEAST_REVISIT_BYTES, id_column: str = "page_id",
             url_column: str = "url", html_column: str = "html") -> DataFrame:
    """Write a record for each page and read the archives back: RECORDS, one row per row of `pages`.

    Of equal payloads of `least_revisit_bytes` or more, the row with the largest id is a response and the others are
    revisits that refer to it; smaller payloads are all responses. Null html is an empty payload, null url an empty
    target, a null id is the smallest. Rows that repeat an id and payload are responses alike if the id is the largest.
    Other columns are not read; an empty table writes no file.

    Only digests of payloads that occur more than once are joined, one row for each, so that a payload with a third
    of all rows is no group anywhere.
    """
    rows = pages.select(F.col(f"`{id_column}`").cast("bigint").alias("page_id"), F.col(f"`{url_column}`").alias("url"),
                        F.coalesce(F.col(f"`{html_column}`"), F.lit("")).alias("html"))
    rows = rows.withColumn("sha", F.sha1(F.col("html").cast("binary")))
    repeated = (rows.filter(F.octet_length("html") >= least_revisit_bytes).groupBy("sha")
                .agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("last")).filter("n > 1 AND last IS NOT NULL").select("sha", "last"))
    typed = rows.join(repeated, "sha", "left").withColumn("revisit", F.col("last").isNotNull() & ~F.col("last").eqNullSafe(F.col("page_id")))
    typed = typed.select(
        "page_id", "url", "html", F.col("sha").alias("payload_digest"),
        F.when(F.col("revisit"), "revisit").otherwise("response").alias("record_type"), F.when(F.col("revisit"), F.col("last")).alias("refers_to"))

    def named(batch: pa.RecordBatch) -> pa.RecordBatch:
        sha = [base64.b32encode(bytes.fromhex(x)).decode() for x in batch.column("payload_digest").to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array(sha, f.type) if f.name == "payload_digest" else batch.column(f.name) for f in batch.schema],
                                          schema=batch.schema)

    return read_archives(write_archives(map_rows(typed, named, typed.schema), folder), folder)


ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
ARCHIVED_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS sha FROM pages),
b AS (SELECT *, array_to_string(list_transform(string_split(sha, ''), lambda c: lpad(bin(strpos('0123456789abcdef', c) - 1), 4, '0')), '') AS bits FROM p),
g AS (SELECT *, max(page_id) OVER (PARTITION BY sha) AS last FROM b)
SELECT page_id, strlen(html) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: '{ALPHABET}'[1 + list_sum(list_transform(range(5), lambda j:
         CAST(bits[5 * i + j + 1] AS BIGINT) << (4 - j)))::BIGINT]), '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM g
"""


@query("op6_dictionary_warc", ARCHIVED_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "warc")
    folder = folder if ":/" in folder else f"file://{folder}"
    return archived(table(spark, sf_dir, "pages"), folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
