"""Damage in gzip files: every member's header, checksum and length, and what can be read in front of it."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Generator, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes that are unpacked at a time.
STEP = 1 << 18
#: A file beyond this cannot be read as one value; it is reported, not opened.
LARGEST = 1 << 30

# Marks of the gzip format.
MAGIC = b"\x1f\x8b\x08"
HAS_CHECKSUM, HAS_EXTRA, HAS_NAME, HAS_COMMENT = 2, 4, 8, 16

SOUND, EMPTY, FOREIGN, CUT, BROKEN, TRAILING, TOO_LARGE = "sound", "empty", "foreign", "cut", "broken", "trailing", "too large"
HEALTH = "file_path string, size_bytes bigint, health string, members int, readable_bytes bigint, readable_lines bigint, damaged_at bigint, problem string"
LINES = "file_path string, line_id bigint, value string"


def unpacked(content: bytes) -> Generator[bytes, None, tuple[str, int, int, str | None]]:
    """The bytes of the members one after the other, in bounded pieces; at the end: health, sound members, bytes up to damage, problem.

    `sound`: every member is whole, with the checksum and length that its trailer names. `cut`: the file ends within
    a member. `broken`: data, checksum or length of a member are wrong. `foreign`: the file does not begin as gzip.
    `trailing`: something else than members and zero bytes follows them.
    """
    at = members = 0
    if not content:
        return EMPTY, 0, 0, None
    while at < len(content):
        if content[at:at + 3] != MAGIC[:len(content) - at]:
            if not content[at:].strip(b"\0"):
                break
            return (TRAILING, members, at, "other bytes after the last member") if members else (FOREIGN, 0, 0, "no gzip header")
        start, at = at, header_end(content, at)
        member, checksum, length = zlib.decompressobj(-zlib.MAX_WBITS), 0, 0
        while not member.eof and at < len(content):
            data = content[at:at + STEP]
            before, given = member.copy(), 0
            try:
                rest = data
                while rest and not member.eof:
                    piece = member.decompress(rest, 4 * STEP)
                    rest = member.unconsumed_tail
                    checksum, length, given = zlib.crc32(piece, checksum), length + len(piece), given + len(piece)
                    if piece:
                        yield piece
            except zlib.error as problem:
                # What the step unpacks in front of the damage, byte by byte, without what it gave already.
                for k in range(len(data)):
                    try:
                        piece = before.decompress(data[k:k + 1])
                    except zlib.error:
                        break
                    given -= len(piece)
                    if given < 0:
                        yield piece[given:] if -given < len(piece) else piece
                        given = 0
                return BROKEN, members, start, str(problem).split(": ")[-1]
            at += len(data) - len(member.unused_data)
        if not member.eof or at + 8 > len(content):
            if not member.eof and (piece := member.flush()):
                yield piece
            return CUT, members, start, "the file ends within a member"
        if struct.unpack_from("<II", content, at) != (checksum, length & 0xFFFFFFFF):
            return BROKEN, members, start, "checksum or length differ from the trailer"
        at, members = at + 8, members + 1
    return SOUND, members, at, None


def header_end(content: bytes, at: int) -> int:
    """Where the data of the member at a place begin; beyond the content if it ends within the header."""
    if at + 10 > len(content):
        return len(content)
    flags, at = content[at + 3], at + 10
    if flags & HAS_EXTRA:
        at += 2 + (struct.unpack_from("<H", content, at)[0] if at + 2 <= len(content) else 0)
    for flag in (HAS_NAME, HAS_COMMENT):
        if flags & flag:
            end = content.find(b"\0", at)
            at = len(content) if end < 0 else end + 1
    return at + 2 if flags & HAS_CHECKSUM else at


def _checkable(contents: DataFrame) -> DataFrame:
    return contents.select("file_path", F.col("size_bytes").cast("bigint").alias("size_bytes"), "content")


def file_health(contents: DataFrame) -> DataFrame:
    """Health of each gzip file: one row a file (HEALTH), read member by member with a bounded piece unpacked at a time.

    `contents` is that of `storage.read_contents`. `damaged_at` is where the first member that is not whole begins;
    `readable_bytes` and `readable_lines` count what unpacks in front of the damage, a last line without line feed
    included where the file is sound. A file without a byte is `empty`; one that holds an empty text is `sound`. A null
    content is a file that could not be read as a value: `too large`.
    """
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [("file_path", pa.string()), ("size_bytes", pa.int64()), ("health", pa.string()), ("members", pa.int32()),
                  ("readable_bytes", pa.int64()), ("readable_lines", pa.int64()), ("damaged_at", pa.int64()), ("problem", pa.string())]
        for batch in batches:
            rows = []
            for path, size, content in zip(batch.column("file_path").to_pylist(), batch.column("size_bytes").to_pylist(), batch.column("content"), strict=True):
                content = content.as_py()
                if content is None:
                    rows.append((path, size, TOO_LARGE, None, None, None, None, "the file is no value"))
                    continue
                n, feeds, ended, pieces = 0, 0, True, unpacked(content)
                while True:
                    try:
                        piece = next(pieces)
                    except StopIteration as end:
                        health, members, at, problem = end.value
                        break
                    n, feeds, ended = n + len(piece), feeds + piece.count(b"\n"), piece.endswith(b"\n")
                lines = feeds + (health in (SOUND, TRAILING) and not ended)
                rows.append((path, size, health, members, n, lines, None if health in (SOUND, EMPTY) else at, problem))
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(zip(*rows, strict=True), fields, strict=True)],
                                             names=[n for n, _ in fields]) if rows else batch.slice(0, 0)

    return _checkable(contents).mapInArrow(over, HEALTH)


def whole_lines(content: bytes) -> Iterator[list[bytes]]:
    """Lists of lines: of a sound file all, of a damaged one those in front of the damage."""
    parts: list[bytes] = []
    pieces = unpacked(content)
    while True:
        try:
            piece = next(pieces)
        except StopIteration as end:
            if any(parts) and end.value[0] in (SOUND, TRAILING):
                yield [b"".join(parts)]
            return
        first, feed, rest = piece.partition(b"\n")
        parts.append(first)
        if feed:
            *lines, last = rest.split(b"\n")
            yield [b"".join(parts), *lines]
            parts = [last]


def salvaged_lines(contents: DataFrame) -> DataFrame:
    """Lines of sound files, and the whole lines in front of the damage of others: file_path, line_id (from 0), value.

    A line that the damage cuts is left out; bytes that are no UTF-8 are replaced.
    """
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("file_path").to_pylist(), batch.column("content"), strict=True):
                n = 0
                for lines in whole_lines(content.as_py() or b""):
                    values = [x.removesuffix(b"\r").decode("utf-8", "replace") for x in lines]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path] * len(lines), pa.string()), pa.array(range(n, n + len(lines)), pa.int64()), pa.array(values, pa.string())],
                        names=["file_path", "line_id", "value"])
                    n += len(lines)

    return _checkable(contents).mapInArrow(over, LINES)
