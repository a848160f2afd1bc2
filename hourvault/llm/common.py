"""Helpers that several operators share: stored tables, row numbers, words and hashes of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourvault.session import shared_dir


def stored(df: DataFrame, label: str, *partition_by: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, and fixes row order and row numbers."""
    path = shared_dir(df.sparkSession, label)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def texts(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 bytes of a text column; null counts as empty."""
    return [x or b"" for x in batch.column(column).cast(pa.large_binary()).to_pylist()]


def slices(sizes: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Cuts rows into runs of about `limit` in sum of sizes, so that work arrays don't follow the batch."""
    if not len(sizes):
        return []
    part = (np.cumsum(sizes) - 1) // limit
    first = np.flatnonzero(np.diff(part, prepend=-1))
    return list(zip(first.tolist(), [*first[1:].tolist(), len(sizes)], strict=True))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (two xor-shift-multiply rounds)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, kept for at most `limit` words at a time."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def positions(df: DataFrame, group: list[str], mid: str = "_mid") -> DataFrame:
    """Per group and task: `_first` row number, rows of the group in earlier tasks (`_before`) and in all (`_total`).

    `mid` holds numbers of monotonically_increasing_id(), frozen by `stored`. The windows run over one row per
    task and group, not over the rows.
    """
    counts = df.groupBy(*group, F.shiftright(mid, 33).alias("_task")).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(mid).alias("_first"))
    whole = Window.partitionBy(*(group or [F.lit(0)]))
    earlier = whole.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(*group, "_task", "_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0).cast("bigint")).alias("_before"),
                         F.sum("_rows").over(whole).alias("_total"))


def map_rows(df: DataFrame, run, schema: str | T.StructType) -> DataFrame:
    """mapInArrow for functions from a RecordBatch to a dict of columns, a RecordBatch, or None."""
    schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    fields = arrow_schema(schema)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            out = run(batch)
            if isinstance(out, dict):
                out = pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) if not isinstance(out[f.name], pa.Array)
                                                  else out[f.name].cast(f.type) for f in fields], schema=fields)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(over, schema)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def fold(id_column: str | Column, modulus: int) -> Column:
    """crc32 of an id as text, modulo; null ids count as the empty text."""
    column = F.col(id_column) if isinstance(id_column, str) else id_column
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus
