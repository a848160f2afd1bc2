"""Best-fit-decreasing packing of tokenised documents into sequences of a fixed length."""

from __future__ import annotations

import os
import zlib
from collections import defaultdict
from itertools import chain, islice, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourvault.llm.common import map_rows, positions, stored, texts
from hourvault.llm.registry import query, table

LENGTH = 4096
END = 1
#: A special token of the vocabulary; it splits a text before anything else is done to it.
SPECIAL = b"<|endoftext|>"
#: Words whose ids a worker remembers; bounds its memory.
REMEMBERED = 400_000
#: Bytes of those words, which may be long.
REMEMBERED_BYTES = 32 << 20
#: Punctuation at the end of words.
MARKS = b".,;:!?*&$#%|"

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids array<int>"
PLACES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of whole texts, put together from remembered ids of the strings between ASCII white space.

    The tokenizer's pre-tokens never reach over white space and its normaliser works on each side of it alone, so
    the ids of a text are those of its strings in a row.
    """

    def __init__(self, path: str, share: int = 1):
        """`share`: how many times REMEMBERED words are kept."""
        self.share = share
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.mark = self.tokenizer.token_to_id(SPECIAL.decode())
        self.number: dict[bytes, int] = {}
        self.flat = np.zeros(1 << 16, np.uint32)
        self.begin = np.zeros(1 << 14, np.int64)
        self.size = np.zeros(1 << 14, np.int64)
        self.used = self.bytes = 0

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in a row, and how many each has. Blocks of words go in one call, with a special token between."""
        mark = self.mark
        parts, sizes = [], []
        for k in range(0, len(words), 2000):
            block = words[k:k + 2000]
            if any(SPECIAL in w for w in block):
                found = [self.tokenizer.encode(w.decode("utf-8", "replace"), add_special_tokens=False).ids for w in block]
                parts += [np.array(x, np.uint32) for x in found]
                sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
                continue
            text = SPECIAL.join(block).decode("utf-8", "replace")
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
            marks = np.flatnonzero(ids == mark)
            parts.append(ids[ids != mark])
            sizes.append(np.diff(np.concatenate([[-1], marks, [len(ids)]])) - 1)
        return np.concatenate(parts or [np.zeros(0, np.uint32)]), np.concatenate(sizes or [np.zeros(0, np.int64)])

    def add(self, words: list[bytes], flat: np.ndarray, sizes: np.ndarray) -> None:
        n = len(self.number)
        while len(self.flat) < self.used + len(flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while len(self.begin) < n + len(words):
            self.begin, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.size))
        self.flat[self.used:self.used + len(flat)] = flat
        self.begin[n:n + len(words)] = self.used + np.cumsum(sizes) - sizes
        self.size[n:n + len(words)] = sizes
        self.used += len(flat)
        self.bytes += sum(map(len, words))
        self.number.update(zip(words, range(n, n + len(words)), strict=True))

    def learn(self, words: list[bytes]) -> None:
        """Marks at the end of a word are pre-tokens of their own: stem and marks are looked up apart."""
        whole, parted, parts = [], [], []
        for w in words:
            stem = w.rstrip(MARKS)
            if stem and len(stem) < len(w) and (stem[-1:].isalnum() or stem[-1] >= 128 and stem.decode("utf-8", "replace")[-1].isalpha()):
                parted.append(w)
                parts += (stem, w[len(stem):])
            else:
                whole.append(w)
        whole += {w for w in parts if w not in self.number}.difference(whole)
        self.add(whole, *self.encode(whole))
        if parted:
            which = np.fromiter(map(self.number.__getitem__, parts), np.int64, len(parts))
            self.add(parted, self.gather(which), self.size[which].reshape(-1, 2).sum(axis=1))

    def shrink(self) -> None:
        """Keep the words that came first: frequent ones come early."""
        kept = dict(islice(self.number.items(), self.share * REMEMBERED // 2))
        if sum(map(len, kept)) > REMEMBERED_BYTES // 2:
            kept = {}
        self.number, self.used = kept, int(self.begin[len(kept) - 1] + self.size[len(kept) - 1]) if kept else 0
        self.bytes = sum(map(len, kept))

    def ids(self, all_words: list[list[bytes]]) -> list[np.ndarray]:
        """Ids of several texts, given as their strings."""
        if len(self.number) > self.share * REMEMBERED or self.bytes > REMEMBERED_BYTES:
            self.shrink()
        flat = list(chain.from_iterable(all_words))
        which = np.fromiter(map(self.number.get, flat, repeat(-1)), np.int64, len(flat))
        missing = np.flatnonzero(which < 0).tolist()
        if missing:
            new = [flat[k] for k in missing]
            self.learn(list(dict.fromkeys(new)))
            which[missing] = np.fromiter(map(self.number.__getitem__, new), np.int64, len(new))
        ends = np.concatenate([[0], np.cumsum(self.size[which])])[np.cumsum([len(w) for w in all_words])]
        return np.split(self.gather(which), ends[:-1])

    def gather(self, which: np.ndarray) -> np.ndarray:
        size = self.size[which]
        shift = np.repeat(self.begin[which] - np.cumsum(size) + size, size)
        return self.flat[shift + np.arange(len(shift))]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each worker process and file. Tasks find this function by its name, so they share what it keeps."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path, 2)
    return _ENCODERS[path]


def token_pieces(docs: DataFrame, path: str | None = None, length: int = LENGTH, end: int = END, with_ids: bool = True,
                 lasting: bool = False, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The ids of each document with the end id, cut into pieces of `length`; no shuffle.

    With `lasting`, worker processes remember words from task to task, which saves half of the time; without, their
    memory is free for what the next stage does.
    """
    path = path or tokenizer_path()
    own: dict[str, Encoder] = {}  # each task unpacks a dict of its own, so that words are forgotten with the task

    def run(batch: pa.RecordBatch) -> dict:
        if not lasting and path not in own:
            own[path] = Encoder(path)
        made = encoder(path) if lasting else own[path]
        out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
        ids = batch.column("doc_id").to_pylist()
        words, begin, waiting = [], 0, 0
        for k, text in enumerate(texts(batch, "text")):
            # ASCII capitals fold in any case; a special token's name is left as it is.
            words.append((text if b"<|" in text else text.lower()).split())
            waiting += len(words[-1])
            if waiting < 200_000 and k + 1 < len(ids):
                continue
            for doc_id, found in zip(ids[begin:k + 1], made.ids(words), strict=True):
                whole = np.append(found, np.uint32(end)).astype("<u4")
                for n, start in enumerate(range(0, len(whole), length)):
                    piece = whole[start:start + length]
                    out["doc_id"].append(doc_id)
                    out["piece"].append(n)
                    out["start"].append(start)
                    out["length"].append(len(piece))
                    out["ids_crc32"].append(zlib.crc32(piece.tobytes()))
                    out["ids"].append(piece.astype(np.int32) if with_ids else None)
            words, begin, waiting = [], k + 1, 0
        return out

    return map_rows(docs.selectExpr(f"`{id_column}` AS doc_id", f"`{text_column}` AS text"), run, PIECES)


class OpenBins:
    """A segment tree over remaining capacities: finds the tightest open bin in logarithmic time.

    Bins of equal capacity are interchangeable and kept as ranges of numbers; a leaf counts its ranges.
    """

    def __init__(self, length: int):
        self.leaves = 1 << (length + 1).bit_length()
        self.count = [0] * (2 * self.leaves)
        self.ranges: dict[int, list[tuple[int, int]]] = defaultdict(list)

    def add(self, capacity: int, first: int, n: int) -> None:
        if capacity and n:
            self.ranges[capacity].append((first, n))
            self._count(capacity, 1)

    def take(self, capacity: int) -> tuple[int, int]:
        self._count(capacity, -1)
        return self.ranges[capacity].pop()

    def _count(self, capacity: int, by: int) -> None:
        node = capacity + self.leaves
        while node:
            self.count[node] += by
            node //= 2

    def tightest(self, least: int) -> int | None:
        """The smallest capacity of an open bin that is `least` or more."""
        node = least + self.leaves
        if self.count[node]:
            return least
        while node > 1:
            if node % 2 == 0 and self.count[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.count[2 * node] else 2 * node + 1
                return node - self.leaves
            node //= 2
        return None


def best_fit(counts: dict[int, int], length: int = LENGTH) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over piece lengths with their counts.

    Returns (length, rank from, rank to, first bin, pieces a bin, offset): of the pieces of that length, those with a
    rank in the range fill bins from the first on, so many in each, from the offset on. This is what taking pieces one
    by one gives, since best fit fills a bin with all the equal pieces that it holds before it turns to the next.
    """
    bins, new, out = OpenBins(length), 0, []
    for size in sorted(counts, reverse=True):
        rank, left = 0, counts[size]
        while left:
            capacity = bins.tightest(size)
            if capacity is None:
                capacity, first, n = length, new, -(-left // (length // size))
                new += n
            else:
                first, n = bins.take(capacity)
            each = capacity // size
            placed = min(left, each * n)
            full, rest = divmod(placed, each)
            out.append((size, rank, rank + placed, first, each, length - capacity))
            bins.add(capacity - each * size, first, full)
            if rest:
                bins.add(capacity - rest * size, first + full, 1)
            bins.add(capacity, first + full + (rest > 0), n - full - (rest > 0))
            rank, left = rank + placed, left - placed
    return out


def packed(pieces: DataFrame, length: int = LENGTH) -> DataFrame:
    """Adds sequence_id and offset to pieces with a `length` column: best-fit decreasing over all of them.

    The driver sees the count of each length only, at most `length` numbers at any input size, and plans ranges of
    ranks. Ranks within a length come from one count per task and length; a length that most pieces share is not
    gathered anywhere.
    """
    rows = stored(pieces.withColumn("_mid", F.monotonically_increasing_id()), "packing-pieces")
    tasks = positions(rows, ["length"])
    counts = {r.length: r.n for r in tasks.groupBy("length").agg(F.max("_total").alias("n")).collect()}
    plan = np.array(best_fit(counts, length), np.int64).reshape(-1, 6)
    # Ranks within a length and task follow the row numbers: count the rows of the same length before, in the task.
    sent = rows.sparkSession.sparkContext.broadcast(plan)
    before = tasks.select(F.col("length").alias("_length"), F.col("_task").alias("_t"), "_before")
    names = [c for c in rows.columns if c != "_mid"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "_mid")

    def run(batch: pa.RecordBatch) -> dict:
        order = sent.value
        size = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
        rank = batch.column("_rank").to_numpy(zero_copy_only=False).astype(np.int64)
        # The plan's rows stand by falling length and rising rank.
        key = (length - order[:, 0]) * (1 << 48) + order[:, 1]
        at = np.searchsorted(key, (length - size) * (1 << 48) + rank, side="right") - 1
        _, low, _, first, each, offset = order[at].T
        k = rank - low
        out = {n: batch.column(n) for n in names}
        return out | {"sequence_id": first + k // each, "offset": offset + k % each * size}

    ranked = _ranks(rows).join(before, (F.col("length") == F.col("_length")) & (F.shiftright("_mid", 33) == F.col("_t")))
    ranked = ranked.withColumn("_rank", F.col("_before") + F.col("_within"))
    return map_rows(ranked, run, fields + ", sequence_id bigint, offset bigint")


def _ranks(rows: DataFrame) -> DataFrame:
    """Adds `_within`: rows of the same length and task that come before."""
    from pyspark.sql import Window

    return rows.withColumn("_within", F.row_number().over(
        Window.partitionBy(F.shiftright("_mid", 33), "length").orderBy("_mid")) - 1)


def packed_documents(docs: DataFrame, path: str | None = None, length: int = LENGTH, end: int = END, **options) -> DataFrame:
    """Every piece of every document with its sequence and offset there.

    Only documents longer than `length` ids are cut. A null or empty text is the end id alone, one piece of length 1;
    a null id stays null; repeated rows are packed each; an empty table gives no rows. Offsets in a sequence have no
    gaps, and sequences are numbered without gaps from 0.
    """
    return packed(token_pieces(docs, path, length, end, with_ids=False, **options).drop("ids"), length)


@query("op5_best_fit_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"), lasting=True)
