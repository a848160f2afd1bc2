"""Secrets in text: fixed patterns, and strings that a primed compressor finds new in a sensitive context."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourvault.llm.common import map_rows, texts
from hourvault.llm.registry import query, table

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "novel")

#: Words whose neighbourhood is sensitive, in lower case.
SENSITIVE = ("password", "passwd", "secret", "token", "api_key", "apikey", "credential", "private_key", "access_key", "auth_key", "bearer")
SENSITIVE_PATTERN = re.compile("|".join(SENSITIVE))
#: Characters after a sensitive word in which candidates are looked for past the end of its line; twice as many before a
#: candidate are its surroundings.
REACH = 96
LEAST = 16
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")
#: Head and foot of a key block, and the last, shorter piece of a string in lines (broken by a line break or its escape).
ARMOUR = re.compile(r"-----(BEGIN|END) [A-Z0-9 ]+-----")
TAIL = re.compile(rf"""["',+]*(?:\\r|\\n|\r|\n)+[ \t"']*([A-Za-z0-9+/_-]{{1,{LEAST - 1}}}={{0,2}})(?![A-Za-z0-9+/_=-])""")
#: A candidate is new if it adds this many compressed bytes per 100 characters, and mixes letters with digits.
NOVEL_BYTES_PERCENT = 60
DICTIONARY_WORDS = 4096

RESULT = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_novel bigint"
MASK = "[SECRET]"


class Novelty:
    """Marginal compressed size of a string behind its surroundings, with a dictionary of the corpus's identifiers."""

    def __init__(self, identifiers: list[str]):
        # Zstandard weighs the end of a dictionary most: the most frequent identifiers come last.
        content = " ".join(reversed(identifiers)).encode()
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(content) >= 8 else None
        options = {"dict_data": known} if known else {}
        self.compressor = zstandard.ZstdCompressor(level=3, write_content_size=False, write_checksum=False, **options)

    def size(self, text: bytes) -> int:
        return len(self.compressor.compress(text))

    def added(self, before: str, candidate: str) -> int:
        """Compressed bytes that the candidate adds to its surroundings; copies of itself in them don't make it known."""
        known = before.replace(candidate, "").encode("utf-8", "replace")
        return self.size(known + candidate.encode("utf-8", "replace")) - self.size(known)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns; a match that is too short is dropped, not searched again."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8] if _may_assign(text) else []
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    return found + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]


def _may_assign(text: str) -> bool:
    low = text.lower()
    return any(w in low for w in ("passw", "secret", "token", "api"))


def _bounds(text: str, at: int) -> tuple[int, int]:
    """Start and end of the line at a place, without its line break."""
    end = text.find("\n", at)
    return text.rfind("\n", 0, at) + 1, len(text) if end < 0 else end


def _holds_only_candidates(line: str) -> bool:
    """A line of candidates and marks around them, or the head or foot of a key block."""
    line = line.replace("\\n", " ").replace("\\r", " ")
    if ARMOUR.search(line):
        return True
    rest, n = CANDIDATE.subn("", line)
    return n > 0 and not any(x.isalnum() for x in rest)


def sensitive_regions(text: str, low: str) -> list[tuple[int, int]]:
    """Disjoint regions, in order, in which candidates are looked for: the lines of sensitive words, the lines of
    candidates directly before and after, and REACH characters after each word in any case."""
    regions: list[tuple[int, int]] = []
    done = 0  # end of the last region without its REACH: words before it need no lines of their own
    for m in SENSITIVE_PATTERN.finditer(low):
        if regions and m.end() <= done:
            regions[-1] = regions[-1][0], max(regions[-1][1], min(len(text), m.end() + REACH))
            continue
        start, end = _bounds(text, m.start())
        least = done
        while start > least:
            before, _ = _bounds(text, start - 1)
            if not _holds_only_candidates(text[before:start - 1]):
                break
            start = before
        while end < len(text):
            _, after = _bounds(text, end + 1)
            if not _holds_only_candidates(text[end + 1:after]):
                break
            end = after
        done = end
        reach = max(end, min(len(text), m.end() + REACH))
        if regions and start <= regions[-1][1]:
            regions[-1] = regions[-1][0], max(regions[-1][1], reach)
        else:
            regions.append((start, reach))
    return regions


def novel_spans(text: str, novelty: Novelty, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Strings near a sensitive word that hardly compress against what stands before them and the identifiers.

    The short end of a wrapped string goes with it.
    """
    low = text.translate(_CAPITALS) if not text.isascii() else text.lower()
    taken = sorted((s, e) for s, _, e in taken)
    starts, ends = [s for s, _ in taken], list(accumulate((e for _, e in taken), max))
    found = []
    for low_end, high_end in sensitive_regions(text, low):
        for c in CANDIDATE.finditer(text, low_end):
            start, end = c.span()
            if start >= high_end:
                break
            k = bisect_left(starts, end)
            if k and ends[k - 1] > start:
                continue
            word = text[start:end]
            if not (any(x.isdigit() for x in word) and any(x.isalpha() for x in word)):
                continue
            if 100 * novelty.added(text[max(0, start - 2 * REACH):start], word) >= NOVEL_BYTES_PERCENT * len(word):
                found.append((start, 3, end))
                tail = TAIL.match(text, end)
                if tail and len(tail[1]) % 4 == 0 and (tail[1].endswith("=") or (any(x.isdigit() for x in tail[1]) and any(x.isalpha() for x in tail[1]))):
                    found.append((tail.start(1), 3, tail.end(1)))
    return found


_CAPITALS = {c: c + 32 for c in range(65, 91)}


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def identifiers(docs: DataFrame, text_column: str = "text", words: int = DICTIONARY_WORDS) -> list[str]:
    """The most frequent identifiers in lines with a sensitive word, over all documents, the most frequent first.

    What stands in a string that could be a secret itself (a candidate with letters and digits) is no identifier, however
    often it is copied. At most `words` of 64 characters reach the driver; counting is a grouped aggregation.
    """
    pattern = "(?i)" + "|".join(SENSITIVE)
    found = (docs.filter(F.col(text_column).rlike(pattern))
             .select(F.explode(F.split(text_column, "\n")).alias("line")).filter(F.col("line").rlike(pattern))
             .select(F.explode(F.regexp_extract_all("line", F.lit(r"[A-Za-z0-9+/_=-]{3,}"), 0)).alias("run"))
             .filter((F.length("run") < LEAST) | ~F.col("run").rlike("[0-9]") | ~F.col("run").rlike("[A-Za-z]"))
             .select(F.explode(F.regexp_extract_all("run", F.lit(r"[A-Za-z_]\w{2,63}"), 0)).alias("word"))
             .groupBy("word").count().filter("count > 1"))
    return [r.word for r in found.orderBy(F.desc("count"), "word").limit(words).collect()]


def _scanner(docs: DataFrame, text_column: str):
    """A function for tasks: base and novel spans of a text."""
    sent = docs.sparkSession.sparkContext.broadcast(identifiers(docs, text_column))
    made: list[Novelty] = []

    def scan(text: str) -> list[tuple[int, int, int]]:
        spans = base_spans(text)
        if _may_be_sensitive(text):
            if not made:
                made.append(Novelty(sent.value))
            spans += novel_spans(text, made[0], spans)
        return spans

    return scan


def _may_be_sensitive(text: str) -> bool:
    low = text.lower()
    return any(w in low for w in SENSITIVE)


def secret_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Spans of secrets in each document, in code points, with the count of each fixed pattern; one row per row.

    Null and empty texts have no spans; repeated rows are scanned each; null ids stay null; other columns are not
    read. Spans of different kinds may overlap; new strings are only reported outside the fixed patterns.
    """
    rows = docs.selectExpr(f"`{id_column}` AS doc_id", f"`{text_column}` AS text")
    scan = _scanner(rows, "text")

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {k: [] for k in ("n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans")}
        for text in texts(batch, "text"):
            spans = scan(text.decode("utf-8", "replace"))
            for k, name in enumerate(("n_assign", "n_access", "n_hex", "n_novel")):
                out[name].append(sum(1 for s in spans if s[1] == k))
            out["base_sha256"].append(hashlib.sha256(joined([s for s in spans if s[1] < 3]).encode()).hexdigest())
            out["spans"].append(joined(spans))
        return out | {"doc_id": batch.column("doc_id")}

    return map_rows(rows, run, RESULT)


def masked(text: str, spans: list[tuple[int, int, int]], mask: str = MASK) -> str:
    """The text with every run of overlapping spans replaced."""
    out, at = [], 0
    for start, _, end in sorted(spans):
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join(out) + text[at:]


def without_secrets(docs: DataFrame, text_column: str = "text", length_column: str | None = "n_chars", mask: str = MASK) -> DataFrame:
    """The rows of `docs` with secrets masked; `length_column` follows the text if present."""
    scan = _scanner(docs, text_column)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        old = batch.column(text_column)
        new, changed = [], False
        for value in old.to_pylist():
            spans = scan(value) if value else []
            changed |= bool(spans)
            new.append(masked(value, spans, mask) if spans else value)
        if not changed:
            return batch
        columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        columns[text_column] = pa.array(new, old.type)
        if length_column in columns:
            was = columns[length_column]
            columns[length_column] = pa.array(
                [n if a is b or a == b else len(b) for n, a, b in zip(was.to_pylist(), old.to_pylist(), new, strict=True)], was.type)
        return pa.RecordBatch.from_arrays(list(columns.values()), schema=batch.schema)

    return map_rows(docs, run, docs.schema)


@query("op8_secret_spans")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(table(spark, sf_dir, "documents"))
