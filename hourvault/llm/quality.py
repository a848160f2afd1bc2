"""Line-first cleaning of documents."""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from hourvault.llm.common import map_rows, texts
from hourvault.llm.registry import query, table

SPACES = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
NOT_COUNTED = SPACES + bytes(range(0x80, 0xC0))

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
#: A line fails if more of its words than this hold a symbol, or end in "!!".
MAX_MARKED_PERCENT = 30
#: Up to so many words, a line without a sentence end is a heading, menu or button.
MAX_MENU_WORDS = 8
#: A document goes if less of its word characters than this is left.
MIN_KEPT_PERCENT = 50
# Marks that end a sentence in scripts other than Latin, and scripts that are written without spaces.
SENTENCE_ENDS = "。！？｡؟۔।॥։።…"
UNSPACED = r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]"
#: In such scripts so many characters count as a word.
UNSPACED_WORD = 2
#: Phrases of page furniture, in lower case.
BOILERPLATE = [b"all rights reserved", b"cookie policy", b"privacy policy", b"terms of use", b"terms of service",
               b"enable javascript", b"lorem ipsum", b"click here", b"skip to content", b"sign in to", b"subscribe to our"]
_ENDS, _UNSPACED = regex.compile(f"[{SENTENCE_ENDS}]"), regex.compile(UNSPACED)
BASE = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean"
RESULT = f"doc_id bigint, {BASE}, kept boolean, n_lines bigint, n_bad_lines bigint, kept_chars bigint"


def word_chars(text: bytes) -> int:
    """Code points in words: all bytes but white space and UTF-8 continuations."""
    return len(text.translate(None, NOT_COUNTED))


def repeated_words(words: list[bytes]) -> int:
    """Words covered by windows of three words that stand in the text twice or more."""
    n = len(words)
    if n < 4:
        return 0
    ids: defaultdict[bytes, int] = defaultdict(count().__next__)
    codes = np.fromiter(map(ids.__getitem__, words), np.int64, n)
    if len(ids) == n:
        return 0
    pairs = np.unique(codes[:-1] * len(ids) + codes[1:], return_inverse=True)[1]
    _, window, times = np.unique(pairs[:-1].astype(np.int64) * len(ids) + codes[2:], return_inverse=True, return_counts=True)
    again = times[window] > 1
    hit = np.zeros(n, bool)
    for shift in range(3):
        hit[shift:n - 2 + shift] |= again
    return int(hit.sum())


def bad_line(line: bytes) -> bool:
    """Punctuation, navigation and boilerplate rules, on a line with a word."""
    words = line.split()
    n = len(words)
    if len(line) != len(line.translate(None, SYMBOLS)):
        marked = sum(1 for w in words if len(w) != len(w.translate(None, SYMBOLS)))
        if 100 * marked > MAX_MARKED_PERCENT * n:
            return True
    if b"!!" in line and 100 * sum(1 for w in words if w.endswith(b"!!")) > MAX_MARKED_PERCENT * n:
        return True
    if n <= MAX_MENU_WORDS and not (b"." in line or b"!" in line or b"?" in line or words[-1].endswith((b":", b";", b","))):
        text = "" if line.isascii() else line.decode("utf-8", "replace")
        if not _ENDS.search(text) and len(_UNSPACED.findall(text)) <= UNSPACED_WORD * MAX_MENU_WORDS:
            return True
    low = line.lower()
    return any(phrase in low for phrase in BOILERPLATE)


def cleaned(text: bytes) -> tuple[dict, bytes]:
    """Counts and verdict of a text, and the text without failed and repeated lines."""
    words, lines = text.split(), text.split(b"\n")
    seen: set[bytes] = set()
    left, n_lines, n_dup, n_bad, kept_chars = [], 0, 0, 0, 0
    for line in lines:
        if not line.strip():
            left.append(line)
            continue
        n_lines += 1
        repeated = line in seen
        seen.add(line)
        n_dup += repeated
        if repeated or bad_line(line):
            n_bad += 1
        else:
            left.append(line)
            kept_chars += word_chars(line)
    chars, again = word_chars(text), repeated_words(words)
    failed = len(words) < MIN_WORDS or 100 * again > MAX_REPEATED_PERCENT * len(words)
    return {"n_words": len(words), "word_chars": chars, "n_symbols": len(text) - len(text.translate(None, SYMBOLS)),
            "n_dup_lines": n_dup, "n_repeat_words": again, "base_failed": failed,
            "kept": not failed and 100 * kept_chars >= MIN_KEPT_PERCENT * chars,
            "n_lines": n_lines, "n_bad_lines": n_bad, "kept_chars": kept_chars}, b"\n".join(left)


def line_quality(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Line rules and the verdict for each document; one row per row, no shuffle.

    Null and empty texts have no words: base_failed, not kept. Repeated rows are judged alike; null ids stay null;
    other columns are not read.
    """
    def run(batch: pa.RecordBatch) -> dict:
        rows = [cleaned(t)[0] for t in texts(batch, "text")]
        return {"doc_id": batch.column("doc_id")} | {k: [r[k] for r in rows] for k in rows[0]}

    return map_rows(docs.selectExpr(f"`{id_column}` AS doc_id", f"`{text_column}` AS text"), run, RESULT)


def clean_documents(docs: DataFrame, text_column: str = "text", length_column: str | None = "n_chars") -> DataFrame:
    """Kept documents without their failed lines, in the columns of `docs`; `length_column` follows the text if present.

    A document all of whose lines pass comes through unchanged. Null and empty texts have no words and go; repeated rows
    are judged alike, null ids stay null, an empty table gives no rows.
    """
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [cleaned(t) for t in texts(batch, text_column)]
        keep = pa.array([f["kept"] for f, _ in found])
        new = [t.decode("utf-8", "replace") for f, t in found if f["kept"]]
        out = batch.filter(keep)
        return replaced_text(out, new, text_column, length_column)

    return map_rows(docs, run, docs.schema)


def replaced_text(batch: pa.RecordBatch, new: list[str], text_column: str, length_column: str | None) -> pa.RecordBatch:
    """The batch with new texts and their lengths in characters."""
    columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
    columns[text_column] = pa.array(new, batch.schema.field(text_column).type)
    if length_column in columns:
        columns[length_column] = pa.array([len(t) for t in new], batch.schema.field(length_column).type)
    return pa.RecordBatch.from_arrays(list(columns.values()), schema=batch.schema)


_PHRASES = "|".join(p.decode() for p in BOILERPLATE)
_LATIN = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"
QUALITY_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '{WORD}') AS ws FROM d),
pos AS (SELECT r, unnest(ws) AS w0, generate_subscripts(ws, 1) AS i FROM w),
tri AS (SELECT r, i, w0, lead(w0) OVER o AS w1, lead(w0, 2) OVER o AS w2 FROM pos WINDOW o AS (PARTITION BY r ORDER BY i)),
rep AS (SELECT r, i, count(*) OVER (PARTITION BY r, w0, w1, w2) AS c FROM tri WHERE w2 IS NOT NULL),
rw AS (SELECT r, count(DISTINCT i + s) AS n_repeat_words FROM rep, (VALUES (0), (1), (2)) v(s) WHERE c > 1 GROUP BY r),
ln AS (SELECT r, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d),
lw AS (SELECT *, regexp_extract_all(line, '{WORD}') AS lws,
         row_number() OVER (PARTITION BY r, line ORDER BY i) > 1 AS dup FROM ln WHERE regexp_matches(line, '{WORD}')),
lb AS (SELECT r, dup, sum_chars, dup
           OR 100 * marked > {MAX_MARKED_PERCENT} * n OR 100 * loud > {MAX_MARKED_PERCENT} * n
           OR (n <= {MAX_MENU_WORDS} AND NOT regexp_matches(line, '[.!?{SENTENCE_ENDS}]') AND NOT regexp_matches(lws[-1], '[:;,]$')
               AND len(regexp_extract_all(line, '{UNSPACED}')) <= {UNSPACED_WORD * MAX_MENU_WORDS})
           OR regexp_matches(translate(line, '{_LATIN[0]}', '{_LATIN[1]}'), '{_PHRASES}') AS bad
       FROM (SELECT *, len(lws) AS n, len(list_filter(lws, lambda x: regexp_matches(x, '[#*$%&|<>]'))) AS marked,
               len(list_filter(lws, lambda x: x[-2:] = '!!')) AS loud, length(array_to_string(lws, '')) AS sum_chars FROM lw)),
l AS (SELECT r, count(*) AS n_lines, count(*) FILTER (dup) AS n_dup_lines, count(*) FILTER (bad) AS n_bad_lines,
        coalesce(sum(sum_chars) FILTER (NOT bad), 0) AS kept_chars FROM lb GROUP BY r),
base AS (SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
           length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
           coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
           coalesce(n_lines, 0) AS n_lines, coalesce(n_bad_lines, 0) AS n_bad_lines, coalesce(kept_chars, 0) AS kept_chars
         FROM w LEFT JOIN rw USING (r) LEFT JOIN l USING (r)),
f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND 100 * kept_chars >= {MIN_KEPT_PERCENT} * word_chars AS kept,
       n_lines, n_bad_lines, CAST(kept_chars AS BIGINT) AS kept_chars
FROM f
"""


@query("op1_line_quality", QUALITY_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality(table(spark, sf_dir, "documents"))
