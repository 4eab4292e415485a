"""Quality rules, line first: judge every line, remove failures, reject documents that lose too much.

Words are runs of characters other than ASCII white space. A line fails if

* symbols: characters of ``[#*$%&|<>]`` are more than a tenth of the characters in its words,
* navigation: it has two separators (``|``, ``>``) or more, one for every four words at least; or
  it has at most three words and fails the next rule,
* punctuation: no word of it ends in a sentence mark of some script (closing quotes and brackets may follow; the
  wide marks of Chinese and Japanese need no end of word), and none of its letters is of a script without such marks,
* boilerplate: it has at most 40 words and one of the fixed phrases, in any case of A-Z.

Lines without words are neither kept nor lost. A document is kept if it passes the base rules
(at least ``min_words`` words, at most ``max_repeat_percent`` percent of them in repeated 8-word
windows) and loses at most ``max_lost_percent`` percent of its word characters with its lines.

Defined results: a null or empty text has zero counts and fails the base rules; repeated rows are
judged each by itself; an empty table gives an empty result; any other columns are ignored by
``judge`` and carried along by ``clean``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SYMBOLS = b"#*$%&|<>"
# Phrases of site boilerplate.
BOILERPLATE = [
    "all rights reserved",
    "accept cookies",
    "cookie policy",
    "enable javascript",
    "privacy policy",
    "terms of use",
    "terms of service",
    "lorem ipsum",
    "click here",
    "sign up for",
    "subscribe to our",
    "share this",
]
# Sentence marks, after which quotes and brackets may close before white space; those that need none
# behind them. Thai and Lao (U+0E00 to U+0EFF, E0 B8 80 to E0 BB BF in bytes) have no sentence mark.
MARKS = "…؟۔।॥։።፧၊။។៕།"
WIDE_MARKS = "。！？．｡"
_CLOSED = r"(?:[\"')\]]|”|’|»)*(?:[\x20\x09-\x0D]|$)"
# Compiled as bytes: characters of several bytes are alternatives, as a class would take each of their bytes.
_ENDS = re.compile((r"[.!?]" + _CLOSED).encode())
_OTHER_ENDS = re.compile(("(?:" + "|".join(MARKS) + ")" + _CLOSED + "|" + "|".join(WIDE_MARKS)).encode())
_NO_MARKS = re.compile(rb"\xe0[\xb8-\xbb]")
_BOILER = re.compile("|".join(BOILERPLATE).encode())
_NOT_SYMBOL = bytes(set(range(256)) - set(SYMBOLS))
_SPACES = b" \t\n\v\f\r"
_CONTINUATION = bytes(range(0x80, 0xC0))

VERDICT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("word_chars", T.LongType()),
        T.StructField("n_symbols", T.LongType()),
        T.StructField("n_dup_lines", T.LongType()),
        T.StructField("n_repeat_words", T.LongType()),
        T.StructField("n_lines", T.LongType()),
        T.StructField("n_failed_lines", T.LongType()),
        T.StructField("lost_chars", T.LongType()),
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("kept", T.BooleanType()),
        T.StructField("clean_text", T.StringType()),
    ]
)


def word_characters(part: bytes) -> int:
    """Code points in words: bytes that are neither ASCII white space nor UTF-8 continuation."""
    return len(part.translate(None, _SPACES + _CONTINUATION))


def line_failure(line: bytes, words: list[bytes]) -> str | None:
    """The first rule that a line with words fails, or None."""
    n = len(words)
    separators = line.count(b"|") + line.count(b">")
    if separators >= 2 and 4 * separators >= n:
        return "navigation"
    if 10 * len(line.translate(None, _NOT_SYMBOL)) > word_characters(line):
        return "symbols"
    if not _ENDS.search(line) and (line.isascii() or not (_OTHER_ENDS.search(line) or _NO_MARKS.search(line))):
        return "navigation" if n <= 3 else "punctuation"
    if n <= 40 and _BOILER.search(line.lower()):
        return "boilerplate"
    return None


def repeated_words(words: list[bytes], size: int = 8) -> int:
    """Words inside windows of ``size`` words that occur twice or more; exact, by ranking doubled windows."""
    if len(words) <= size:
        return 0
    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
    ranks = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    if len(number) == len(words):
        return 0
    step = 1
    while step < size:
        ranks = np.unique(ranks[:-step] * (int(ranks.max()) + 1) + ranks[step:], return_inverse=True)[1]
        step *= 2
    again = np.bincount(ranks)[ranks] > 1
    if not again.any():
        return 0
    covered = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(again)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + size, -1)
    return int((np.cumsum(covered)[:-1] > 0).sum())


def judge_text(text: bytes, min_words: int, max_repeat: int, max_lost: int) -> tuple:
    """Every column of VERDICT after ``doc_id``."""
    every: list[bytes] = []
    seen: set[bytes] = set()
    kept: list[bytes] = []
    duplicates = lines = failed = lost = 0
    for line in text.split(b"\n"):
        words = line.split()
        if not words:
            continue
        every += words
        lines += 1
        duplicates += line in seen
        seen.add(line)
        if line_failure(line, words):
            failed += 1
            lost += word_characters(line)
        else:
            kept.append(line)
    n, chars, repeats = len(every), word_characters(text), repeated_words(every)
    base_failed = n < min_words or 100 * repeats > max_repeat * n
    fine = not base_failed and 100 * lost <= max_lost * chars
    symbols = len(text.translate(None, _NOT_SYMBOL))
    return n, chars, symbols, duplicates, repeats, lines, failed, lost, base_failed, fine, b"\n".join(kept).decode("utf-8", "replace")


def _judge(min_words: int, max_repeat: int, max_lost: int):
    schema = pa.schema([(f.name, {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}[f.dataType.typeName()]) for f in VERDICT])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = [judge_text((t.as_py() or b"") if t.is_valid else b"", min_words, max_repeat, max_lost) for t in part.column(1)]
                columns = [part.column(0), *(pa.array(c, f.type) for c, f in zip(zip(*rows), list(schema)[1:]))]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


def judge(
    docs: DataFrame,
    min_words: int = 20,
    max_repeat_percent: int = 30,
    max_lost_percent: int = 50,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """A VERDICT row for each row of ``docs``; a map over the scan, with no shuffle."""
    whole = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("binary").alias("text"))
    return whole.mapInArrow(_judge(min_words, max_repeat_percent, max_lost_percent), VERDICT)


def clean(docs: DataFrame, **rules: int) -> DataFrame:
    """The kept documents with their kept lines as text; all other columns stay (``n_chars`` follows the text)."""
    plain = {"min_words": 20, "max_repeat_percent": 30, "max_lost_percent": 50} | rules
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            found = [judge_text(t.as_py().encode() if t.is_valid else b"", *plain.values())[-2:] for t in batch.column(at)]
            keep = pa.array([f for f, _ in found], pa.bool_())
            texts = pa.array([t for _, t in found], batch.schema.field(at).type)
            yield batch.set_column(at, batch.schema.field(at), texts).filter(keep)

    kept = docs.mapInArrow(run, docs.schema)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else kept


ORACLE = """
WITH split_lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS nth
  FROM documents
), measured AS (
  SELECT doc_id, nth, line, regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+') AS words,
         length(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g')) AS chars,
         length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) AS symbols,
         length(regexp_replace(line, '[^|>]', '', 'g')) AS bars
  FROM split_lines
), judged AS (
  SELECT *, len(words) AS n,
    row_number() OVER (PARTITION BY doc_id, line ORDER BY nth) > 1 AS again,
    10 * symbols > chars
      OR (bars >= 2 AND 4 * bars >= len(words))
      OR NOT (regexp_matches(line, '[.!?…؟۔।॥։።፧၊။។៕།]["''”’»)\\]]*([\\x20\\x09-\\x0D]|$)') OR regexp_matches(line, '[。！？．｡]') OR regexp_matches(line, '[\\x{0E00}-\\x{0EFF}]'))
      OR (len(words) <= 40 AND regexp_matches(line, '(?i)(all rights reserved|accept cookies|cookie policy|enable javascript|privacy policy|terms of use|terms of service|lorem ipsum|click here|sign up for|subscribe to our|share this)')) AS failed
  FROM measured WHERE len(words) > 0
), words AS (
  SELECT doc_id, word, row_number() OVER (PARTITION BY doc_id ORDER BY nth, k) AS p FROM (
    SELECT doc_id, nth, unnest(words) AS word, generate_subscripts(words, 1) AS k FROM judged)
), windows AS (
  SELECT doc_id, p, hash(a, b, c, d, e, f, g, h) AS w, h IS NOT NULL AS whole FROM (
    SELECT doc_id, p, word AS a, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c, lead(word, 3) OVER o AS d,
           lead(word, 4) OVER o AS e, lead(word, 5) OVER o AS f, lead(word, 6) OVER o AS g, lead(word, 7) OVER o AS h
    FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY p))
), repeated AS (
  SELECT doc_id, p, whole AND count(*) OVER (PARTITION BY doc_id, w, whole) > 1 AS twice FROM windows
), covered AS (
  SELECT doc_id, p, bool_or(twice) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS hit FROM repeated
), repeats AS (SELECT doc_id, count(*) FILTER (hit) AS n_repeat_words FROM covered GROUP BY doc_id),
sums AS (
  SELECT doc_id, sum(n) AS n_words, sum(chars) AS word_chars, count(*) FILTER (again) AS n_dup_lines,
         coalesce(sum(chars) FILTER (failed), 0) AS lost
  FROM judged GROUP BY doc_id
), base AS (
  SELECT d.doc_id, coalesce(s.n_words, 0)::BIGINT AS n_words, coalesce(s.word_chars, 0)::BIGINT AS word_chars,
         coalesce(length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g')), 0)::BIGINT AS n_symbols,
         coalesce(s.n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(r.n_repeat_words, 0)::BIGINT AS n_repeat_words,
         coalesce(s.lost, 0) AS lost
  FROM documents d LEFT JOIN sums s USING (doc_id) LEFT JOIN repeats r USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * lost <= 50 * word_chars AS kept
FROM base"""
