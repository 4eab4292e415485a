"""Substring dedup by Rabin-Karp hashes of every fixed-length window of words.

Every window of ``size`` consecutive words of one document has two polynomial hashes, to different
bases, of its words' 64-bit hashes.

1. Each block of documents sends its distinct first hashes, sorted, to one task for each hash
   range; there the hashes of all blocks are counted, and each block learns by one bit a hash
   whether another block holds it too.
2. For those alone, blocks send both hashes, and learn by one bit a pair whether an earlier block
   holds it.

A window is repeated if its pair occurs before it in its own block or in an earlier one; repeated
windows merge into maximal removal intervals. Blocks follow (doc_id, start), so "earlier" needs no
positions. A window that a third of all documents share counts once a block.

128 bits stand for a window: among n windows, n * n / 2 / 2**128 false repeats are expected (below
1e-12 for 1e13 windows). Defined results: words are runs of characters other than ASCII white
space; null and empty texts have none; a null id comes before all others; rows with one id are
ordered by a hash of their text, so of equal rows all but one lose their windows; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from adsieve.llm.blocks import ANSWER, ASKED, dealt, from_planes, hash_ranges, in_blocks, masks_by_block, mixed, range_edges, spread_masks, text_bytes, to_planes
from adsieve.llm.storage import keep
from adsieve.llm.words import slices, sole

BASE, SECOND = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
CACHE_WORDS = 500_000
RESULT = "doc_id long, n_words long, n_removed long, removed array<struct<start:int,words:int>>, kept_text string"


class WordHashes(dict):
    """word -> its 64-bit hash as eight bytes."""

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHE_WORDS:
            first = list(islice(self.items(), CACHE_WORDS // 4))
            self.clear()
            self.update(first)
        h = self[word] = xxhash.xxh3_64_intdigest(word).to_bytes(8, "little")
        return h


_HASHES = WordHashes()


def word_hashes(text: bytes) -> np.ndarray:
    return np.frombuffer(b"".join(b"".join(map(_HASHES.__getitem__, text[a:b].split())) for a, b in slices(text)), np.uint64)


def remember_words() -> None:
    """To be called as a task begins that hashes words."""
    sole(_HASHES)


def window_hashes(words: np.ndarray, size: int, base_: int = BASE) -> np.ndarray:
    """The polynomial hash of every run of ``size`` values, by joining runs of doubled length."""
    total, base, run, length = None, 0, words, 1
    rest = size
    while rest:
        if rest & 1:
            if total is None:
                total, base = run, length
            else:  # total covers the first ``base`` values, run the next ``length``
                n = len(words) - base - length + 1
                if n <= 0:
                    return np.zeros(0, np.uint64)
                total = total[:n] * np.uint64(pow(base_, length, 1 << 64)) + run[base : base + n]
                base += length
        rest >>= 1
        if rest:
            if len(run) <= length:
                return np.zeros(0, np.uint64)
            run = run[:-length] * np.uint64(pow(base_, length, 1 << 64)) + run[length:]
            length *= 2
    return mixed(total)


class Windows:
    """The windows of one block: sorted distinct hashes, and where they lie."""

    def __init__(self, texts: list[bytes], size: int) -> None:
        each = [word_hashes(t) for t in texts]
        self.lengths = np.fromiter(map(len, each), np.int64, len(each))
        words = np.concatenate(each) if each else np.zeros(0, np.uint64)
        every = window_hashes(words, size) if len(words) >= size else np.zeros(0, np.uint64)
        ends = np.repeat(np.cumsum(self.lengths), self.lengths)[: len(every)]
        self.starts = np.flatnonzero(np.arange(len(every)) + size <= ends)
        self.words = len(words)
        self.hashes, self._every_word, self.size = every[self.starts], words, size

    def seconds(self, some: np.ndarray) -> np.ndarray:
        """The second hashes of flagged windows."""
        return window_hashes(mixed(self._every_word ^ np.uint64(SECOND)), self.size, SECOND)[self.starts[some]] if some.any() else np.zeros(0, np.uint64)


class Pairs:
    """The distinct pairs of hashes of flagged windows, sorted; ``which`` pair each such window has, and its first one."""

    def __init__(self, own: Windows, some: np.ndarray) -> None:
        one, two = own.hashes[some], own.seconds(some)
        by = np.lexsort((two, one))
        fresh = np.append(True, (one[by][1:] != one[by][:-1]) | (two[by][1:] != two[by][:-1]))[: len(by)]
        self.which = np.empty(len(by), np.int64)
        self.which[by] = np.cumsum(fresh) - 1
        self.first = by[fresh]  # the sort is stable: the earliest window of the pair
        self.one, self.two = one[self.first], two[self.first]


def _cut(values: np.ndarray, edges: np.ndarray, live: np.ndarray) -> pa.Array:
    return pa.array([to_planes(values[edges[r] : edges[r + 1]]) for r in live], pa.binary())


def _ask(size: int, ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remember_words()
        for batch in batches:
            for k in range(batch.num_rows):
                distinct = np.unique(Windows(batch.column("texts")[k].as_py(), size).hashes)
                edges = range_edges(distinct, ranges)
                live = np.flatnonzero(np.diff(edges))
                block = np.full(len(live), batch.column("block_id")[k].as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(live.astype(np.int32)), _cut(distinct, edges, live)], ["block_id", "bucket", "hashes"])

    return run


def _answer(table: pa.Table, flags: np.ndarray, edges: np.ndarray) -> pa.Table:
    masks = [np.packbits(flags[a:b]).tobytes() if flags[a:b].any() else None for a, b in zip(edges, edges[1:])]
    out = pa.Table.from_arrays([table.column("block_id"), table.column("bucket"), pa.array(masks, pa.binary())], ["block_id", "bucket", "mask"])
    return out.filter(pa.array([m is not None for m in masks]))


def _count(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """For each block's hashes of one range: does another block hold them too?"""
    parts = [from_planes(h) for h in table.column("hashes").to_pylist()]
    every = np.concatenate(parts)
    by = np.argsort(every)
    same = every[by][1:] == every[by][:-1]
    shared = np.zeros(len(every), bool)
    shared[by] = np.append(False, same) | np.append(same, False)
    return _answer(table, shared, np.cumsum([0, *map(len, parts)]))


def _ask_pairs(size: int, ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remember_words()
        for batch in batches:
            for k in range(batch.num_rows):
                own = Windows(batch.column("texts")[k].as_py(), size)
                distinct, which = np.unique(own.hashes, return_inverse=True)
                shared = spread_masks(batch.column("masks")[k].as_py(), range_edges(distinct, ranges))
                pairs = Pairs(own, shared[which])
                edges = range_edges(pairs.one, ranges)
                live = np.flatnonzero(np.diff(edges))
                block = np.full(len(live), batch.column("block_id")[k].as_py(), np.int64)
                columns = [pa.array(block), pa.array(live.astype(np.int32)), _cut(pairs.one, edges, live), _cut(pairs.two, edges, live)]
                yield pa.RecordBatch.from_arrays(columns, ["block_id", "bucket", "hashes", "seconds"])

    return run


def _count_pairs(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """For each block's pairs of one range: does an earlier block hold them?"""
    table = table.sort_by("block_id")
    parts = [from_planes(h) for h in table.column("hashes").to_pylist()]
    one, two = np.concatenate(parts), np.concatenate([from_planes(h) for h in table.column("seconds").to_pylist()])
    by = np.lexsort((two, one))  # stable: the earliest block first
    later = np.zeros(len(one), bool)
    later[by] = np.append(False, (one[by][1:] == one[by][:-1]) & (two[by][1:] == two[by][:-1]))
    return _answer(table, later, np.cumsum([0, *map(len, parts)]))


def covered(starts: np.ndarray, size: int, length: int) -> np.ndarray:
    """Flags of the places that windows at ``starts`` cover."""
    change = np.bincount(starts, minlength=length + 1)[: length + 1].astype(np.int64)
    change -= np.bincount(starts + size, minlength=length + 1)[: length + 1]
    return np.cumsum(change)[:length] > 0


def runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """(start, length) of the maximal runs of set flags."""
    steps = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return list(zip(steps[::2].tolist(), (steps[1::2] - steps[::2]).tolist()))


def _kept(text: bytes, gone: np.ndarray) -> bytes:
    if not gone.any():
        return b" ".join(text.split())
    out, at = [], 0
    for a, b in slices(text):
        words = text[a:b].split()
        flags = gone[at : at + len(words)]
        out += [words[k] for k in np.flatnonzero(~flags).tolist()]
        at += len(words)
    return b" ".join(out)


def _remove(size: int, ranges: int):
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32())])), pa.string())
    names = ["doc_id", "n_words", "n_removed", "removed", "kept_text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remember_words()
        for batch in batches:
            for k in range(batch.num_rows):
                texts = batch.column("texts")[k].as_py()
                own = Windows(texts, size)
                distinct, which, times = np.unique(own.hashes, return_inverse=True, return_counts=True)
                shared = spread_masks(batch.column("masks")[k].as_py(), range_edges(distinct, ranges))
                doubtful = (shared | (times > 1))[which]
                pairs = Pairs(own, doubtful)
                asked = np.flatnonzero(shared[np.searchsorted(distinct, pairs.one)])  # as they were sent
                earlier = np.zeros(len(pairs.one), bool)
                earlier[asked] = spread_masks(batch.column("pair_masks")[k].as_py(), range_edges(pairs.one[asked], ranges))
                repeated = np.zeros(len(own.hashes), bool)
                repeated[doubtful] = earlier[pairs.which] | (pairs.first[pairs.which] != np.arange(len(pairs.which)))
                gone = covered(own.starts[repeated], size, own.words)
                rows, at = [], 0
                for doc, text, n in zip(batch.column("doc_ids")[k].as_py(), texts, own.lengths.tolist()):
                    flags = gone[at : at + n]
                    spans = [{"start": s, "words": w} for s, w in runs(flags)] if flags.any() else []
                    rows.append((doc, n, int(flags.sum()), spans, _kept(text, flags).decode("utf-8", "replace")))
                    at += n
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    return run


def remove_repeats(docs: DataFrame, size: int = 20, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A RESULT row for each document: removed word intervals, and the kept words joined by single spaces."""
    table = in_blocks(docs, ordered=True, id_column=id_column, text_column=text_column)
    total = 2 * text_bytes(table)  # of hashes: eight bytes for a word, which takes four at least on the whole
    ranges = hash_ranges(docs.sparkSession, total)
    asked = dealt(table.mapInArrow(_ask(size, ranges), ASKED), total)
    shared = keep(masks_by_block(asked.groupBy("bucket").applyInArrow(_count, ANSWER)), "shared")
    told = table.join(shared.hint("shuffle_hash"), "block_id", "left")
    doubted = dealt(table.join(shared.hint("shuffle_hash"), "block_id").mapInArrow(_ask_pairs(size, ranges), ASKED + ", seconds binary"), total)
    answers = masks_by_block(doubted.groupBy("bucket").applyInArrow(_count_pairs, ANSWER)).withColumnRenamed("masks", "pair_masks")
    return told.join(answers.hint("shuffle_hash"), "block_id", "left").mapInArrow(_remove(size, ranges), RESULT)


ORACLE = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), words AS (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM texts
), spans AS (
  SELECT doc_id, p, word, string_agg(word, ' ') OVER o AS w, count(*) OVER o = 20 AS whole
  FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)
), ranked AS (
  SELECT doc_id, p, word, whole AND row_number() OVER (PARTITION BY md5(w), whole ORDER BY doc_id, p) > 1 AS again FROM spans
), judged AS (
  SELECT doc_id, p, word, bool_or(again) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM ranked
), kept AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY p) FILTER (NOT gone), '') AS kept
  FROM judged GROUP BY doc_id
)
SELECT t.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts t LEFT JOIN kept USING (doc_id)"""
