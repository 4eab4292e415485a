"""Packing: bounded-space online packing of tokenised documents into fixed windows.

Every partition keeps a fixed number of open windows. A document that is longer than a window
is cut into full windows and a rest; a rest goes to the open window that it fills best
(best fit). If it fits nowhere, the fullest window is emitted and a fresh one takes its place.
The windows that a partition leaves open are merged across partitions: their pieces are laid end
to end and cut at window borders, so that only one sequence of each merging group needs padding.

Defined results: a null or empty text is a document of the end id alone; null ids and repeated
rows are packed as they are, one document a row; other columns are ignored; an empty table gives
an empty result. Every id lies in exactly one piece.
"""

from __future__ import annotations

import re
import struct
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adsieve.llm.storage import keep
from adsieve.llm.words import slices, sole

#: Distinct words, and stems of words, whose ids a worker remembers at a time.
CACHE_WORDS, CACHE_STEMS = 900_000, 200_000
_PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: The ids below this bound as bytes.
_FOUR = [struct.pack("<I", k) for k in range(1 << 16)]
#: Open windows that one merging group takes; each group pads one sequence at most.
MERGE_WINDOWS = 512

PIECE = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ]
)
OPEN_PIECE = T.StructType([*PIECE.fields, T.StructField("open", T.BooleanType())])


class WordEncoder(dict):
    """Ids of whole texts by way of their words: word -> little-endian unsigned 32-bit ids.

    The vocabulary's pre-tokeniser never joins what ASCII white space separates and drops the
    white space itself, and its normaliser doesn't compose across it, so the ids of a text are
    those of its words, one after another. Words repeat, so their ids are remembered. A word of
    Latin-1 letters, perhaps with a full stop or comma, is one piece of text (or two) before the
    merges, which lets the library's merge model have it directly; any other word takes the
    library's whole way.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        from tokenizers import Tokenizer, pre_tokenizers

        whole = Tokenizer.from_file(path)
        self.encode, self.merge = whole.encode, whole.model.tokenize
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0x80, 0x100)}
        self.marks = {m: self._pack(whole.encode(m, add_special_tokens=False).ids) for m in ("", ".", ",")}
        self.stems: dict[str, bytes] = {}

    @staticmethod
    def _pack(ids: list[int]) -> bytes:
        return b"".join(map(_FOUR.__getitem__, ids)) if ids and max(ids) < len(_FOUR) else struct.pack(f"<{len(ids)}I", *ids)

    def clear(self) -> None:
        super().clear()
        self.stems.clear()

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHE_WORDS:  # the words met first are the frequent ones
            first = list(islice(self.items(), CACHE_WORDS // 4))
            self.clear()
            self.update(first)
        text = word.decode("utf-8", "replace")
        mark = text[-1:] if text[-1:] in (".", ",") else ""
        stem = text[:-1] if mark else text
        if (easy := stem.isascii() and stem.isalpha()) or _PLAIN.fullmatch(stem):
            stem = stem.lower() if easy else stem.lower().translate(self.letters)
            ids = self.stems.get(stem)
            if ids is None:
                if len(self.stems) >= CACHE_STEMS:
                    self.stems.clear()
                ids = self.stems[stem] = self._pack([t.id for t in self.merge(stem)])
            if mark:
                ids += self.marks[mark]
        else:
            ids = self._pack(self.encode(text, add_special_tokens=False).ids)
        self[word] = ids
        return ids

    def ids(self, text: bytes) -> bytes:
        return b"".join(b"".join(map(self.__getitem__, text[at:to].split())) for at, to in slices(text))


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder for each worker process, so that what it has learned serves its later tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


class Windows:
    """The open windows of one partition: slot -> (free places, pieces)."""

    def __init__(self, size: int, count: int, base: int) -> None:
        self.size, self.count, self.next = size, count, base
        self.order: list[tuple[int, int]] = []  # (free, sequence_id), ascending
        self.held: dict[int, list[tuple]] = {}

    def open(self) -> int:
        self.next += 1
        self.held[self.next - 1] = []
        return self.next - 1

    def put(self, at: int, free: int, piece: tuple) -> list[tuple]:
        """Add a piece to window ``at``; the pieces of the window if that made it full."""
        doc, start, ids, total = piece
        length = len(ids) // 4
        self.held[at].append((doc, start, length, ids, total, at, self.size - free))
        if free == length:
            return self.held.pop(at)
        insort(self.order, (free - length, at))
        return []

    def add(self, doc: int | None, ids: bytes) -> Iterator[tuple]:
        total, at = len(ids) // 4, 0
        while total - at >= self.size:
            yield from self.put(self.open(), self.size, (doc, at, ids[4 * at : 4 * (at + self.size)], total))
            at += self.size
        rest = total - at
        if not rest:
            return
        k = bisect_left(self.order, (rest, -1))
        if k < len(self.order):
            free, slot = self.order.pop(k)
        else:
            if len(self.order) == self.count:
                yield from self.held.pop(self.order.pop(0)[1])
            free, slot = self.size, self.open()
        yield from self.put(slot, free, (doc, at, ids[4 * at :], total))


def _pack_partition(path: str, size: int, count: int, end_id: int):
    end = struct.pack("<I", end_id)
    names = OPEN_PIECE.names

    def rows(pieces: list[tuple], is_open: bool) -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*pieces), (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()))]
        return pa.RecordBatch.from_arrays([*columns, pa.array([is_open] * len(pieces), pa.bool_())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, windows = sole(encoder(path)), Windows(size, count, TaskContext.get().partitionId() << 40)
        ready: list[tuple] = []
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ready.extend(windows.add(doc, coder.ids(text or b"") + end))
                if ready:
                    yield rows(ready, False)
                    ready = []
        if ready:
            yield rows(ready, False)
        if left := [p for _, at in windows.order for p in windows.held[at]]:
            yield rows(left, True)

    return run


def _merge(size: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        out, group = [], key[0].as_py()
        number, used = 0, 0
        for r in table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")]).to_pylist():
            ids, start = r["ids"], r["start"]
            while ids:
                if used == size:
                    number, used = number + 1, 0
                part, ids = ids[: 4 * (size - used)], ids[4 * (size - used) :]
                n = len(part) // 4
                out.append((r["doc_id"], start, n, part, r["doc_tokens"], (1 << 62) + (group << 32) + number, used))
                start, used = start + n, used + n
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], PIECE.names)

    return run


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    window: int = 2048,
    open_windows: int = 64,
    end_id: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Pack all documents into sequences of at most ``window`` ids.

    A row per piece: ``doc_id``, ``start`` (ids of its document before it), ``length``, ``ids``
    (little-endian unsigned 32-bit), ``doc_tokens`` (ids of the document, end id included),
    ``sequence_id`` and ``offset`` (place in the sequence). A scan is packed where it lies, with
    no shuffle; only the windows left open, a fixed number a partition, move.
    """
    whole = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("binary").alias("text"))
    placed = keep(whole.mapInArrow(_pack_partition(tokenizer_path, window, open_windows, end_id), OPEN_PIECE), "packed")
    left = placed.where("open").drop("open")
    windows = left.agg(F.count_if(F.col("offset") == 0).alias("n")).first()["n"]
    groups = 1 + windows // MERGE_WINDOWS
    dealt = left.withColumn("merge_group", F.pmod(F.xxhash64("sequence_id"), F.lit(groups)))
    merged = dealt.groupBy("merge_group").applyInArrow(_merge(window), PIECE)
    return placed.where(~F.col("open")).drop("open").unionByName(merged)
