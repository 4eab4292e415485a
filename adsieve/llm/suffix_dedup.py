"""Suffix-array dedup: remove every byte covered by a long string that starts anywhere else too.

Windows of ``size`` bytes are dealt to shards by content: each belongs to its anchor, the half-size
substring in it with the least hash, so equal windows share a shard. Consecutive windows of one
anchor make a segment; a segment's text is all that its windows cover.

1. Each block of documents names its distinct segments by two hashes (anchor, whole text; equal
   names within a block are compared byte by byte). An anchor that occurs once has no repeated
   window. Each other segment is sent by the first two blocks that hold it, so that a passage of a
   third of all documents is not gathered; further holders of its name share what is found for it.
2. An anchor of more than ``hot`` different segments (the edge of a passage that a large part of
   all documents share) would gather in one shard. Its windows get longer anchors instead, again
   and again if need be, up to the whole window, which has one segment only.
3. A shard writes its segments to a scratch file and finds equal ones by comparing their bytes. The
   suffixes of all different ones that share their anchor with another are sorted together by
   external induced sorting (``induced_sort``), in memory that doesn't grow with the shard. A window
   is repeated if its suffix has ``size`` bytes in common with a neighbour in that order, or if its
   segment came more than once.
4. Each block learns, by a bit a segment and a bit a window of those it sent, what to remove.

Windows are judged on the input, within one document each; overlaps count.

Defined results: a null text is empty; texts shorter than ``size`` bytes lose nothing; repeated rows
lose all that they share; ids may be null; other columns are ignored by ``remove_repeats``; an empty
table gives an empty result. Hashes decide for the third and later holders of a segment alone: there,
equal names (128 bits) are taken for equal segments, the first two of which are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adsieve.llm import induced_sort
from adsieve.llm.blocks import dealt, from_planes, hash_ranges, in_blocks, mixed, range_edges, text_bytes, to_planes
from adsieve.llm.storage import keep
from adsieve.llm.word_windows import runs
from adsieve.llm.words import sole

SPAN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))
RESULT = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,length:long>>, kept binary"
ASKED = "block_id long, bucket int, anchors binary, forms binary"
CODES = "block_id long, level int, bucket int, mask binary, hot boolean"
SENT = "block_id long, level int, bucket int, n_bytes long, anchors binary, forms binary, times binary, lengths binary, texts binary"
ANSWERS = "block_id long, level int, bucket int, mask binary"
CHUNK = 1 << 18
#: Bytes of segments that a shard should hold, if there are more shards than cores; whole anchors.
SHARD = 16 << 20
#: Different segments of one anchor beyond which its windows get longer anchors.
HOT = 4096
_POWER = 0x9E3779B97F4A7C15 | 1
_VALUES = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64."""
    if n not in _tables:
        both = []
        for base in (_POWER, pow(_POWER, -1, 1 << 64)):
            p = np.ones(n, np.uint64)
            done = 1
            while done < n:
                p[done : 2 * done] = p[: min(done, n - done)] * np.uint64(pow(base, done, 1 << 64))
                done *= 2
            both.append(p)
        _tables[n] = tuple(both)
    return _tables[n]


def anchor_sizes(size: int) -> list[int]:
    """Anchors' lengths, level by level: each halves what the one before leaves of a window; the last is the window."""
    out = [size // 2]
    while out[-1] < size:
        out.append(size - (size - out[-1]) // 2)
    return out


class Segments:
    """The segments of one block at one level: where they lie, how many windows they have, and their distinct forms.

    ``allowed``: flags of the windows that belong to this level, by start; None: all.
    """

    def __init__(self, texts: list[bytes], size: int, anchor: int, allowed: np.ndarray | None = None) -> None:
        self.size, self.anchor, self.allowed = size, anchor, allowed
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        found = [self._chunk(a, min(len(self.data), a + CHUNK + size - 1)) for a in range(0, max(1, len(self.data) - size + 1), CHUNK)] if len(self.data) >= size else []
        none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.starts, self.counts, anchors, forms = (np.concatenate(c) for c in zip(*found)) if found else none
        by = np.lexsort((forms, anchors))
        fresh = np.ones(len(by), bool)
        fresh[1:] = (anchors[by][1:] != anchors[by][:-1]) | (forms[by][1:] != forms[by][:-1])
        for k in np.flatnonzero(~fresh).tolist():  # the same names: the same bytes?
            fresh[k] = self._bytes(by[k]) != self._bytes(by[k - 1])
        self.which = np.empty(len(by), np.int64)  # segment -> its distinct form
        self.which[by] = np.cumsum(fresh) - 1
        self.first = by[fresh]  # form -> a segment that has it
        self.times = np.minimum(2, np.bincount(self.which, minlength=len(self.first))).astype(np.uint8)
        self.anchors, self.forms = anchors[self.first], forms[self.first]

    def _bytes(self, segment: int) -> bytes:
        return self.data[self.starts[segment] : self.starts[segment] + self.counts[segment] + self.size - 1].tobytes()

    def windows_of(self, flags: np.ndarray) -> np.ndarray:
        """Flags of the windows, by start, of the segments of flagged forms."""
        out = np.zeros(len(self.data), bool)
        own = np.flatnonzero(flags[self.which])
        counts = self.counts[own]
        out[np.arange(int(counts.sum())) + np.repeat(self.starts[own] - (np.cumsum(counts) - counts), counts)] = True
        return out

    def _chunk(self, a: int, b: int) -> tuple[np.ndarray, ...]:
        """Segments of the windows that start in [a, b - size]; a border between chunks also parts segments."""
        size, k = self.size, self.anchor
        n = b - a
        power, inverse = _powers(CHUNK + size)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_VALUES[self.data[a:b]] * power[:n], out=sums[1:])
        hashes = mixed((sums[k:] - sums[:-k]) * inverse[: n + 1 - k])
        windows = n - size + 1
        reach = size - k + 1  # half-size substrings of a window
        place_bits = np.uint64((2 * CHUNK - 1).bit_length())
        key = (hashes >> place_bits << place_bits) | np.arange(len(hashes), dtype=np.uint64)
        rows = -(-len(key) // reach)
        grid = np.full(rows * reach, np.iinfo(np.uint64).max, np.uint64)
        grid[: len(key)] = key
        grid = grid.reshape(rows, reach)
        ahead = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        behind = np.minimum.accumulate(grid, axis=1).ravel()
        least = np.minimum(ahead[:windows], behind[reach - 1 : reach - 1 + windows])
        anchor = (least & np.uint64((1 << int(place_bits)) - 1)).astype(np.int64)
        lows = np.searchsorted(self.ends, a, side="right")
        valid = np.ones(windows, bool)
        for end in self.ends[lows : np.searchsorted(self.ends, b, side="right")].tolist():
            valid[max(0, end - a - size + 1) : max(0, end - a)] = False
        if self.allowed is not None:
            valid &= self.allowed[a : a + windows]
        starts = np.flatnonzero(valid)
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        own = anchor[starts]
        new = np.ones(len(starts), bool)
        new[1:] = (own[1:] != own[:-1]) | (starts[1:] != starts[:-1] + 1)
        at = np.flatnonzero(new)
        counts = np.diff(np.append(at, len(starts)))
        first = starts[at]
        stop = first + counts + size - 1
        forms = mixed((sums[stop] - sums[first]) * inverse[first] + counts.astype(np.uint64))
        return first + a, counts, mixed(hashes[own[at]] + np.uint64(1)), forms  # least hashes are small: mix again, to deal them evenly

    def text(self, form: int) -> bytes:
        return self._bytes(self.first[form])


class Told:
    """What the settled levels say about a block's forms: sent, repeated as a whole, or anchored anew at the next level."""

    def __init__(self, texts: list[bytes], size: int, masks: list[dict] | None, ranges: int, levels: int) -> None:
        self.levels: list[tuple[Segments, np.ndarray, np.ndarray, np.ndarray]] = []
        allowed = None
        for level in range(levels):
            own = Segments(texts, size, anchor_sizes(size)[level], allowed)
            edges = range_edges(own.anchors, ranges)
            flags = np.zeros((3, len(own.first)), bool)
            for m in masks or ():
                if m["level"] == level:
                    a, b = edges[m["bucket"]], edges[m["bucket"] + 1]
                    flags[:, a:b] = np.unpackbits(np.frombuffer(m["mask"], np.uint8), count=3 * (b - a)).reshape(3, -1)
            self.levels.append((own, edges, *flags[:2]))
            if not flags[2].any():
                self.last = None
                break
            allowed = self.last = own.windows_of(flags[2])


def _ask(size: int, ranges: int, level: int):
    """Names of the forms of a block at one level, by range; all windows at level 0, else those of hot anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sole(_tables)
        for batch in batches:
            for k in range(batch.num_rows):
                texts, allowed = batch.column("texts")[k].as_py(), None
                if level:
                    allowed = Told(texts, size, batch.column("masks")[k].as_py(), ranges, level).last
                    if allowed is None:
                        continue
                own = Segments(texts, size, anchor_sizes(size)[level], allowed)
                edges = range_edges(own.anchors, ranges)
                live = np.flatnonzero(np.diff(edges))
                cut = lambda f: pa.array([f(slice(edges[r], edges[r + 1])) for r in live], pa.binary())
                # the lowest bit of a form's name tells whether the block holds it more than once
                forms = own.forms & ~np.uint64(1) | (own.times > 1).astype(np.uint64)
                columns = [cut(lambda s: to_planes(own.anchors[s])), cut(lambda s: forms[s].tobytes())]
                block = pa.array(np.full(len(live), batch.column("block_id")[k].as_py(), np.int64))
                yield pa.RecordBatch.from_arrays([block, pa.array(live.astype(np.int32)), *columns], ["block_id", "bucket", "anchors", "forms"])

    return run


def _settle(level: int, hot: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """For each block's forms of one range: must the text be sent, is it a further copy, is its anchor hot?"""
        table = table.sort_by("block_id")
        anchors = [from_planes(a) for a in table.column("anchors").to_pylist()]
        edges = np.cumsum([0, *map(len, anchors)])
        anchor = np.concatenate(anchors)
        name = np.concatenate([np.frombuffer(f, np.uint64) for f in table.column("forms").to_pylist()])
        form, again = name & ~np.uint64(1), (name & np.uint64(1)).astype(np.int64)
        by = np.lexsort((np.arange(len(anchor)), form, anchor))
        new_anchor = np.append(True, anchor[by][1:] != anchor[by][:-1])
        new_form = new_anchor | np.append(True, form[by][1:] != form[by][:-1])
        kind, at = np.cumsum(new_anchor) - 1, np.arange(len(by))
        holder = at - np.maximum.accumulate(np.where(new_form, at, 0))
        often = (np.bincount(kind, 1 + again[by]) > 1)[kind]
        many = (np.bincount(kind[new_form], minlength=kind[-1] + 1) > hot)[kind]
        masks = np.zeros((3, len(anchor)), bool)
        masks[0, by] = often & ~many & (holder < 2)
        masks[1, by] = often & ~many & (holder >= 2)
        masks[2, by] = many
        packed = [np.packbits(masks[:, a:b].ravel()).tobytes() if masks[:, a:b].any() else None for a, b in zip(edges, edges[1:])]
        any_hot = pa.array([bool(masks[2, a:b].any()) for a, b in zip(edges, edges[1:])])
        levels = pa.array(np.full(len(packed), level, np.int32))
        out = pa.Table.from_arrays([table.column("block_id"), levels, table.column("bucket"), pa.array(packed, pa.binary()), any_hot], ["block_id", "level", "bucket", "mask", "hot"])
        return out.filter(pa.array([m is not None for m in packed]))

    return run


def _send(size: int, ranges: int, levels: int):
    names = ["block_id", "level", "bucket", "n_bytes", "anchors", "forms", "times", "lengths", "texts"]
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sole(_tables)
        for batch in batches:
            for k in range(batch.num_rows):
                told, rows = Told(batch.column("texts")[k].as_py(), size, batch.column("masks")[k].as_py(), ranges, levels), []
                for level, (own, edges, send, _) in enumerate(told.levels):
                    for r in np.flatnonzero(np.diff(edges)):
                        forms = edges[r] + np.flatnonzero(send[edges[r] : edges[r + 1]])
                        if len(forms):
                            texts = [own.text(f) for f in forms]
                            lengths = np.fromiter(map(len, texts), np.int32, len(texts))
                            rows.append((batch.column("block_id")[k].as_py(), level, int(r), int(lengths.sum()), own.anchors[forms].tobytes(), own.forms[forms].tobytes(), own.times[forms].tobytes(), lengths.tobytes(), b"".join(texts)))
                for a in range(0, len(rows), 256):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[a : a + 256]), kinds)], names)

    return run


def repeated_windows(data: np.ndarray, lengths: np.ndarray, size: int) -> np.ndarray:
    """Flags of the places in ``data`` (texts laid end to end) whose ``size`` bytes occur at another place too."""
    text = induced_sort.scratch(len(data) + len(lengths), np.uint16)
    hit = induced_sort.scratch(len(text), bool, 0)
    ends = np.cumsum(lengths)
    homes = ends - lengths + np.arange(len(lengths))
    for home, start, end in zip(homes.tolist(), (ends - lengths).tolist(), ends.tolist()):
        text[home : home + end - start] = data[start:end]
        text[home : home + end - start] += 1
        text[home + end - start] = 0
    last = np.zeros(0, np.int64)

    def mark(batch: np.ndarray) -> None:
        nonlocal last
        place = np.append(last, batch["place"])
        long = np.flatnonzero(batch["common"] >= size) + len(last)
        hit[place[long]] = True
        hit[place[long - 1]] = True
        last = place[-1:]

    if len(data):
        induced_sort.induce(text, mark)
    out = induced_sort.scratch(len(data), bool)
    for home, start, end in zip(homes.tolist(), (ends - lengths).tolist(), ends.tolist()):
        out[start:end] = hit[home : home + end - start]
    return out


class Shard:
    """The segments of one shard, their texts in a scratch file."""

    def __init__(self) -> None:
        self.file = induced_sort.tempfile.TemporaryFile()
        self.rows: list[tuple[int, int, int, int]] = []
        self.anchors, self.forms, self.times, self.lengths = [], [], [], []

    def add(self, row: dict) -> None:
        self.file.write(row["texts"])
        self.rows.append((row["block_id"], row["level"], row["bucket"], len(row["times"])))
        for column, kind in (("anchors", np.uint64), ("forms", np.uint64), ("times", np.uint8), ("lengths", np.int32)):
            getattr(self, column).append(np.frombuffer(row[column], kind))

    def answers(self, size: int) -> Iterator[pa.RecordBatch]:
        """For each row, a bit for each window of its segments: is it repeated?"""
        anchors, forms, times, lengths = (np.concatenate(x) for x in (self.anchors, self.forms, self.times, self.lengths))
        lengths = lengths.astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        self.file.flush()
        texts = np.memmap(self.file, np.uint8, "r", shape=(int(lengths.sum()),))
        by = np.lexsort((forms, anchors))
        fresh = np.append(True, (anchors[by][1:] != anchors[by][:-1]) | (forms[by][1:] != forms[by][:-1]))
        text = lambda k: texts[starts[k] : starts[k] + lengths[k]].tobytes()
        for k in np.flatnonzero(~fresh).tolist():
            fresh[k] = text(by[k]) != text(by[k - 1])
        which = np.empty(len(by), np.int64)
        which[by] = np.cumsum(fresh) - 1
        chosen = by[fresh]  # the different segments, each once, by anchor
        often = np.bincount(which, times) > 1
        own = lengths[chosen]
        same = anchors[chosen][1:] == anchors[chosen][:-1]
        several = np.append(False, same) | np.append(same, False)  # the only text of an anchor has none to be sorted with
        sorted_ = np.flatnonzero(several)
        data = induced_sort.scratch(int(own[sorted_].sum()), np.uint8)
        places = np.cumsum(np.where(several, own, 0)) - np.where(several, own, 0)
        for form in sorted_.tolist():
            k, place = chosen[form], places[form]
            data[place : place + lengths[k]] = texts[starts[k] : starts[k] + lengths[k]]
        hit = repeated_windows(data, own[sorted_], size)
        at = 0
        for block, level, bucket, n in self.rows:
            flags = np.concatenate([hit[places[f] : places[f] + own[f] - size + 1] if several[f] and not often[f] else np.full(own[f] - size + 1, often[f]) for f in which[at : at + n].tolist()])
            at += n
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([level], pa.int32()), pa.array([bucket], pa.int32()), pa.array([np.packbits(flags).tobytes()], pa.binary())], ["block_id", "level", "bucket", "mask"])
        self.file.close()


def _sort(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come shard by shard."""
        sole(_tables)
        now, shard = None, None
        for batch in batches:
            for k in range(batch.num_rows):
                row = {name: batch.column(name)[k].as_py() for name in batch.schema.names}
                if row["shard"] != now:
                    if shard is not None:
                        yield from shard.answers(size)
                    now, shard = row["shard"], Shard()
                shard.add(row)
        if shard is not None:
            yield from shard.answers(size)

    return run


def _remove(size: int, ranges: int, levels: int, carry: bool):
    names = ["doc_id", "n_bytes", "n_removed", "spans", "kept"]
    kinds = (pa.int64(), pa.int64(), pa.int64(), SPAN, pa.binary())

    def gone_bytes(texts: list[bytes], masks: list[dict] | None, answers: list[dict] | None) -> tuple[np.ndarray, np.ndarray]:
        told = Told(texts, size, masks, ranges, levels)
        data = told.levels[0][0].data
        hit = np.zeros(len(data) + 1, bool)  # windows, by start
        for level, (own, edges, send, copy) in enumerate(told.levels):
            if copy.any():
                hit[:-1] |= own.windows_of(copy)
            counts = own.counts[own.first] if len(own.first) else np.zeros(0, np.int64)
            flags = np.zeros(int(counts.sum()), bool)  # of the windows of all forms, one after another
            ends = np.cumsum(counts)
            for m in answers or ():
                if m["level"] == level:
                    forms = edges[m["bucket"]] + np.flatnonzero(send[edges[m["bucket"]] : edges[m["bucket"] + 1]])
                    n = counts[forms]
                    at = np.arange(int(n.sum())) + np.repeat(ends[forms] - n - (np.cumsum(n) - n), n)
                    flags[at] = np.unpackbits(np.frombuffer(m["mask"], np.uint8), count=len(at)).astype(bool)
            if flags.any():
                some = np.flatnonzero(send[own.which])
                n = own.counts[some]
                step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                form = np.repeat(own.which[some], n)
                hit[(np.repeat(own.starts[some], n) + step)[flags[ends[form] - counts[form] + step]]] = True
        places = np.flatnonzero(hit)
        change = np.zeros(len(data) + 1, np.int64)
        change[places] += 1
        change[places + size] -= 1
        return data, np.cumsum(change)[:-1] > 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                texts = batch.column("texts")[k].as_py()
                data, gone = gone_bytes(texts, *(batch.column(c)[k].as_py() for c in ("masks", "answers")))
                rows, at = [], 0
                for doc, text in zip(batch.column("doc_ids")[k].as_py(), texts):
                    flags = gone[at : at + len(text)]
                    spans = runs(flags) if flags.any() else []
                    if carry:
                        kept = whole_characters(text, spans)
                    else:
                        kept = data[at : at + len(text)][~flags].tobytes() if spans else text
                    rows.append((doc, len(text), int(flags.sum()), [{"start": s, "length": n} for s, n in spans], kept))
                    at += len(text)
                rest = batch.column("rest")[k].values if carry else None
                types = [*kinds[:-1], pa.string()] if carry else kinds
                for a in range(0, len(rows), 2000):
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows[a : a + 2000]), types)]
                    yield pa.RecordBatch.from_arrays([*columns, *([rest.slice(a, 2000)] if carry else [])], [*names, *["rest"] * carry])

    return run


def _by_block(answers: DataFrame, name: str) -> DataFrame:
    return answers.groupBy("block_id").agg(F.collect_list(F.struct("level", "bucket", "mask")).alias(name))


def remove_repeats(docs: DataFrame, size: int = 200, id_column: str = "doc_id", text_column: str = "text", carry: bool = False, hot: int = HOT, shard: int = SHARD) -> DataFrame:
    """A RESULT row for each document: the removed spans and the bytes that stay.

    ``carry``: ``kept`` is a string (spans are first shrunk to whole characters), and all other
    columns of ``docs`` come along in the struct ``rest``. ``hot``: different segments of an anchor
    beyond which its windows get longer anchors; ``shard``: bytes of segments that a shard should hold.
    """
    spark = docs.sparkSession
    table = in_blocks(docs, ordered=False, id_column=id_column, text_column=text_column, carry=carry)
    total = text_bytes(table) // 2  # of names: a segment's two for about fifty bytes of text, with room
    ranges = hash_ranges(spark, total)
    every, codes, told = None, None, table
    for level in range(len(anchor_sizes(size))):
        asked = dealt(told.mapInArrow(_ask(size, ranges, level), ASKED), total)
        codes = keep(asked.groupBy("bucket").applyInArrow(_settle(level, hot), CODES), "codes")
        every = codes if every is None else every.unionByName(codes)
        if not codes.where("hot").limit(1).count():
            break
        of_hot = every.join(codes.where("hot").select("block_id").distinct(), "block_id", "left_semi")
        told = table.join(_by_block(of_hot, "masks").hint("shuffle_hash"), "block_id")
    levels = level + 1
    told = table.join(_by_block(every, "masks").hint("shuffle_hash"), "block_id", "left")
    sent = keep(told.mapInArrow(_send(size, ranges, levels), SENT), "sent")
    volume = sent.agg(F.sum("n_bytes")).first()[0] or 0
    shards = min(ranges, max(spark.sparkContext.defaultParallelism, -(-volume // shard)))
    placed = sent.withColumn("shard", F.floor(F.col("bucket").cast("long") * shards / ranges).cast("int")).repartitionByRange(shards, "shard").sortWithinPartitions("shard")
    answers = _by_block(placed.mapInArrow(_sort(size), ANSWERS), "answers")
    final = told.join(answers.hint("shuffle_hash"), "block_id", "left")
    schema = RESULT
    if carry:
        schema = RESULT.replace("kept binary", "kept string") + f", rest {table.schema['rest'].dataType.elementType.simpleString()}"
    return final.mapInArrow(_remove(size, ranges, levels, carry), schema)


def without_repeats(docs: DataFrame, size: int = 200) -> DataFrame:
    """The documents without repeated strings, in the columns of ``docs``; those left without a word go."""
    found = remove_repeats(docs, size, carry=True)
    columns = [F.col("kept").alias(c) if c == "text" else F.col(f"rest.`{c}`").alias(c) for c in docs.columns]
    left = found.where(F.col("kept").rlike(r"[^\x20\x09-\x0D]")).select(*columns)
    return left.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else left


def whole_characters(text: bytes, spans: list[tuple[int, int]]) -> str:
    """The text without its spans, each first shrunk to whole UTF-8 characters."""
    out, at = [], 0
    for start, length in spans:
        end = start + length
        while start < end and text[start] & 0xC0 == 0x80:
            start += 1
        while end > start and end < len(text) and text[end] & 0xC0 == 0x80:
            end -= 1
        out.append(text[at:start])
        at = end
    return b"".join([*out, text[at:]]).decode("utf-8", "replace")


ORACLE = r"""
WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS m
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 199)) AS i FROM bytes)
), repeated AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY m) > 1),
marked AS (SELECT doc_id, i, coalesce(i > lag(i) OVER w + 200, true) AS fresh FROM repeated WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
numbered AS (SELECT doc_id, i, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM marked),
spans AS (SELECT doc_id, min(i) AS s, max(i) + 200 AS e FROM numbered GROUP BY doc_id, g),
gaps AS (SELECT doc_id, s, e, coalesce(lag(e) OVER w, 0) AS before FROM spans WINDOW w AS (PARTITION BY doc_id ORDER BY s)),
cut AS (
  SELECT b.doc_id, any_value(b.h) AS h, coalesce(max(e), 0) AS last, coalesce(sum(e - s), 0) AS n_removed, count(s) AS n_spans,
         coalesce(string_agg(substr(b.h, 2 * before + 1, 2 * (s - before)), '' ORDER BY s), '') AS head
  FROM bytes b LEFT JOIN gaps USING (doc_id) GROUP BY b.doc_id
)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, n_removed::BIGINT AS n_removed, n_spans::BIGINT AS n_spans,
       sha256(unhex(head || substr(h, 2 * last + 1))) AS kept_sha256
FROM cut"""
