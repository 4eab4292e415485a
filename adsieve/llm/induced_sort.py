"""Suffix order and common prefixes by external induced sorting.

The text is a sequence of symbols; symbol 0 is a separator, and separators differ from each other
and are ordered by their place, so no common prefix passes one. As in SA-IS, suffixes are L (larger
than their successor) or S; S* suffixes are S suffixes after an L suffix.

1. The substrings between neighbouring S* places are sorted and named in order, by dividing them
   by their next symbols until a part fits in memory.
2. The sequence of names, at most half as long, is sorted in the same way, by recursion; once it
   has no more than ``base`` names, by prefix doubling in memory.
3. From the sorted S* suffixes all L suffixes are induced in ascending order, and from those all S
   suffixes in descending order. Suffixes to come wait in a priority queue keyed by their first
   symbol and filled in order. An entry carries its place and the length of the prefix that it has
   in common with the entry before it under the same symbol: one more than the least value between
   the two suffixes that induced them.

A pass takes a frequent symbol's entries some at a time, and many rare symbols together as long as
none of their entries induces another one among them, so that both short and long alphabets move in
large steps. The queue keeps ``limit`` bytes in memory and the rest in a scratch file. Whatever is
as long as the text (places, names, sorted S* and L suffixes, figures of each symbol) lies in
scratch files as well and is worked on STEP items at a time; the text, which is looked up one
symbol back, may be a memory map. Scratch files have no name and vanish with the task, as Spark's
own spill files do. So memory is bounded by ``base``, ``limit`` and STEP, not by the text.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from itertools import chain, repeat

import numpy as np

ENTRY = np.dtype([("place", np.int64), ("common", np.int64)])
#: Items handled at a time.
STEP = 1 << 19
#: Bytes of a queue held in memory, and of an array above which it lies in a file.
LIMIT = 16 << 20
#: Names up to which they are sorted in memory.
BASE = 1 << 20
#: Into how many parts of about equal weight a pass deals symbols, and what they should weigh at least.
PARTS, LEAST = 512, 4096
FAR = np.iinfo(np.int64).max

Emit = Callable[[np.ndarray], None]


def scratch(n: int, kind, fill: int | None = None, limit: int | None = None) -> np.ndarray:
    """An array in memory if it is short, else in a file without name."""
    limit = LIMIT if limit is None else limit
    if n * np.dtype(kind).itemsize <= limit:
        out = np.empty(n, kind)
    else:
        with tempfile.TemporaryFile() as file:
            file.truncate(n * np.dtype(kind).itemsize)
            out = np.memmap(file, kind, "r+", shape=(n,))
    if fill is not None:
        for a in range(0, n, STEP):
            out[a : a + STEP] = fill
    return out


class Tape:
    """Entries written one after another and then read as an array."""

    def __init__(self, limit: int | None = None) -> None:
        self.limit, self.parts, self.held, self.count, self.file = LIMIT if limit is None else limit, [], 0, 0, None

    def write(self, entries_: np.ndarray) -> None:
        self.parts.append(entries_)
        self.held += entries_.nbytes
        self.count += len(entries_)
        if self.held > self.limit:
            self.file = self.file or tempfile.TemporaryFile()
            self._flush()

    def _flush(self) -> None:
        for part in self.parts:
            self.file.write(np.ascontiguousarray(part).data)
        self.parts, self.held = [], 0

    def read(self) -> np.ndarray:
        if self.file is None:
            return joined(self.parts)
        self._flush()
        self.file.flush()
        with self.file:
            return np.memmap(self.file, ENTRY, "r", shape=(self.count,))


class DiskQueue:
    """A priority queue of entries by symbol, or part of the symbols; entries of one leave in the order they came."""

    def __init__(self, limit: int | None = None) -> None:
        self.limit, self.held = LIMIT if limit is None else limit, 0
        self.parts: dict[int, list] = {}
        self.file = None

    def push(self, symbol: int, entries: np.ndarray) -> None:
        self.parts.setdefault(symbol, []).append(entries)
        self.held += entries.nbytes
        if self.held > self.limit:
            self._spill()

    def _spill(self) -> None:
        """Move all that is in memory to the end of the file, a run for each symbol."""
        self.file = self.file or tempfile.TemporaryFile()
        for parts in self.parts.values():
            at = next((k for k, p in enumerate(parts) if isinstance(p, np.ndarray)), len(parts))
            if at < len(parts):
                run = joined(parts[at:])
                self.file.seek(0, 2)
                where = self.file.tell()
                run.tofile(self.file)
                parts[at:] = [(where, len(run))]
        self.held = 0

    def pop(self, symbol: int) -> Iterator[np.ndarray]:
        """Take out the entries that wait under a symbol now, some at a time."""
        held, count = [], 0
        for part in self.parts.pop(symbol, ()):
            if isinstance(part, np.ndarray):
                self.held -= part.nbytes
                pieces = (part[k : k + STEP] for k in range(0, len(part), STEP))
            else:
                pieces = self._stored(*part)
            for piece in pieces:
                if held and count + len(piece) > STEP:
                    yield joined(held)
                    held, count = [], 0
                held.append(piece)
                count += len(piece)
        if held:
            yield held[0] if len(held) == 1 else joined(held)

    def _stored(self, where: int, count: int) -> Iterator[np.ndarray]:
        for k in range(0, count, STEP):
            self.file.seek(where + k * ENTRY.itemsize)
            yield np.fromfile(self.file, ENTRY, min(STEP, count - k))

    def close(self) -> None:
        self.parts.clear()
        if self.file:
            self.file.close()


def joined(parts: list[np.ndarray]) -> np.ndarray:
    """Entries laid end to end, as plain numbers, which is much faster for many short parts."""
    return np.concatenate([np.empty(0, np.int64), *(np.ascontiguousarray(p).view(np.int64) for p in parts)]).view(ENTRY)


def entries(places: np.ndarray, common: np.ndarray) -> np.ndarray:
    out = np.empty(len(places), ENTRY)
    out["place"], out["common"] = places, common
    return out


def stable_order(keys: np.ndarray) -> np.ndarray:
    """Stable argsort of keys from 0 on. Keys joined with their places are sorted as plain numbers, which is far faster."""
    bits = max(1, len(keys) - 1).bit_length()
    if not len(keys) or int(keys.max()) >= 1 << (62 - bits):
        return np.argsort(keys, kind="stable")
    return np.sort(keys.astype(np.int64) << bits | np.arange(len(keys))) & ((1 << bits) - 1)


def range_minimum(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least of values[low:high + 1] for each query, by tables of doubled width."""
    width = np.frexp((high - low + 1).astype(float))[1] - 1
    out = np.empty(len(low), values.dtype)
    table = values
    for k in range(int(width.max(initial=-1)) + 1):
        if k:
            table = np.minimum(table[: -(1 << (k - 1))], table[1 << (k - 1) :])
        at = np.flatnonzero(width == k)
        if len(at):
            out[at] = np.minimum(table[low[at]], table[high[at] - (1 << k) + 1])
    return out


def run_lengths(text: np.ndarray, places: np.ndarray) -> np.ndarray:
    """How many equal symbols stand from each of some places on."""
    out = np.ones(len(places), np.int64)
    live, own = np.arange(len(places)), text[places]
    while len(live) > 8 or (len(live) and out[live].max() < 64):
        at = places[live] + out[live]
        same = (at < len(text)) & (text[np.minimum(at, len(text) - 1)] == own[live])
        live = live[same]
        out[live] += 1
    for k in live.tolist():  # few long runs
        at = int(places[k] + out[k])
        while at < len(text):
            differ = np.flatnonzero(text[at : at + STEP] != own[k])
            at += int(differ[0]) if len(differ) else len(text[at : at + STEP])
            if len(differ):
                break
        out[k] = at - places[k]
    return out


class Pass:
    """One pass of induction, upwards (L suffixes) or downwards (S suffixes) through the symbols.

    ``cuts``: the first symbol of each part, and the end. ``fixed(part)`` gives the suffixes of a part that are known
    beforehand, in the order of the pass, each with the prefix it has in common with the one before; under each symbol
    they come after the induced ones. ``emit`` takes the induced suffixes and, if ``both``, the fixed ones too.
    """

    def __init__(self, text: np.ndarray, cuts: np.ndarray, up: bool, fixed: Callable[[int], Iterator[np.ndarray]], emit: Emit, both: bool, limit: int) -> None:
        self.text, self.cuts, self.up, self.fixed, self.emit, self.both = text, cuts, up, fixed, emit, both
        self.queue = DiskQueue(limit)
        symbols = int(cuts[-1])
        self.turn = scratch(symbols, np.int64, -1)  # the step in which each symbol got its last entry
        self.rest = scratch(symbols, np.int64, FAR)  # least common prefix after that entry, to the end of that step
        self.step, self.marks, self.least = 0, [], []  # later steps: the least common prefix from a mark to now rises from mark to mark

    def _since(self, symbol: np.ndarray) -> np.ndarray:
        """Least common prefix since each symbol's last entry; -1: none yet."""
        turn = self.turn[symbol]
        out = np.asarray(self.rest[symbol]).copy()
        if self.marks:
            k = np.searchsorted(np.array(self.marks), turn, side="right")
            later = np.array([*self.least, FAR])
            out = np.minimum(out, later[k])
        return np.where(turn < 0, -1, out)

    def feed(self, place: np.ndarray, common: np.ndarray, first: np.ndarray, strict: np.ndarray | bool) -> None:
        """Process suffixes in order; ``first``: their symbols; ``strict``: which ones induce no equal symbol."""
        if not len(place):
            return
        before = np.where(place > 0, self.text[np.maximum(place, 1) - 1], 0).astype(first.dtype)
        ahead = (before > first) if self.up else (before < first)
        fit = np.flatnonzero((before > 0) & (ahead | ((before == first) & ~np.asarray(strict))))
        lowest = int(common.min())
        if len(fit):
            symbol = before[fit]
            by = stable_order(symbol)
            fit, symbol = fit[by], symbol[by].astype(np.int64)
            head = np.append(True, symbol[1:] != symbol[:-1])
            low = np.where(head, 0, np.append(0, fit[:-1] + 1))
            least = range_minimum(common, low, fit)
            heads = np.flatnonzero(head)
            earlier = self._since(symbol[heads])
            least[heads] = np.where(earlier < 0, -1, np.minimum(earlier, least[heads]))
            made = entries(place[fit] - 1, least + 1)
            tails = np.append(heads[1:], len(fit)) - 1
            after = fit[tails] + 1
            rest = np.full(len(tails), FAR)
            inside = after < len(common)
            rest[inside] = np.minimum.accumulate(common[::-1])[::-1][after[inside]]
            self.turn[symbol[heads]], self.rest[symbol[heads]] = self.step, rest
            part = np.searchsorted(self.cuts, symbol[heads], side="right") - 1
            starts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
            for k, a, b in zip(part[starts].tolist(), heads[starts].tolist(), [*heads[starts[1:]].tolist(), len(fit)]):
                self.queue.push(k, made[a:b])
        while self.least and self.least[-1] >= lowest:
            self.least.pop()
            self.marks.pop()
        self.least.append(lowest)
        self.marks.append(self.step)
        self.step += 1

    def run(self) -> None:
        parts = range(len(self.cuts) - 1)
        for part in parts if self.up else reversed(parts):
            if self.cuts[part + 1] - self.cuts[part] == 1:
                self._one_symbol(part, int(self.cuts[part]))
            else:
                self._many_symbols(part)
        self.queue.close()

    def _one_symbol(self, part: int, symbol: int) -> None:
        last = None
        while part in self.queue.parts:
            for batch in self.queue.pop(part):
                last = batch["place"][-1:]
                self.emit(batch)
                self._feed_one(batch, symbol, False)
        for batch in self.fixed(part):
            if last is not None and len(batch):
                batch = batch.copy()
                batch["common"][0] = run_lengths(self.text, np.append(last, batch["place"][0])).min()
                last = None
            if self.both:
                self.emit(batch)
            self._feed_one(batch, symbol, True)

    def _feed_one(self, batch: np.ndarray, symbol: int, strict: bool) -> None:
        place = batch["place"]
        self.feed(place, batch["common"], np.full(len(place), symbol, np.int64), strict)

    def _sorted(self, batch: np.ndarray) -> np.ndarray:
        return batch[stable_order(self._keys(batch["place"]))]

    def _keys(self, place: np.ndarray) -> np.ndarray:
        """Symbols, counted from the pass's last one if it goes down."""
        symbol = self.text[place].astype(np.int64)
        return symbol if self.up else int(self.cuts[-1]) - symbol

    def _many_symbols(self, part: int) -> None:
        wait = self._sorted(joined(list(self.queue.pop(part))))
        known = joined(list(self.fixed(part)))
        while len(wait) or len(known):
            every = joined([wait, known])
            is_known = np.arange(len(every)) >= len(wait)
            key = self._keys(every["place"])
            by = stable_order(2 * key + is_known)
            every, is_known, key = every[by], is_known[by], key[by]
            place = every["place"]
            before = np.where(place > 0, self.text[np.maximum(place, 1) - 1], 0).astype(np.int64)
            induced = before if self.up else int(self.cuts[-1]) - before
            target = np.where((before > 0) & ((induced > key) | ((induced == key) & ~is_known)), induced, FAR)
            clash = np.flatnonzero(np.minimum.accumulate(target) <= key)
            n = int(np.searchsorted(key, key[clash[0]])) if len(clash) else len(every)
            if n:
                self._take(every[:n], key[:n], is_known[:n])
            else:  # the first symbol stands before itself: its induced entries come in rounds
                n = int(np.searchsorted(key, key[0], side="right"))
                self._alone(part, every[:n][~is_known[:n]], every[:n][is_known[:n]], int(self.text[place[0]]))
            wait, known = every[n:][~is_known[n:]], every[n:][is_known[n:]]
            fresh = list(self.queue.pop(part))
            if fresh:
                wait = self._sorted(joined([wait, *fresh]))

    def _take(self, every: np.ndarray, key: np.ndarray, is_known: np.ndarray) -> None:
        """Whole symbols in order, none of which induces into another."""
        border = np.flatnonzero(is_known[1:] & ~is_known[:-1] & (key[1:] == key[:-1])) + 1
        if len(border):
            runs = run_lengths(self.text, every["place"][np.append(border - 1, border)])
            every["common"][border] = np.minimum(runs[: len(border)], runs[len(border) :])
        self.emit(every if self.both else every[~is_known])
        self.feed(every["place"], every["common"], key if self.up else int(self.cuts[-1]) - key, is_known)

    def _alone(self, part: int, induced: np.ndarray, known: np.ndarray, symbol: int) -> None:
        last, others = None, []
        while len(induced):
            last = induced["place"][-1:]
            self.emit(induced)
            self._feed_one(induced, symbol, False)
            fresh = joined(list(self.queue.pop(part)))
            own = self.text[fresh["place"]] == symbol
            others.append(fresh[~own])
            induced = fresh[own]
        if len(known):
            if last is not None:
                known["common"][0] = run_lengths(self.text, np.append(last, known["place"][0])).min()
            if self.both:
                self.emit(known)
            self._feed_one(known, symbol, True)
        for other in others[::-1]:  # before what the known ones have pushed since
            if len(other):
                self.queue.parts[part] = [other, *self.queue.parts.get(part, [])]
                self.queue.held += other.nbytes


def _types(text: np.ndarray) -> np.ndarray:
    """1 for S suffixes; a separator is S."""
    n = len(text)
    small = scratch(n, np.uint8)
    carry, follow = 1, 0  # type and symbol of what comes after the chunk
    for a in range((n - 1) // STEP * STEP, -1, -STEP):
        own = np.append(text[a : a + STEP], follow)
        here, after = own[:-1], own[1:]
        less, differ = (here < after) | (here == 0), (here != after) | (here == 0)
        at = np.append(np.flatnonzero(differ), len(here))
        kinds = np.append(less[differ], bool(carry))
        part = kinds[np.searchsorted(at, np.arange(len(here)))]
        small[a : a + len(here)] = part
        carry, follow = int(part[0]), int(here[0])
    return small


def _stars(text: np.ndarray, small: np.ndarray) -> np.ndarray:
    """The S* places; every separator is one."""
    found = []
    for a in range(0, len(text), STEP):
        own = small[a : a + STEP]
        before = np.append(small[a - 1] if a else 1, own[:-1])
        found.append(a + np.flatnonzero((own == 1) & ((before == 0) | (text[a : a + STEP] == 0))))
    out = scratch(sum(map(len, found)), np.int64)
    at = 0
    for part in found:
        out[at : at + len(part)] = part
        at += len(part)
    return out


class Names:
    """Names of the substrings from each S* place to the next, in their order; separators' own come first."""

    def __init__(self, text: np.ndarray, small: np.ndarray, star: np.ndarray, room: int) -> None:
        self.text, self.small, self.star, self.room = text, small, star, room
        top = max((int(text[a : a + STEP].max()) for a in range(0, len(text), STEP)), default=0)
        self.bits = (2 * top + 2).bit_length()  # of a symbol with its type
        self.units = max(1, min(6, 62 // self.bits))
        self.names = scratch(len(star), np.int64)
        self.kinds = 0
        rest = []
        for a in range(0, len(star), STEP):
            zero = text[star[a : a + STEP]] == 0
            own = self.names[a : a + STEP]
            own[zero] = self.kinds + np.arange(int(zero.sum()))
            self.kinds += int(zero.sum())
            rest.append(a + np.flatnonzero(~zero))
        which = scratch(sum(map(len, rest)), np.int64)
        at = 0
        for part in rest:
            which[at : at + len(part)] = part
            at += len(part)
        self._divide(which, 0)

    def _keys(self, which: np.ndarray, offset: int) -> np.ndarray:
        """Some symbols with their types from an offset on, 0 beyond the end (both ends belong to a substring)."""
        start = self.star[which] + offset
        end = self.star[np.minimum(which + 1, len(self.star) - 1)]
        end = np.where(which + 1 < len(self.star), end, len(self.text) - 1)
        key = np.zeros(len(which), np.int64)
        for k in range(self.units):
            at = np.minimum(start + k, len(self.text) - 1)
            unit = 2 * self.text[at].astype(np.int64) + self.small[at] + 1
            key = (key << self.bits) | np.where(start + k <= end, unit, 0)
        return key

    def _divide(self, which: np.ndarray, offset: int) -> None:
        """Deal substrings that agree up to an offset by their next symbols until parts fit in memory."""
        if len(which) <= self.room:
            self._settle(np.asarray(which), offset)
            return
        drawn = np.unique(self._keys(which[np.linspace(0, len(which) - 1, 4096).astype(np.int64)], offset))
        drawn = drawn[:: max(1, len(drawn) // 64)]
        edges = np.unique(np.concatenate([drawn, drawn + 1]))
        counts = np.zeros(len(edges) + 1, np.int64)
        for a in range(0, len(which), STEP):
            counts += np.bincount(np.searchsorted(edges, self._keys(which[a : a + STEP], offset), side="right"), minlength=len(counts))
        dealt, at = scratch(len(which), np.int64), np.cumsum(counts) - counts
        spot = at.copy()
        for a in range(0, len(which), STEP):
            own = which[a : a + STEP]
            part = np.searchsorted(edges, self._keys(own, offset), side="right")
            by = np.argsort(part, kind="stable")
            where = np.repeat(spot - (np.cumsum(n := np.bincount(part, minlength=len(counts))) - n), n) + np.arange(len(own))
            dealt[where] = own[by]
            spot += n
        single = np.append(False, np.append(edges[1:] == edges[:-1] + 1, False))
        for k in np.flatnonzero(counts).tolist():
            part = dealt[at[k] : at[k] + counts[k]]
            if single[k] and edges[k - 1] & ((1 << self.bits) - 1) == 0:  # all of them end here
                for a in range(0, len(part), STEP):
                    self.names[part[a : a + STEP]] = self.kinds
                self.kinds += 1
            else:
                self._divide(part, offset + self.units * bool(single[k]))

    def _settle(self, which: np.ndarray, offset: int) -> None:
        if not len(which):
            return
        rank, live, start_at = np.zeros(len(which), np.int64), np.arange(len(which)), offset
        while len(live):
            key = self._keys(which[live], offset)
            order = np.lexsort((key, rank[live])) if offset > start_at else np.argsort(key)
            r, v = rank[live][order], key[order]
            old = np.append(True, r[1:] != r[:-1])
            fresh = old | np.append(True, v[1:] != v[:-1])
            where = np.arange(len(live))
            group, start = (np.maximum.accumulate(np.where(f, where, 0)) for f in (fresh, old))
            rank[live[order]] = r + group - start
            offset += self.units
            size = np.bincount(np.cumsum(fresh) - 1)
            open_ = np.repeat(size > 1, size) & (v & ((1 << self.bits) - 1) != 0)
            live = live[np.sort(order[open_])]
        distinct, inverse = np.unique(rank, return_inverse=True)
        self.names[which] = self.kinds + inverse
        self.kinds += len(distinct)


def _doubled(names: np.ndarray) -> np.ndarray:
    """Sorted places of a sequence in memory, by prefix doubling of those whose rank is still shared."""
    n = len(names)
    order = np.argsort(names, kind="stable")
    sorted_ = names[order]
    head = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1]))
    size = np.diff(np.append(head, n))
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(head, size)  # of equals, the first place in the order
    spots = np.flatnonzero(np.repeat(size > 1, size))  # places of the order that aren't settled
    step = 1
    while len(spots):
        live = order[spots]
        own = rank[live]
        after = np.where(live + step < n, rank[np.minimum(live + step, n - 1)] + 1, 0)
        by = np.argsort(own * (n + 1) + after)
        live, own, after = live[by], own[by], after[by]
        order[spots] = live
        fresh = np.append(True, (own[1:] != own[:-1]) | (after[1:] != after[:-1]))
        head = np.flatnonzero(fresh)
        size = np.diff(np.append(head, len(live)))
        rank[live] = np.repeat(spots[head], size)
        spots = spots[np.repeat(size > 1, size)]
        step *= 2
    return order


def _common(text: np.ndarray, a: np.ndarray, b: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Common prefixes of pairs of suffixes of a text that ends in a separator; ``known`` symbols are known to agree."""
    out = known.copy()
    live = np.arange(len(a))
    widths = chain((1, 2, 4, 8), repeat(16))
    while len(live):
        width, held = next(widths), []
        reach = np.arange(width)
        for k in range(0, len(live), max(1, STEP // width)):
            own = live[k : k + max(1, STEP // width)]
            shared = out[own]
            left, right = (np.take(text, (c[own] + shared)[:, None] + reach, mode="clip") for c in (a, b))  # the last symbol is a separator
            differ = (left != right) | (left == 0)
            first = differ.argmax(axis=1)
            found = differ[np.arange(len(own)), first]
            out[own] = shared + np.where(found, first, width)
            held.append(own[~found])
        live = np.concatenate(held)
    return out


def _sorted_stars(text: np.ndarray, base: int, limit: int) -> np.ndarray:
    """The S* places in suffix order, each with the prefix it has in common with the one before."""
    small = _types(text)
    star = _stars(text, small)
    named = Names(text, small, star, max(base, 1))
    names, n = named.names, len(star)
    if named.kinds == n:
        order, same = scratch(n, np.int64), None
        for a in range(0, n, STEP):
            order[names[a : a + STEP]] = np.arange(a, min(n, a + STEP))
    elif n <= base:
        names = np.asarray(names)
        order = _doubled(names)
        ended = np.append(names + 1, 0).astype(np.int32 if n < 1 << 31 else np.int64)
        same = np.append(0, _common(ended, order[:-1], order[1:], np.zeros(n - 1, np.int64)))
    else:  # names of separators are all different, so one separator at the end suffices
        reduced = scratch(n + 1, np.int32 if named.kinds < 1 << 31 else np.int64)
        for a in range(0, n, STEP):
            reduced[a : min(n, a + STEP)] = names[a : a + STEP] + 1
        reduced[n] = 0
        tape = Tape(limit)
        induce(reduced, tape.write, base, limit)
        down = tape.read()[:n]  # largest first, each with what it shares with the one before; the separator comes last
        order, same = scratch(n, np.int64), scratch(n, np.int64)
        for a in range(0, n, STEP):
            part = down[a : a + STEP]
            order[n - a - len(part) : n - a] = part["place"][::-1]
            upper = part["common"][::-1]
            to = n - a - len(part) + 1  # what an entry shares with the next larger one belongs to that one
            same[to : min(n, to + len(part))] = upper[: min(n, to + len(part)) - to]
        same[0] = 0
    out = scratch(n, ENTRY)
    last = len(star) - 1
    for a in range(0, n, STEP):
        own = np.asarray(order[a : a + STEP])
        places = star[own]
        out["place"][a : a + STEP] = places
        left = np.append(star[order[a - 1]] if a else places[0], places[:-1])
        shared = np.zeros(len(own), np.int64) if same is None else np.asarray(same[a : a + STEP])
        k = own + shared
        ends = np.where(k <= last, star[np.minimum(k, last)], len(text))
        common = _common(text, left, places, np.where(shared > 0, np.minimum(ends, star[np.minimum(k, last)]) - places, 0))
        if not a:
            common[:1] = 0
        out["common"][a : a + STEP] = common
    return out


def _parts(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First symbols of parts of about equal weight, the separator and every frequent symbol alone; and all symbols' counts."""
    counts = np.zeros(1, np.int64)
    for a in range(0, len(text), STEP):
        own = np.bincount(text[a : a + STEP])
        if len(own) > len(counts):
            counts = np.append(counts, np.zeros(len(own) - len(counts), np.int64))
        counts[: len(own)] += own
    share = max(1, min(max(len(text) // PARTS, LEAST), STEP))
    heavy = np.flatnonzero(counts >= share)
    light = np.cumsum(np.where(counts < share, counts, 0)) // share
    steps = np.flatnonzero(light[1:] != light[:-1]) + 1
    cuts = np.unique(np.concatenate([[0, 1, len(counts)], heavy, heavy + 1, steps]))
    return cuts[cuts <= len(counts)], counts


def induce(text: np.ndarray, emit: Emit, base: int | None = None, limit: int | None = None) -> None:
    """Hand over all suffixes, largest first, each with the prefix that it has in common with the one before.

    ``text`` must end in a separator (0). ``base``: up to how many names are sorted in memory;
    ``limit``: bytes of a queue held in memory.
    """
    base, limit = BASE if base is None else base, LIMIT if limit is None else limit
    if len(text) == 1:
        emit(entries(np.zeros(1, np.int64), np.zeros(1, np.int64)))
        return
    seeds = _sorted_stars(text, base, limit)
    cuts, counts = _parts(text)
    starts = np.zeros(len(counts) + 1, np.int64)
    for a in range(0, len(seeds), STEP):
        own = np.bincount(text[seeds["place"][a : a + STEP]], minlength=len(counts))
        starts[1:] += own
    starts = np.cumsum(starts)[cuts]

    def stars(part: int) -> Iterator[np.ndarray]:
        for a in range(int(starts[part]), int(starts[part + 1]), STEP):
            batch = np.array(seeds[a : min(int(starts[part + 1]), a + STEP)])
            if a == starts[part]:
                batch["common"][0] = 0
            yield batch

    tape, ends = Tape(limit), np.zeros(len(cuts), np.int64)

    def keep_larger(batch: np.ndarray) -> None:
        tape.write(batch.copy())
        first = int(np.searchsorted(cuts, int(text[batch["place"][0]]), side="right")) if len(batch) else 0
        if len(batch):
            ends[first] += len(batch)

    Pass(text, cuts, True, stars, keep_larger, False, limit).run()
    larger, ends = tape.read(), np.cumsum(ends)

    def downwards(part: int) -> Iterator[np.ndarray]:
        if not part:  # separators are their own order
            return
        low, high = int(ends[part]), int(ends[part + 1])
        above = 0
        for b in range(high, low, -STEP):
            own = np.array(larger[max(low, b - STEP) : b])[::-1]
            shared = own["common"].copy()
            own["common"] = np.append(above, shared[:-1])
            above = shared[-1]
            yield own

    Pass(text, cuts, False, downwards, emit, True, limit).run()
    for b in range(len(text), 0, -STEP):
        a = max(0, b - STEP)
        zero = (a + np.flatnonzero(text[a:b] == 0))[::-1]
        if len(zero):
            emit(entries(zero, np.zeros(len(zero), np.int64)))


def suffix_array(text: np.ndarray, base: int | None = None, limit: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Places of all suffixes in order, and the prefix that each has in common with the one before, in memory."""
    text = np.asarray(text)
    tape = Tape(limit)
    induce(text.astype(np.int32 if len(text) < 1 << 31 else np.int64), tape.write, base, limit)
    down = tape.read()
    return down["place"][::-1].copy(), np.append(0, down["common"][::-1][:-1])
