"""N-gram Jaccard join by token-combination prefixes.

A document's set is its distinct word shingles, as 64-bit hashes. Sets that are equal form one
class; the join runs between classes. Tokens have a global order: rarer first, by counts of all
documents in a table of fixed size (an upper bound of each token's count; only the order depends
on it, not the result). Two sets of Jaccard similarity 0.9 share their first common token in the
first p = n - ceil(0.9 n) + 1 tokens of both.

* A rare token of that prefix is a signature by itself.
* If the prefix reaches frequent tokens, it is extended by g tokens, and the frequent tokens fall
  into g classes by hash. Sets whose common tokens are all frequent share at least 1 + g tokens of
  the extended prefixes, so two of them in one class: each pair of frequent tokens in one class is
  a signature. g depends on the size alone (a power of two; a set whose partners may have another g
  gives the signatures for both), and makes the pairs about as many as the prefix tokens.

Candidates are taken in two rounds, so that a large group of copies needs no pair of all its
members. First each class meets the next two of each signature's list, which has one of a few hash orders, so
that the lists of one group give different neighbours; verified links join into components. Lists are rows,
dealt in ranges of (signature, order): a list may span several tasks, and none is gathered in one. Then every pair of a list that lies in different components
is a candidate if sizes and histograms of 256 token bins, which bound the difference of two sets from
below, leave room for similarity; only those are sent on, once each, to have their sets compared. Long lists are
dealt in blocks, and each pair of blocks is compared in a place of its own. After that, each
candidate is either in one component or was compared: no link is lost, and none needs listing.

Defined results: null and empty texts have an empty set, linked with nothing; a text of fewer
words than a shingle is one shingle of its own; rows of one doc_id each have a row in the result
and share their class only if their sets are equal; a null doc_id never names a component unless
all of its class are null; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adsieve.llm.blocks import TASK_BYTES, buckets, hash_ranges, mixed
from adsieve.llm.components import components
from adsieve.llm.storage import keep
from adsieve.llm.word_windows import remember_words, window_hashes, word_hashes
from adsieve.llm.words import no_cache

CELLS = 1 << 24
SLICES = 64
BINS = 256
BLOOM = 1 << 25
#: Members of a signature's list that are compared with each other in one place.
LIST_BLOCK = 512
#: Different orders of lists: more give a group more links in the first round, and leave fewer pairs to the second.
ORDERS = 4
#: Mixed lists of a member that are sent with it, to tell which of them emits a pair.
LEAST = 16
_NONE = (1 << 63) - 1
_GROUP = np.uint64(0xD6E8FEB86659FD93)


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text, A-Z in lower case."""
    words = word_hashes(text.lower())
    if not len(words):
        return np.zeros(0, np.uint64)
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(words.tobytes(), seed=len(words))], np.uint64)
    return np.unique(window_hashes(words, size))


def class_id(tokens: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    return int(np.array([xxhash.xxh3_64_intdigest(tokens.tobytes())], np.uint64).view(np.int64)[0])


def cells(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - CELLS.bit_length() + 1)).astype(np.int64)


def histogram(tokens: np.ndarray) -> bytes:
    """Tokens by bin, at most 255 each: no two sets differ less than their histograms."""
    return np.minimum(255, np.bincount((tokens & np.uint64(BINS - 1)).astype(np.int64), minlength=BINS)).astype(np.uint8).tobytes()


def in_slices(table: np.ndarray) -> tuple[pa.Array, pa.Array]:
    return pa.array(range(SLICES), pa.int32()), pa.array([part.tobytes() for part in table.reshape(SLICES, -1)], pa.binary())


def whole(slices: list) -> np.ndarray:
    """A fixed-size table of bytes from its collected slices."""
    return np.frombuffer(b"".join(r["part"] for r in sorted(slices, key=lambda r: r["slice"])), np.uint8)


SURVEY = "doc_id long, n long, cid long, bins binary, slice int, part binary"


def _survey(size: int):
    """Each document's size, class and histogram, and the token counts of the task (up to 255) in slices."""
    names = ["doc_id", "n", "cid", "bins", "slice", "part"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remember_words()
        counts, any_rows = np.zeros(CELLS, np.uint16), False
        for batch in batches:
            ns, cids, bins = [], [], []
            for text in batch.column(1):
                tokens = shingle_set(text.as_py() or b"" if text.is_valid else b"", size)
                np.add.at(counts, cells(tokens), 1)
                ns.append(len(tokens))
                cids.append(class_id(tokens))
                bins.append(histogram(tokens))
            any_rows = any_rows or bool(ns)
            none = pa.nulls(len(ns), pa.int32()), pa.nulls(len(ns), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ns, pa.int64()), pa.array(cids, pa.int64()), pa.array(bins, pa.binary()), *none], names)
        if any_rows:
            none = [pa.nulls(SLICES, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*none, *in_slices(np.minimum(counts, 255, out=counts).astype(np.uint8))], names)

    return run


PART = "slice int, part binary"


def _commonness(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Steps of the summed counts of one slice: four for each doubling."""
    total = np.zeros(CELLS // SLICES, np.int64)
    for batch in batches:
        for part in batch.column("part"):
            total += np.frombuffer(part.as_py(), np.uint8)
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([steps(total).tobytes()], pa.binary())], ["slice", "part"])


def steps(counts: np.ndarray) -> np.ndarray:
    return np.minimum(255, np.ceil(4 * np.log2(np.maximum(counts, 1)))).astype(np.uint8)


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A bitmap of the task's cells, in slices."""
    table = np.zeros(BLOOM // 8, np.uint8)
    for batch in batches:
        cell = batch.column(0).to_numpy()
        np.bitwise_or.at(table, cell >> 3, (1 << (cell & 7)).astype(np.uint8))
    if table.any():
        yield pa.RecordBatch.from_arrays(list(in_slices(table)), ["slice", "part"])


def _united(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = np.zeros(BLOOM // 8 // SLICES, np.uint8)
    for batch in batches:
        for part in batch.column("part"):
            table |= np.frombuffer(part.as_py(), np.uint8)
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([table.tobytes()], pa.binary())], ["slice", "part"])


class Order:
    """The global token order: a step of commonness for each cell, and from which step tokens are frequent."""

    def __init__(self, step: np.ndarray, mean: float) -> None:
        self.step, self.frequent = step, int(steps(np.array([4 * mean + 64]))[0])

    def signatures(self, tokens: np.ndarray, percent: int) -> np.ndarray:
        n = len(tokens)
        need = -(-percent * n // 100)
        prefix = n - need + 1
        step = self.step[cells(tokens)]
        order = np.lexsort((tokens, step))
        own = order[:prefix]
        rare = step[own] <= self.frequent
        out = [tokens[own[rare]]]
        if not rare.all():
            for g in {classes(n, percent), classes(need, percent)}:
                longer = order[: prefix + g]
                common = tokens[longer[step[longer] > self.frequent]]
                where = common % np.uint64(g)
                for k in np.flatnonzero(np.bincount(where.astype(np.int64), minlength=g) > 1):
                    group = common[where == k]
                    a, b = np.triu_indices(len(group), 1)
                    out.append(mixed(group[a] * _GROUP + group[b] + np.uint64(g)))
        return np.unique(np.concatenate(out))


def classes(n: int, percent: int) -> int:
    """Classes of frequent tokens for sets of about ``n`` tokens: the power of two next above their prefix."""
    return 1 << max(0, n - -(-percent * n // 100)).bit_length()


def _index(size: int, percent: int, order, least: int):
    """(signature, cid, size) of each class that a run of documents holds."""

    def flush(held: list[tuple[np.ndarray, int, int]]) -> pa.RecordBatch:
        signatures, lengths = np.concatenate([s for s, _, _ in held]), [len(s) for s, _, _ in held]
        cids, sizes = (np.repeat(np.array([h[k] for h in held], np.int64), lengths) for k in (1, 2))
        return pa.RecordBatch.from_arrays([pa.array(signatures.view(np.int64)), pa.array(cids), pa.array(sizes.astype(np.int32))], ["signature", "cid", "size"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remember_words()
        held, count, seen = [], 0, set()
        for batch in batches:
            for text in batch.column(1):
                tokens = shingle_set(text.as_py() or b"" if text.is_valid else b"", size)
                if len(tokens) < least:
                    continue
                cid = class_id(tokens)
                if cid in seen:
                    continue
                seen.add(cid)
                held.append((order.value.signatures(tokens, percent), cid, len(tokens)))
                count += len(held[-1][0])
                if count > 500_000:
                    yield flush(held)
                    held, count, seen = [], 0, set()
        if count:
            yield flush(held)

    return run


LISTS = "signature long, cid long, size int, next long, after long, cut boolean"


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of lists, from rows ordered by signature, equal ones together: each with the next two of its list.

    Signatures of one class go. The first and the last row of a partition stay, marked ``cut``: their lists may go on
    beyond it. Three rows are held between batches, whatever a list's length.
    """
    no_cache()
    s, c, n = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
    linked, first = False, True
    for batch in chain(batches, [None]):
        if batch is not None:
            s, c, n = (np.concatenate([held, batch.column(name).to_numpy()]) for held, name in ((s, "signature"), (c, "cid"), (n, "size")))
            fresh = np.ones(len(s), bool)
            fresh[1:] = (s[1:] != s[:-1]) | (c[1:] != c[:-1])
            s, c, n = s[fresh], c[fresh], n[fresh]
        ready = len(s) if batch is None else len(s) - 2
        if ready <= 0:
            continue
        one = np.append(s[1:] == s[:-1], False)
        two = np.append(s[2:] == s[:-2], [False, False])[: len(s)]
        cut = np.zeros(len(s), bool)
        cut[0] = first
        cut[-1] |= batch is None
        stays = pa.array((one | np.append(linked, one[:-1]) | cut)[:ready])
        follow = (pa.array(np.roll(c, -k)[:ready], mask=~same[:ready]) for k, same in ((1, one), (2, two)))
        yield pa.RecordBatch.from_arrays([pa.array(s[:ready]), pa.array(c[:ready]), pa.array(n[:ready]), *follow, pa.array(cut[:ready])], ["signature", "cid", "size", "next", "after", "cut"]).filter(stays)
        linked, first = bool(one[ready - 1]), False
        s, c, n = s[ready:], c[ready:], n[ready:]


def _pairs(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Distinct unordered pairs."""
    pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].copy()), pa.array(pairs[:, 1].copy())], ["a", "b"])


#: Lists longer than this, or than a hundred-thousandth of all list rows, are joined in several places; so at most
#: a hundred thousand signatures are broadcast for it, whatever the input.
LONG_LIST = 100_000


def _of_mixed(placed: DataFrame, mixed_lists: DataFrame, long_list: int) -> DataFrame:
    """The members of the mixed lists with their lists' lengths; a long list is salted by class."""
    salts = F.ceil(F.col("k") / long_list)
    long = mixed_lists.where(F.col("k") > long_list).select("signature", salts.alias("salts"))
    salted = placed.join(F.broadcast(long), "signature", "left").withColumn("salt", F.pmod(F.xxhash64("cid"), F.coalesce("salts", F.lit(1).cast("long")))).drop("salts")
    return salted.join(mixed_lists.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))), ["signature", "salt"])


def _in_parts(members: DataFrame, block: int = LIST_BLOCK) -> DataFrame:
    """Deal long lists in blocks: each pair of blocks is a part of its own, so none gathers more than two blocks."""
    blocks = F.ceil(F.col("k") / block)
    own = F.pmod(F.xxhash64("cid"), blocks)
    dealt = members.withColumns({"own": own, "with": F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))})
    low, high = F.least("own", "with"), F.greatest("own", "with")
    side = F.when(low == high, -1).when(F.col("own") == low, 0).otherwise(1).cast("int")
    return dealt.select("signature", "cid", "size", "component", F.xxhash64("signature", low, high).alias("part"), side.alias("side"))


def may_be_similar(x: np.ndarray, y: np.ndarray, total: np.ndarray, percent: int) -> np.ndarray:
    """Do histograms leave room for similarity? ``total``: both sizes together."""
    differ = np.abs(x - y).sum(axis=1)
    return (total + differ) * percent <= 100 * (total - differ)  # union and common, twice, at their best


def _across(percent: int):
    """Pairs of one list that lie in different components and may be similar by their sizes and histograms.

    A part of a list is one block of it with itself (side -1) or two blocks (sides 0 and 1) with each other.
    A pair that several lists hold comes from the least one in both members' ``least`` lists, so once; if they have
    none in common there, from every list.
    """

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        s, c, n, p, d = (rows.column(k).to_numpy() for k in ("part", "cid", "size", "component", "side"))
        g, m = rows.column("signature").to_numpy(), rows.column("least").combine_chunks().flatten().to_numpy().reshape(-1, LEAST)
        h = np.frombuffer(b"".join(rows.column("bins").to_pylist()), np.uint8).reshape(-1, BINS).astype(np.int16)
        by = np.lexsort((c, n, s))
        s, c, n, p, d, h, g, m = s[by], c[by], n[by].astype(np.int64), p[by], d[by], h[by], g[by], m[by]
        starts = np.concatenate([[0], np.flatnonzero(np.diff(s)) + 1, [len(s)]])
        left, right, held = [], [], 0
        for a, b in zip(starts, starts[1:]):
            if (p[a:b] == p[a]).all():
                continue
            reach = np.searchsorted(n[a:b] * percent, n[a:b] * 100, side="right")  # sizes up to n / percent
            for k in range(b - a - 1):
                later = slice(a + k + 1, a + reach[k])
                other = a + k + 1 + np.flatnonzero((p[later] != p[a + k]) & ((d[later] != d[a + k]) | (d[a + k] < 0)))
                other = other[may_be_similar(h[other], h[a + k], n[other] + n[a + k], percent)]
                if len(other):
                    other = other[~(np.isin(m[other], m[a + k]) & (m[other] < g[a])).any(axis=1)]
                left.append(np.full(len(other), c[a + k]))
                right.append(c[other])
                held += len(other)
            if held > 2_000_000:
                yield _pairs(np.concatenate(left), np.concatenate(right))
                left, right, held = [], [], 0
        if held:
            yield _pairs(np.concatenate(left), np.concatenate(right))

    return run


def _sets(size: int, bitmap):
    """(cid, tokens) of the documents whose cell is set in the bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remember_words()
        table = bitmap.value
        for batch in batches:
            cell = batch.column(1).to_numpy()
            hit = np.flatnonzero(table[cell >> 3] >> (cell & 7) & 1)
            for at in range(0, len(hit), 200):
                sets = [shingle_set(t or b"", size) for t in batch.column(0).take(pa.array(hit[at : at + 200])).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(map(class_id, sets), pa.int64()), pa.array([t.tobytes() for t in sets], pa.binary())], ["cid", "tokens"])

    return run


def similar(common: int, a: int, b: int, percent: int) -> bool:
    return 100 * common >= percent * (a + b - common)


def _bounded(percent: int):
    """Drop pairs whose histograms already differ too much."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no_cache()
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, BINS).astype(np.int32) for k in ("a_bins", "b_bins"))
            fine = may_be_similar(x, y, batch.column("a_n").to_numpy() + batch.column("b_n").to_numpy(), percent)
            yield batch.select(["a", "b"]).filter(pa.array(fine))

    return run


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no_cache()
        for batch in batches:
            fine = []
            for x, y in zip(batch.column("a_tokens"), batch.column("b_tokens")):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                fine.append(similar(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), percent))
            yield batch.select(["a", "b"]).filter(pa.array(fine, pa.bool_()))

    return run


def _near(pairs: DataFrame, named: DataFrame, percent: int) -> DataFrame:
    for side in ("a", "b"):
        pairs = pairs.join(named.select(F.col("cid").alias(side), F.col("bins").alias(f"{side}_bins"), F.col("n").alias(f"{side}_n")), side)
    return pairs.select("a", "b", "a_bins", "b_bins", "a_n", "b_n").mapInArrow(_bounded(percent), "a long, b long")


def _links(pairs: DataFrame, named: DataFrame, rows: DataFrame, percent: int, shingle: int) -> DataFrame:
    """The similar ones of the pairs of classes.

    Texts don't move: a bitmap of fixed size tells the scan which documents stand for a class that
    is needed, and only their sets are sent. What its false hits let through, a join drops.
    """
    spark = rows.sparkSession
    near = keep(_near(pairs, named, percent), "near")
    needed = near.select(F.col("a").alias("cid")).union(near.select("b")).distinct()
    stand = needed.join(named, "cid").select(_bloom_cell(F.col("first_id")))
    bitmap = np.zeros(BLOOM // 8, np.uint8)
    if slices := stand.mapInArrow(_bits, PART).groupBy("slice").applyInArrow(_united, PART).collect():
        bitmap = whole(slices)
    scanned = rows.select("text", _bloom_cell(F.col("doc_id"))).mapInArrow(_sets(shingle, spark.sparkContext.broadcast(bitmap)), "cid long, tokens binary")
    sets = keep(scanned.join(needed, "cid", "left_semi").groupBy("cid").agg(F.first("tokens").alias("tokens")), "sets")
    for side in ("b", "a"):
        near = near.join(sets.select(F.col("cid").alias(side), F.col("tokens").alias(f"{side}_tokens")), side)
    return near.select("a", "b", "a_tokens", "b_tokens").mapInArrow(_verify(percent), "a long, b long")


def _bloom_cell(id_column: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("class"), id_column), F.lit(BLOOM))


def join(docs: DataFrame, percent: int = 90, shingle: int = 3, id_column: str = "doc_id", text_column: str = "text", list_block: int = LIST_BLOCK, long_list: int = LONG_LIST) -> DataFrame:
    """(doc_id, n_shingles, component_id): each document's set size and the least doc_id that links reach."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("binary").alias("text"))
    survey = keep(rows.mapInArrow(_survey(shingle), SURVEY), "survey")
    sizes = survey.where("slice IS NULL").select("doc_id", "n", "cid", "bins")
    slices = survey.where("slice IS NOT NULL").select("slice", "part").groupBy("slice").applyInArrow(_commonness, PART).collect()
    tokens = sizes.agg(F.sum("n")).first()[0] or 0
    step = whole(slices) if slices else np.zeros(CELLS, np.uint8)
    order = spark.sparkContext.broadcast(Order(step, tokens / CELLS))  # one byte for each cell, whatever the input
    named = keep(sizes.where("n > 0").groupBy("cid").agg(F.min("doc_id").alias("first_id"), F.first("n").alias("n"), F.first("bins").alias("bins")), "classes")
    least = next(n for n in range(2, 102) if 100 * (n - 1) >= percent * n) - 1  # below, only equal sets are similar
    index = keep(rows.mapInArrow(_index(shingle, percent, order, least), "signature long, cid long, size int"), "index")
    order.unpersist()
    n_index = index.count()
    tasks = max(buckets(spark), -(-24 * n_index // TASK_BYTES))
    index = index.withColumn("place", F.xxhash64(F.pmod("signature", F.lit(ORDERS)), "cid"))
    lists = keep(index.repartitionByRange(tasks, "signature", "place").sortWithinPartitions("signature", "place", "cid").mapInArrow(_listed, LISTS), "lists")
    chained = lists.select("cid", F.explode(F.array("next", "after")).alias("other")).where("other IS NOT NULL")
    first = keep(chained.select(F.least("cid", "other").alias("a"), F.greatest("cid", "other").alias("b")).distinct(), "pairs")
    links = keep(_links(first, named, rows, percent, shingle), "links")
    groups = keep(components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "groups")
    members = lists.select("signature", "cid", "size", "cut").join(groups.withColumnRenamed("node", "cid"), "cid", "left")
    placed = members.withColumn("component", F.coalesce("component", "cid"))
    differ = (F.min("component") != F.max("component")).alias("mixed")
    by_list = placed.groupBy("signature").agg(differ, F.count(F.lit(1)).alias("k"), F.bool_or("cut").alias("cut"))
    mixed_lists = keep(by_list.where("mixed AND (k > 3 OR cut)").select("signature", "k"), "mixed")  # shorter whole ones have been compared
    dealt_rows = mixed_lists.agg(F.sum(F.col("k") * F.ceil(F.col("k") / list_block))).first()[0] or 0
    ranges = hash_ranges(spark, dealt_rows * (BINS + 8 * LEAST + 52))
    listed = keep(_of_mixed(placed.drop("cut"), mixed_lists, max(long_list, n_index // 100_000)), "listed")
    padding = F.array_repeat(F.lit(_NONE).cast("long"), LEAST)
    own = listed.groupBy("cid").agg(F.slice(F.concat(F.sort_array(F.collect_list("signature")), padding), 1, LEAST).alias("least"))
    about = own.join(named.select("cid", "bins"), "cid")
    rest = _in_parts(listed, list_block).join(about, "cid").withColumn("bucket", F.pmod("part", F.lit(ranges)).cast("int"))
    second = rest.groupBy("bucket").applyInArrow(_across(percent), "a long, b long").distinct()
    more = keep(_links(second.join(first, ["a", "b"], "left_anti"), named, rows, percent, shingle), "links")
    if more.limit(1).count():
        groups = keep(components(links.union(more).select(F.col("a").alias("u"), F.col("b").alias("v"))), "groups")
    least_id = named.select("cid", "first_id").join(groups.withColumnRenamed("node", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    of_group = least_id.groupBy("component").agg(F.min("first_id").alias("component_id"))
    of_class = least_id.join(of_group, "component").select("cid", "component_id")
    linked = sizes.select("doc_id", "n", "cid").join(of_class.withColumn("linked", F.lit(True)), "cid", "left")
    return linked.select("doc_id", F.col("n").alias("n_shingles"), F.when((F.col("n") > 0) & F.col("linked"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, percent: int = 80, shingle: int = 5) -> DataFrame:
    """The documents of ``docs`` but one of each group of linked ones: the one whose id names the group.

    Rows of one id stand and fall together (they stay if any of them names its group), and of equal
    ones one stays; rows with a null id stay.
    """
    found = join(docs, percent, shingle).where("doc_id IS NOT NULL")
    ids = keep(found.groupBy("doc_id").agg(F.bool_or(F.col("doc_id") == F.col("component_id")).alias("stays"), (F.count(F.lit(1)) > 1).alias("repeated")), "ids")
    left = docs.join(ids.where("NOT stays").select("doc_id"), "doc_id", "left_anti").select(*docs.columns)
    repeated = ids.where("stays AND repeated").select("doc_id")
    if not repeated.limit(1).count():
        return left
    return left.join(repeated, "doc_id", "left_anti").unionByName(left.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])).select(*docs.columns)


ORACLE = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), shingles AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(generate_series(1, len(ws) - 2), lambda k: ws[k] || ' ' || ws[k + 1] || ' ' || ws[k + 2]) END)) AS s
  FROM texts
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT a AS doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(b) AS component_id
FROM reach LEFT JOIN sizes ON sizes.doc_id = a GROUP BY a"""
