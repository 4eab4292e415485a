"""Near-duplicates by SimHash fingerprints that meet in the middle.

A fingerprint holds the majority of each bit of its text's shingle hashes. Every different fingerprint
emits all variants within half the radius, and variants are shuffled. Two fingerprints differ by the
radius or less exactly if a variant is common to both; all that meet at a variant differ by the radius
or less from each other. So they are chained in order, each with the one before, and each link is
verified: no pair within the radius loses its connection, a variant gives one link fewer than it
has fingerprints, and no fingerprint more than two links a variant.

Equal fingerprints are one node however many documents share them, and at most as many fingerprints as
there are variants of one meet at a variant. Where documents get their component, fingerprints (and
components) that hold more than a thousandth of all rows are looked up in a broadcast table, which has a
thousand rows at most; only the others are shuffled.

Defined results: a text with fewer words than a shingle is one shingle; a null text, and one without words, has
fingerprint zero and is linked like any other. A row with a null id gets its fingerprint, a null component_id, and
links nothing. Repeated rows, and rows of one id with several texts, are each a row of its own. An empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from adsieve.llm.components import components
from adsieve.llm.storage import keep
from adsieve.llm.words import no_cache, slices

BITS, SEED = 64, 42
#: What holds more than this share of all rows is looked up in a broadcast table.
HOT_SHARE = 1000


def _set_bits(shingles: list[bytes]) -> np.ndarray:
    """How many of the shingles' hashes have each bit, the highest bit first."""
    hashes = np.fromiter((xxh64_intdigest(s, SEED) for s in shingles), ">u8", len(shingles))
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        counts += np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return counts


def fingerprint(text: bytes, shingle: int) -> int:
    """The unsigned fingerprint of a whole text, a few megabytes at a time."""
    counts, n, before = np.zeros(BITS, np.int64), 0, []
    for a, b in slices(text):
        words = before + text[a:b].lower().split()
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
        counts, n = counts + _set_bits(shingles), n + len(shingles)
        before = words[max(0, len(words) - shingle + 1) :]
    if not n and before:
        counts, n = _set_bits([b" ".join(before)]), 1
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no_cache()
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py() or b"", shingle) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "print"])

    return run


def fingerprints(docs: DataFrame, shingle: int = 3, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, print): the fingerprint of each row as a signed long."""
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").cast("binary").alias("text"))
    return rows.mapInArrow(_fingerprints(shingle), "doc_id long, print long")


def variants(radius: int) -> list[int]:
    """Masks of all changes within half the radius, as signed longs."""
    masks = [sum(1 << b for b in bits) for size in range(radius // 2 + 1) for bits in combinations(range(BITS), size)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def links(prints: DataFrame, radius: int) -> DataFrame:
    """(u, v): chains that connect all of the different ``print`` that differ in ``radius`` bits or fewer."""
    if radius % 2:
        raise ValueError("only fingerprints within half an even radius of a variant are all linked with each other")
    masks = F.array(*[F.lit(m).cast("long") for m in variants(radius)])
    sent = prints.select("print", F.explode(masks).alias("mask")).select("print", F.col("print").bitwiseXOR(F.col("mask")).alias("variant"))
    before = F.lag("print").over(Window.partitionBy("variant").orderBy("print"))
    chained = sent.select(before.alias("u"), F.col("print").alias("v")).where("u IS NOT NULL").distinct()
    return chained.where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius)


def looked_up(rows: DataFrame, answers: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` joined with their one answer; ``answers`` (key, n, ...) says how many of the ``total`` rows each has."""
    hot = F.col("n") * HOT_SHARE > total  # fewer than HOT_SHARE of them, since the n add up to the total at most
    many = answers.where(hot).drop("n")
    others = rows.join(F.broadcast(many.select(key)), key, "left_anti")
    return rows.join(F.broadcast(many), key).unionByName(others.join(answers.where(~hot).drop("n"), key))


def hexadecimal(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id): the smallest id that a row's links reach, its own included."""
    prints = keep(fingerprints(docs, shingle, id_column, text_column), "prints")
    known = prints.where("doc_id IS NOT NULL")
    nodes = keep(known.groupBy("print").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")), "nodes")
    rows, different = (r or 0 for r in nodes.agg(F.sum("n"), F.count(F.lit(1))).first())
    found = components(keep(links(nodes.select("print"), radius), "links"))
    linked = keep(nodes.join(found.withColumnRenamed("node", "print"), "print", "left"), "linked")
    joint = linked.where("component IS NOT NULL")
    named = keep(joint.groupBy("component").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("n")), "named")
    grouped = looked_up(joint.select("print", "component", F.col("n").alias("rows")), named, "component", different).select("print", F.col("rows").alias("n"), "component_id")
    alone = linked.where("component IS NULL").select("print", "n", F.col("least").alias("component_id"))
    answered = looked_up(known, keep(grouped.union(alone), "answers"), "print", rows)
    unknown = prints.where("doc_id IS NULL").withColumn("component_id", F.lit(None).cast("long"))
    return answered.unionByName(unknown).select("doc_id", hexadecimal(F.col("print")).alias("fingerprint"), "component_id")
