"""Documents in blocks of a few megabytes, one row a block, written once.

A block is the unit that window hashes are sent and answered for: work on a block is a function of
its row, so it can be repeated anywhere, and an answer of one bit for each of its hashes finds its
way back by block id. The table is bucketed by block id, so joining answers never moves the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adsieve.llm.storage import keep_bucketed

BLOCK = "block_id long, n_bytes long, doc_ids array<long>, texts array<binary>"
ASKED = "block_id long, bucket int, hashes binary"
ANSWER = "block_id long, bucket int, mask binary"


def _gather(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held = TaskContext.get().partitionId() << 32, 0
        names, columns, kinds = None, None, None

        def block() -> pa.RecordBatch:
            parts = [pa.array([number], pa.int64()), pa.array([held], pa.int64()), *(pa.array([c], pa.list_(t)) for c, t in zip(columns, kinds))]
            return pa.RecordBatch.from_arrays(parts, names)

        for batch in batches:
            if names is None:
                names = ["block_id", "n_bytes", "doc_ids", "texts", "rest"][: 2 + batch.num_columns]
                kinds, columns = batch.schema.types, [[] for _ in batch.columns]
            for at in range(0, batch.num_rows, 500):
                for row in zip(*(c.slice(at, 500).to_pylist() for c in batch.columns)):
                    for column, value in zip(columns, row):
                        column.append(value)
                    columns[1][-1] = columns[1][-1] or b""
                    held += len(columns[1][-1])
                    if held >= size or len(columns[0]) >= 20_000:
                        yield block()
                        number, held, columns = number + 1, 0, [[] for _ in columns]
        if columns and columns[0]:
            yield block()

    return run


def in_blocks(docs: DataFrame, ordered: bool, id_column: str = "doc_id", text_column: str = "text", size: int = 4 << 20, carry: bool = False) -> DataFrame:
    """Blocks of whole documents (null text: empty). ``ordered``: by (doc_id, hash of text, text) across and within blocks.

    ``carry``: all columns but the text go along as structs in ``rest``.
    """
    spark = docs.sparkSession
    rest = F.struct(*[F.col(c) for c in docs.columns if c != text_column]).alias("rest")
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("binary").alias("text"), *[rest] * carry)
    schema = BLOCK + (f", rest array<{rows.schema['rest'].dataType.simpleString()}>" if carry else "")
    if ordered:
        rows = rows.withColumn("h", F.xxhash64("text")).repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text").drop("h")
    return keep_bucketed(rows.mapInArrow(_gather(size), schema), "blocks", "block_id", buckets(spark))


def buckets(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Bytes of hashes that one range should hold, and those that one task should read.
RANGE_BYTES, TASK_BYTES = 16 << 20, 128 << 20


def hash_ranges(spark, total: int = 0) -> int:
    """Into how many ranges ``total`` bytes of hashes are dealt: a few for each shuffle partition, so that they even out,
    and as many as keep a range, which one call of a group function holds, at RANGE_BYTES whatever the input."""
    return max(256, 4 * buckets(spark), -(-total // RANGE_BYTES))


def dealt(rows: DataFrame, total: int) -> DataFrame:
    """Rows of ranges (``bucket``) in as many partitions as keep a task at TASK_BYTES of the ``total``."""
    return rows.repartition(max(buckets(rows.sparkSession), -(-total // TASK_BYTES)), "bucket")


def text_bytes(table: DataFrame) -> int:
    """Bytes of all texts of a table of blocks."""
    return table.agg(F.sum("n_bytes")).first()[0] or 0


def mixed(h: np.ndarray) -> np.ndarray:
    """Finalise polynomial hashes, whose low bits are weak, so that ranges of them are even."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def range_edges(sorted_hashes: np.ndarray, ranges: int) -> np.ndarray:
    """Where each range begins among sorted hashes; one more entry for the end."""
    firsts = (np.arange(ranges, dtype=np.uint64) << np.uint64(32)) // np.uint64(ranges) << np.uint64(32)
    return np.append(np.searchsorted(sorted_hashes, firsts), len(sorted_hashes))


def to_planes(hashes: np.ndarray) -> bytes:
    """Sorted 64-bit values by byte position: the high positions hardly change, which the shuffle's codec uses."""
    return hashes.view(np.uint8).reshape(-1, 8).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


def masks_by_block(answers: DataFrame) -> DataFrame:
    return answers.groupBy("block_id").agg(F.collect_list(F.struct("bucket", "mask")).alias("masks"))


def spread_masks(masks: list[dict] | None, edges: np.ndarray) -> np.ndarray:
    """One flag for each sorted hash of a block, from the answers for its ranges."""
    out = np.zeros(int(edges[-1]), bool)
    for m in masks or ():
        a, b = edges[m["bucket"]], edges[m["bucket"] + 1]
        out[a:b] = np.unpackbits(np.frombuffer(m["mask"], np.uint8), count=b - a)
    return out
