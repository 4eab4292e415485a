"""A Merkle manifest of a table, made and verified by supersteps of messages.

Every row is a leaf, hashed inside the JVM. Leaves are dealt by range of (source, id), so a source that holds a
third of the rows spans many tasks; from a few numbers for each task the driver knows at which place of which
source each task begins.

Then supersteps on RDDs. A vertex is a subtree of ``height`` levels, reached by 3 ** height messages at most,
whatever the size of a source. Upwards, children message their vertex; a vertex is complete when all messages of
the superstep have arrived, hashes its parents level by level and forwards its top, until one node of each source
is left. These subroots are the leaves of one more tree, whose top is the root. Downwards, each vertex
sends its children the siblings on their way to the root, made of its own levels and of what it was sent; the
lowest vertices hold the leaves and verify them there, so a path is sent once for 3 ** height leaves. Nothing is
cached: the way down reads the shuffles of the way up again, and lost ones are made anew from the written leaves.

Defined results: null values are hashed as ``-``; a null source is one of its own and comes first, a null id comes
first in its source; rows with one id are ordered by their leaves, and equal rows are leaves of their own in any
order. An empty table gives an empty result; other columns are ignored unless named.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

from pyspark import RDD
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adsieve.llm.storage import keep

FAN = 3
#: Nodes that a task of a superstep should hold.
TASK_NODES = 100_000
MANIFEST = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def encoded(value: Column) -> Column:
    """A value that can't run into the next one: its length in bytes, a colon and itself; null is ``-``."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*map(encoded, values)), 256)


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels(nodes: list[str], whole: bool, height: int) -> list[list[str]]:
    """The nodes of a subtree, level by level: up to the single one left of a ``whole`` tree, or ``height`` levels."""
    out = [nodes]
    while len(out[-1]) > 1 if whole else len(out) <= height:
        out.append([digest(*out[-1][i : i + FAN]) for i in range(0, len(out[-1]), FAN)])
    return out


def way_up(tree: list[list[str]], place: int) -> list[tuple[str, str]]:
    """What stands left and right of a node and of its ancestors, below the subtree's top."""
    out = []
    for nodes in tree[:-1]:
        first = place - place % FAN
        out.append(("".join(nodes[first:place]), "".join(nodes[place + 1 : first + FAN])))
        place //= FAN
    return out


def folded(leaf: str, path: Iterable[tuple[str, str]]) -> str:
    for left, right in path:
        leaf = digest(left, leaf, right)
    return leaf


# -- places ---------------------------------------------------------------------------------------------------------


def _survey(index: int, rows: Iterator) -> Iterator[tuple]:
    """Of a task's rows in order: first and last source, how many sources begin after the first, rows of the first, of the last, of the longest."""
    first = last = None
    runs, began, longest, n = 0, 0, 0, 0
    first_run = 0
    for row in rows:
        if n == 0:
            first = last = row.source
        elif row.source != last:
            longest = max(longest, n - began)
            first_run, runs, began, last = first_run or n, runs + 1, n, row.source
        n += 1
    if n:
        yield index, first, last, runs, first_run or n, n - began, max(longest, n - began)


def starts(surveys: list[tuple]) -> tuple[dict[int, tuple[int, int, bool]], int, int]:
    """For each task the source and place of its first row and whether its last source goes on; how many sources, the longest."""
    out, rank, running, longest = {}, -1, 0, 0
    surveys = sorted(surveys)
    for at, (index, first, last, runs, first_run, last_run, most) in enumerate(surveys):
        goes_on = at > 0 and surveys[at - 1][2] == first
        rank, offset = (rank, running) if goes_on else (rank + 1, 0)
        out[index] = (rank, offset, at + 1 < len(surveys) and surveys[at + 1][1] == last)
        running = last_run + offset * (runs == 0)
        longest, rank = max(longest, most, offset + first_run, running), rank + runs
    return out, rank + 1, longest


def _placed(begins):
    """((source's rank, place), (is the last, leaf, the row's own)) in order; a row is sent once the next one is seen."""

    def run(index: int, rows: Iterator) -> Iterator[tuple]:
        rank, place, goes_on = begins.value.get(index, (0, 0, False))
        before = None
        for row in rows:
            if before is not None:
                ends = row.source != before.source
                yield (rank, place), (ends, before.leaf, (before.doc_id, before.altered))
                rank, place = (rank + 1, 0) if ends else (rank, place + 1)
            before = row
        if before is not None:
            yield (rank, place), (not goes_on, before.leaf, (before.doc_id, before.altered))

    return run


# -- supersteps -----------------------------------------------------------------------------------------------------


class Vertex:
    """A subtree with the messages of its children: (place, is the last of its tree, digest, its own)."""

    def __init__(self, block: int, children: Iterable[tuple], height: int) -> None:
        self.children = sorted(children, key=lambda c: c[0])
        self.last = self.children[-1][1]
        self.whole = block == 0 and self.last
        self.levels = levels([c[2] for c in self.children], self.whole, height)
        self.top = self.levels[-1][0]


def lift(nodes: RDD, longest: int, total: int, height: int, tasks: int) -> tuple[list[tuple[RDD, int]], RDD]:
    """Supersteps up: the vertices of each, with their number of tasks, and (tree, (top, superstep)) of each tree.

    ``longest``: nodes of the largest tree; ``total``: of all; ``tasks``: at least so many for each superstep.
    """
    width = FAN**height
    steps: list[tuple[RDD, int]] = []
    tops: RDD | None = None
    while True:
        count, step = max(tasks, -(-total // TASK_NODES)), len(steps)
        sent = nodes.map(lambda m: ((m[0][0], m[0][1] // width), (m[0][1], *m[1])))
        vertices = sent.groupByKey(count).map(lambda v: (v[0], Vertex(v[0][1], v[1], height)))
        steps.append((vertices, count))
        ended = vertices.filter(lambda v: v[1].whole).map(lambda v, step=step: (v[0][0], (v[1].top, step)))
        tops = ended if tops is None else tops.union(ended)
        if longest <= width:
            return steps, tops
        nodes = vertices.filter(lambda v: not v[1].whole).map(lambda v: (v[0], (v[1].last, v[1].top, None)))
        longest, total = -(-longest // width), -(-total // width)


def _told(vertex: tuple) -> Iterator[tuple]:
    """The path of each child: ((tree, place), (subroot, root, path, the child's digest, its own))."""
    (tree, block), (own, message) = vertex
    subroot, root, above = message or (None, None, ())
    subroot = own.top if own.whole else subroot
    root = root or own.top
    first = own.children[0][0]
    for place, _, leaf, rest in own.children:
        yield (tree, place), (subroot, root, (*way_up(own.levels, place - first), *above), leaf, rest)


def lower(steps: list[tuple[RDD, int]], from_above: RDD | None) -> RDD:
    """Supersteps down. ``from_above``: ((tree, superstep where it ended), (root, path)); None: the tops are roots."""
    children: RDD | None = None
    for step in range(len(steps) - 1, -1, -1):
        vertices, count = steps[step]
        messages = children.mapValues(lambda c: c[:3]) if children is not None else None
        if from_above is not None:
            ended = from_above.filter(lambda m, step=step: m[0][1] == step).map(lambda m: ((m[0][0], 0), (None, *m[1])))
            messages = ended if messages is None else messages.union(ended)
        met = vertices.mapValues(lambda v: (v, None)) if messages is None else vertices.leftOuterJoin(messages, count)
        children = met.flatMap(_told)
    return children


def _verified(leaf: tuple) -> tuple:
    _, (subroot, root, path, own, (doc_id, altered)) = leaf
    again = folded(altered or own, path)
    return doc_id, own, subroot, root, digest(*(side for level in path for side in level)), again, again == root


def manifest(docs: DataFrame, tampered: Column | None = None, height: int = 3, columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), id_column: str = "doc_id", source_column: str = "source", text_column: str = "text") -> DataFrame:
    """MANIFEST: leaf, subroot, root and proof of every row, and whether the path of what is stored leads to the root.

    ``columns`` are hashed, in this order. ``tampered`` stands for the text as it is found at verification; None: as
    it was. ``height``: levels that a superstep climbs.
    """
    spark, context = docs.sparkSession, docs.sparkSession.sparkContext
    values = {c: F.col(f"`{c}`") for c in columns}
    leaf = leaf_hash(*values.values())
    later = F.lit(None).cast("string") if tampered is None else F.when(~tampered.eqNullSafe(values[text_column]), leaf_hash(*(values | {text_column: tampered}).values()))
    hashed = docs.select(F.col(f"`{source_column}`").cast("string").alias("source"), F.col(f"`{id_column}`").cast("long").alias("doc_id"), leaf.alias("leaf"), later.alias("altered"))
    leaves = keep(hashed, "leaves")
    total, tasks = leaves.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), "leaf", "row"]
    dealt = leaves.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(max(tasks, -(-total // TASK_NODES)), *order)
    rows = dealt.sortWithinPartitions(*order).drop("row").rdd
    begins, sources, longest = starts(rows.mapPartitionsWithIndex(_survey).collect())
    if not sources:
        return spark.createDataFrame([], MANIFEST)
    placed = rows.mapPartitionsWithIndex(_placed(context.broadcast(begins)))
    steps, subroots = lift(placed, longest, total, height, tasks)
    leading = subroots.map(lambda s: ((0, s[0]), (s[0] == sources - 1, *s[1])))
    upper, _ = lift(leading, sources, sources, height, max(1, min(tasks, sources // FAN**height)))
    paths = lower(upper, None).map(lambda c: ((c[0][1], c[1][4]), (c[1][1], c[1][2])))
    return spark.createDataFrame(lower(steps, paths).map(_verified), MANIFEST, verifySchema=False)


#: Levels as recursive queries; a leaf's way up is a list of ``left|right``, folded from the leaf.
ORACLE = r"""
WITH RECURSIVE noted AS (
  SELECT doc_id, source, lang, n_chars, text, CASE WHEN doc_id IS NULL THEN 1 ELSE xor(4294967295, list_reduce(list_prepend(4294967295::UBIGINT, flatten(list_transform(
      string_split(doc_id::VARCHAR, ''), lambda d: [ascii(d)::UBIGINT, 0, 0, 0, 0, 0, 0, 0]))), lambda c, x: xor(xor(c, x) // 2, 3988292384 * (xor(c, x) % 2)))) % 2 END AS odd FROM documents
), written AS (
  SELECT *, CASE WHEN odd = 0 THEN replace(text, chr(10), '') ELSE text END AS found,
    concat(coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-'), coalesce(octet_length(encode(source)) || ':' || source, '-'), coalesce(octet_length(encode(lang)) || ':' || lang, '-'), coalesce(octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars, '-')) AS head
  FROM noted
), hashed AS (
  SELECT doc_id, source, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf, sha256(head || coalesce(octet_length(encode(found)) || ':' || found, '-')) AS later FROM written
), leaves AS (
  SELECT doc_id, leaf, later, dense_rank() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM hashed
), nodes AS (
  SELECT tree, 0 AS level, pos, leaf AS d FROM leaves
  UNION ALL
  SELECT tree, level + 1, pos // 3, sha256(string_agg(d, '' ORDER BY pos)) FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM nodes) WHERE n > 1 GROUP BY tree, level, pos // 3
), subroots AS (
  SELECT tree, max(level) AS height, arg_max(d, level) AS d FROM nodes GROUP BY tree
), upper_nodes AS (
  SELECT 0 AS level, tree AS pos, d FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, sha256(string_agg(d, '' ORDER BY pos)) FROM (SELECT *, count(*) OVER () AS n FROM upper_nodes) WHERE n > 1 GROUP BY level, pos // 3
), root AS (
  SELECT max(level) AS height, arg_max(d, level) AS d FROM upper_nodes
), steps AS (
  SELECT tree, l.pos, level AS step, coalesce(string_agg(n.d, '' ORDER BY n.pos) FILTER (n.pos < p), '') AS before, coalesce(string_agg(n.d, '' ORDER BY n.pos) FILTER (n.pos > p), '') AS after
  FROM (SELECT tree, pos, unnest(range(height)) AS level, pos // (3 ** level)::BIGINT AS p FROM leaves JOIN subroots USING (tree)) l JOIN nodes n USING (tree, level)
  WHERE n.pos // 3 = p // 3 GROUP BY tree, l.pos, level
), upper_steps AS (
  SELECT tree, 1000 + level AS step, coalesce(string_agg(n.d, '' ORDER BY n.pos) FILTER (n.pos < p), '') AS before, coalesce(string_agg(n.d, '' ORDER BY n.pos) FILTER (n.pos > p), '') AS after
  FROM (SELECT tree, unnest(range(root.height)) AS level, tree // (3 ** level)::BIGINT AS p FROM subroots, root) l JOIN upper_nodes n USING (level)
  WHERE n.pos // 3 = p // 3 GROUP BY tree, level
), ways AS (
  SELECT tree, pos, list(before || '|' || after ORDER BY step) AS way, string_agg(before || after, '' ORDER BY step) AS proof
  FROM (SELECT * FROM steps UNION ALL SELECT u.tree, l.pos, u.step, u.before, u.after FROM upper_steps u JOIN leaves l USING (tree)) GROUP BY tree, pos
), judged AS (
  SELECT l.doc_id, l.leaf, s.d AS subroot, root.d AS root, sha256(coalesce(proof, '')) AS proof_sha256,
    list_reduce(list_prepend(l.later, coalesce(way, [])), lambda d, w: sha256(split_part(w, '|', 1) || d || split_part(w, '|', 2))) AS folded_root
  FROM leaves l JOIN subroots s USING (tree) CROSS JOIN root LEFT JOIN ways USING (tree, pos)
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM judged
"""
