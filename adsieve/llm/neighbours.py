"""Approximate nearest neighbours by learned partitions.

On a bounded sample of the vectors: the exact neighbour graph, a balanced partition of it
(recursive bisection along the main axis, refined by swapping the pairs that cut most edges), and
a small classifier (one hidden layer) that learns where each vector's neighbours lie. The
classifier places every vector in its most probable partition and sends a query to its several
most probable ones; how many is found on the sample (``target_recall``). A query to which these
don't offer ``k`` candidates goes on to the next ones until they do, or to all. There every vector
is compared with the query: inner products in double precision.

Vectors of a partition and its queries meet in blocks of bounded size, so neither a hot partition
nor a hot vector gathers in one task.

Defined results: vectors that are null or zero, hold null or non-finite components, or differ in
length from the most frequent length of the sample take no part, nor do rows with a null id; rows
with one id are all candidates, and a query's own id is none of its candidates; a row of ``queries`` is
answered by itself, so one that stands there twice gets its answers twice, and rows of one id with
different vectors get those of each; ties go to the smaller id; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Vectors that a partition should hold.
PART_ROWS = 1 << 16
HIT = "query_id long, vector long, copies int, vec_id long, score double"


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    out = np.empty((len(x), k), np.int64)
    for at in range(0, len(x), 1000):
        g = x[at : at + 1000] @ x.T
        g[np.arange(len(g)), at + np.arange(len(g))] = -np.inf
        out[at : at + 1000] = np.argpartition(-g, k - 1, axis=1)[:, :k]
    return out


def bisect_balanced(x: np.ndarray, graph: np.ndarray, nodes: np.ndarray, rounds: int = 12) -> np.ndarray:
    """Side (0 or 1) of each of ``nodes``, the sides equal within one; swaps lower the cut of the graph."""
    own = x[nodes] - x[nodes].mean(axis=0)
    axis = np.linalg.svd(own[: 4000], full_matrices=False)[2][0]
    side = np.zeros(len(nodes), np.int8)
    side[np.argsort(own @ axis, kind="stable")[len(nodes) // 2 :]] = 1
    place = np.full(len(x), -1)
    place[nodes] = np.arange(len(nodes))
    links = place[graph[nodes]]
    inside = links >= 0
    source = np.repeat(np.arange(len(nodes)), inside.sum(axis=1))
    target = links[inside]
    source, target = np.concatenate([source, target]), np.concatenate([target, source])
    best, best_cut = side.copy(), math.inf
    for _ in range(rounds):
        across = side[source] != side[target]
        if across.sum() >= best_cut:
            break
        best, best_cut = side.copy(), across.sum()
        gain = np.bincount(source, np.where(across, 1, -1), len(nodes))
        left, right = (np.flatnonzero(side == s) for s in (0, 1))
        left, right = left[np.argsort(-gain[left], kind="stable")], right[np.argsort(-gain[right], kind="stable")]
        n = min(len(left), len(right))
        swaps = int((gain[left[:n]] + gain[right[:n]] > 0).sum()) // 2
        if not swaps:
            break
        side[left[:swaps]], side[right[:swaps]] = 1, 0
    return best


def balanced_parts(x: np.ndarray, graph: np.ndarray, depth: int) -> np.ndarray:
    part = np.zeros(len(x), np.int64)
    for _ in range(depth):
        side = np.zeros(len(x), np.int64)
        for p in np.unique(part):
            nodes = np.flatnonzero(part == p)
            if len(nodes) > 1:
                side[nodes] = bisect_balanced(x, graph, nodes)
        part = 2 * part + side
    return part


class Router:
    """Partition probabilities: one hidden layer, learned with Adam on the sample."""

    def __init__(self, x: np.ndarray, goal: np.ndarray, hidden: int = 96, epochs: int = 40) -> None:
        rng = np.random.default_rng(7)
        d, parts = x.shape[1], goal.shape[1]
        self.scale = 1 / max(1e-12, float(np.sqrt((x**2).sum(axis=1).mean())))
        self.w = [rng.normal(0, math.sqrt(2 / d), (d, hidden)) * 2, np.zeros(hidden), rng.normal(0, math.sqrt(1 / hidden), (hidden, parts)), np.zeros(parts)]
        m, v, t = [0 * a for a in self.w], [0 * a for a in self.w], 0
        for _ in range(epochs):
            for batch in np.array_split(rng.permutation(len(x)), max(1, len(x) // 256)):
                a = x[batch] * self.scale
                h = np.maximum(a @ self.w[0] + self.w[1], 0)
                d_out = (self._soft(h @ self.w[2] + self.w[3]) - goal[batch]) / len(batch)
                d_h = (d_out @ self.w[2].T) * (h > 0)
                t += 1
                for k, g in enumerate((a.T @ d_h, d_h.sum(axis=0), h.T @ d_out, d_out.sum(axis=0))):
                    m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                    self.w[k] = self.w[k] - 0.003 * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)

    @staticmethod
    def _soft(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def ranked(self, x: np.ndarray, count: int) -> np.ndarray:
        z = np.maximum(x * self.scale @ self.w[0] + self.w[1], 0) @ self.w[2] + self.w[3]
        return np.argsort(-z, axis=1, kind="stable")[:, :count]


class Index:
    """What the sample has taught: the router, its number of partitions, and how many a query visits."""

    def __init__(self, x: np.ndarray, k: int, depth: int, target_recall: float) -> None:
        self.dimensions, self.parts = x.shape[1], 1 << depth
        near = neighbour_graph(x, min(k, len(x) - 1))
        part = balanced_parts(x, near, depth)
        goal = np.zeros((len(x), self.parts))
        np.add.at(goal, (np.repeat(np.arange(len(x)), near.shape[1]), part[near].ravel()), 1 / (near.shape[1] + 1))
        goal[np.arange(len(x)), part] += 1 / (near.shape[1] + 1)
        # recall is measured on a fifth of the sample that the measured router hasn't learned from
        unseen = np.arange(len(x)) % 5 == 0
        trial = Router(x[~unseen], goal[~unseen])
        home = trial.ranked(x, 1)[:, 0]
        order = trial.ranked(x[unseen], self.parts)
        place = np.argsort(order, axis=1)
        found = np.take_along_axis(place, home[near[unseen]], axis=1)
        reached = [(found < n).mean() for n in range(1, self.parts + 1)]
        self.visits = 1 + next((n for n, r in enumerate(reached) if r >= target_recall), self.parts - 1)
        self.router = Router(x, goal)

    def route(self, x: np.ndarray, count: int) -> np.ndarray:
        return self.router.ranked(x, count)


def fit(vectors: DataFrame, k: int = 20, depth: int | None = None, sample_size: int | None = None, target_recall: float = 0.94, id_column: str = "vec_id", vector_column: str = "embedding") -> Index | None:
    """Learn from a hash sample of the vectors; None if fewer than two are usable.

    ``depth``: there are 2 ** depth partitions; None: as many as hold about PART_ROWS vectors each, from 16 to
    1,024, which is what a bounded sample can teach. ``sample_size``: expected vectors of the sample; None: 8,192,
    or 32 for each partition if that is more.
    """
    fine = vectors.where(F.col(id_column).isNotNull() & usable(F.col(vector_column))).select(F.col(id_column).alias("vec_id"), F.col(vector_column).cast("array<double>").alias("x"))
    total = fine.count()
    depth = min(10, max(4, math.ceil(math.log2(max(1, total) / PART_ROWS)))) if depth is None else depth
    sample_size = max(8192, 32 << depth) if sample_size is None else sample_size
    draw = F.pmod(F.xxhash64(F.lit("vector sample"), "vec_id"), F.lit(1 << 24))
    kept = fine.where(draw < int((1 << 24) * min(1.0, sample_size / max(1, total)))).toArrow()
    order = np.argsort(kept.column("vec_id").to_numpy(), kind="stable")
    rows = [v for v in kept.column("x").take(pa.array(order)).to_pylist()]
    if not rows:
        return None
    size = Counter(map(len, rows)).most_common(1)[0][0]
    x = np.array([r for r in rows if len(r) == size])
    return Index(x, k, depth, target_recall) if len(x) > 1 else None


def _place(index: Index, visits: int, column: str):
    def run(batches):
        for pdf in batches:
            if len(pdf):
                x = np.array(pdf["x"].tolist(), float)
                parts = index.route(x, visits)
                out = pdf.loc[pdf.index.repeat(visits)].copy()
                out[column] = parts.ravel().astype(np.int32)
                yield out

    return run


def _visit(index: Index, sizes: dict[int, int], k: int):
    """A row for each partition that a query visits: ``index.visits``, or more until they hold ``k`` rows besides its ``own``."""
    held = np.array([sizes.get(p, 0) for p in range(index.parts)])

    def run(batches):
        for pdf in batches:
            if len(pdf):
                order = index.route(np.array(pdf["x"].tolist(), float), index.parts)
                short = held[order].cumsum(axis=1) < k + pdf["own"].to_numpy()[:, None]
                visits = np.clip(short.sum(axis=1) + 1, index.visits, index.parts)
                out = pdf.loc[pdf.index.repeat(visits), ["query_id", "vector", "copies", "x"]].copy()
                out["part"] = order[np.arange(index.parts) < visits[:, None]].astype(np.int32)
                yield out

    return run


def _nearest(k: int):
    def run(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(candidates):
            return pd.DataFrame({c: pd.Series([], dtype=t) for c, t in (("query_id", "int64"), ("vector", "int64"), ("copies", "int32"), ("vec_id", "int64"), ("score", "float64"))})
        candidates = candidates.sort_values("vec_id", kind="stable")
        ids, c = candidates["vec_id"].to_numpy(), np.array(candidates["x"].tolist())
        q_ids, q = queries["query_id"].to_numpy(), np.array(queries["x"].tolist())
        keys = queries[["vector", "copies"]].to_numpy()
        found = []
        for at in range(0, len(q), 512):
            rough = q[at : at + 512] @ c.T
            rough[q_ids[at : at + 512, None] == ids[None, :]] = -np.inf
            n = min(k, rough.shape[1])
            worst = -np.partition(-rough, n - 1, axis=1)[:, n - 1]
            for row, low, query, (vector, copies), x in zip(rough, worst, q_ids[at : at + 512], keys[at : at + 512], q[at : at + 512]):
                slack = 1e-9 * (1 + abs(low)) if np.isfinite(low) else 0
                near = np.flatnonzero((row >= low - slack) & (row > -np.inf))
                score = (c[near] * x).sum(axis=1)  # the same sum for equal vectors, wherever they lie
                best = np.lexsort((ids[near], -score))[:k]
                found.append(pd.DataFrame({"query_id": query, "vector": vector, "copies": copies, "vec_id": ids[near][best], "score": score[best]}))
        return pd.concat(found)

    return run


def search(vectors: DataFrame, queries: DataFrame, index: Index | None, k: int = 20, block: int = 8192, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest of ``vectors`` found for each row of ``queries``."""
    spark = vectors.sparkSession
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    def rows(df: DataFrame, name: str) -> DataFrame:
        fit_rows = df.where(F.col(id_column).isNotNull() & usable(F.col(vector_column)) & (F.size(vector_column) == index.dimensions))
        return fit_rows.select(F.col(id_column).cast("long").alias(name), F.col(vector_column).cast("array<double>").alias("x"))

    placed = rows(vectors, "vec_id").mapInPandas(_place(index, 1, "part"), "vec_id long, x array<double>, part int")
    held = {r["part"]: r["n"] for r in placed.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}
    # rows with a query's own id aren't its candidates; few ids have more than one
    repeated = rows(vectors, "query_id").groupBy("query_id").agg(F.count(F.lit(1)).alias("own")).where("own > 1")
    # equal rows of the queries are searched once; ``vector`` tells rows of one id apart
    once = rows(queries, "query_id").groupBy("query_id", "x").agg(F.count(F.lit(1)).cast("int").alias("copies"))
    counted = once.join(repeated, "query_id", "left").select("query_id", F.xxhash64("x").alias("vector"), "copies", "x", F.coalesce("own", F.lit(1)).alias("own"))
    asked = counted.mapInPandas(_visit(index, held, k), "query_id long, vector long, copies int, x array<double>, part int")
    # blocks: as many for each partition as its rows need, by a hash that differs for equal ids too
    asking = asked.groupBy("part").agg(F.count(F.lit(1)).alias("m")).collect()
    sizes = [{"part": r["part"], "n": held[r["part"]], "m": r["m"]} for r in asking if r["part"] in held]
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    c_blocks = {r["part"]: -(-r["n"] // block) for r in sizes}
    q_blocks = {r["part"]: -(-r["m"] // block) for r in sizes}

    def of(counts: dict[int, int]) -> Column:
        return F.element_at(F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, n)]), F.col("part"))

    spread = lambda counts, name: F.explode(F.sequence(F.lit(0), of(counts) - 1)).alias(name)
    dealt = lambda counts, name: F.pmod(F.xxhash64(name), of(counts)).cast("int")
    live = F.col("part").isin(*c_blocks)
    left = asked.where(live).select("query_id", "vector", "copies", "x", "part", dealt(q_blocks, "query_id").alias("q_block"), spread(c_blocks, "c_block"))
    right = placed.where(live).select("vec_id", "x", "part", dealt(c_blocks, "vec_id").alias("c_block"), spread(q_blocks, "q_block"))
    keys = ["part", "q_block", "c_block"]
    hits = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_nearest(k), HIT)
    order = Window.partitionBy("query_id", "vector").orderBy(F.desc("score"), "vec_id")
    best = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    answers = F.explode(F.array_repeat(F.struct("query_id", "rank", "vec_id", "score"), F.col("copies")))
    return best.select(answers.alias("a")).select("a.*")
