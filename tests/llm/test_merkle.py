import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from adsieve.llm import merkle, queries

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, `a.b` int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def value(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def up(nodes):
    """All levels of a tree, and for each of its leaves the siblings in front and behind, level by level."""
    every, ways = [nodes], [[] for _ in nodes]
    while len(every[-1]) > 1:
        now = every[-1]
        for leaf, way in enumerate(ways):
            at = leaf // 3 ** (len(every) - 1)
            run = range(at // 3 * 3, min(at // 3 * 3 + 3, len(now)))
            way.append(([now[i] for i in run if i < at], [now[i] for i in run if i > at]))
        every.append([h(*now[i : i + 3]) for i in range(0, len(now), 3)])
    return every[-1][0], ways


def plain(rows):
    """The manifest of rows (doc_id, source, lang, n_chars, text), tampered where the check sum of the id is even."""
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append((row[0], h(*map(value, row)), row))
    ordered = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    tops, inner = [], {}
    for s in ordered:
        own = sorted(by_source[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        top, ways = up([x[1] for x in own])
        tops.append(top)
        inner[s] = own, top, ways
    root, upper = up(tops)
    out = []
    for s, above in zip(ordered, upper):
        own, top, ways = inner[s]
        for (doc_id, leaf, row), way in zip(own, ways):
            way = way + above
            found = leaf
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0 and row[4] is not None:
                found = h(*map(value, row[:4]), value(row[4].replace("\n", "")))
            for left, right in way:
                found = h(*left, found, *right)
            out.append((doc_id, leaf, top, root, h(*(d for left, right in way for d in left + right)), found, found == root))
    return out


def tampered():
    return F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"))).otherwise(F.col("text"))


def some_rows(seed, n, sources):
    rng = random.Random(seed)
    names = [None, "", "é", "z", "hot", "Ω", "a-very-long-name", "b"][:sources]
    return [(i, "hot" if sources > 4 and rng.random() < 0.4 else rng.choice(names), rng.choice([None, "en"]), rng.choice([None, 7]), rng.choice([None, "", f"line {i}\nmore", f"text {i}", "\n"])) for i in rng.sample(range(10 * n), n)]


@pytest.mark.parametrize("n,sources,height", [(1, 1, 3), (4, 4, 1), (60, 1, 1), (82, 2, 2), (400, 8, 1), (400, 8, 3)])
def test_equals_plain_trees(spark, n, sources, height):
    rows = some_rows(n, n, sources)
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA).repartition(6)
    got = merkle.manifest(df, tampered(), height).collect()
    assert sorted(map(tuple, got)) == sorted(plain(rows))
    assert n < 60 or 0 < sum(r.verified for r in got) < n


def test_repeated_rows_and_null_ids(spark):
    rows = [(5, "a", "en", 1, "x\ny")] * 40 + [(None, "a", None, None, None)] * 3 + [(None, None, None, None, "t\n")] + [(5, "a", "en", 1, "other")]
    got = merkle.manifest(spark.createDataFrame([(*r, "", 0) for r in rows], SCHEMA).repartition(5), tampered()).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, plain(rows)))


def test_untampered_rows_are_all_verified(spark):
    df = spark.createDataFrame([(*r, "", 0) for r in some_rows(3, 100, 5)], SCHEMA)
    got = merkle.manifest(df)
    assert got.where("verified").count() == 100 == got.where("folded_root = root").count()


def test_starts_of_tasks():
    sources = [None] * 5 + ["a"] * 20 + ["b"] + ["c"] * 3
    row = lambda s: type("Row", (), {"source": s})
    for size in (1, 2, 3, 7, 29):
        tasks = [sources[i : i + size] for i in range(0, 29, size)]
        tasks.insert(1, [])
        found, count, longest = merkle.starts([s for i, t in enumerate(tasks) for s in merkle._survey(i, map(row, t))])
        assert (count, longest) == (4, 20)
        at = 0
        for i, t in enumerate(tasks):
            if t:
                assert found[i] == (sorted({s or "" for s in sources}).index(t[0] or ""), at - sources.index(t[0]), at + len(t) < 29 and sources[at + len(t)] == t[-1])
            at += len(t)


def test_query_equals_sql(spark, tmp_path):
    rows = some_rows(11, 150, 8)
    spark.createDataFrame([(*r, "", 0) for r in rows], SCHEMA).drop("leaf", "a.b").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op12_merkle"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(merkle.ORACLE).fetchall()
    assert got.columns == [c[0] for c in con.description]
    assert sorted(map(tuple, got.collect())) == sorted(want) == sorted(plain(rows))


def test_empty(spark):
    assert merkle.manifest(spark.createDataFrame([], SCHEMA)).collect() == []
