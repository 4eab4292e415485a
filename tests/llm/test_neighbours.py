import numpy as np

from adsieve.llm import neighbours as nb

SCHEMA = "vec_id long, embedding array<double>, part int, x string"


def test_recall_and_exact_scores(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    queries = vectors.where("vec_id % 20 = 0")
    got = nb.search(vectors, queries, nb.fit(vectors), block=300).toPandas()
    pdf = vectors.toPandas().sort_values("vec_id")
    ids, x = pdf.vec_id.to_numpy(), np.array(pdf.embedding.tolist(), float)
    hits = total = 0
    for q, own in got.groupby("query_id"):
        own = own.sort_values("rank")
        score = x @ x[ids == q][0]
        score[ids == q] = -np.inf
        best = set(ids[np.lexsort((ids, -score))[:20]])
        hits, total = hits + len(best & set(own.vec_id)), total + 20
        assert list(own["rank"]) == list(range(1, 21)) and own.score.is_monotonic_decreasing
        assert np.allclose(own.score, [score[ids == v][0] for v in own.vec_id], atol=1e-12)
    assert hits / total >= 0.9 and got.query_id.nunique() == queries.count()


def test_balanced_parts():
    x = np.random.default_rng(1).normal(size=(500, 8))
    part = nb.balanced_parts(x, nb.neighbour_graph(x, 5), 3)
    assert set(np.bincount(part)) <= {62, 63}


def test_odd_vectors_and_ties(spark):
    good = [(i, [1.0, float(i % 3), 0.5], 0, "") for i in range(60)]
    bad = [(100, None, 0, ""), (120, [0.0, 0.0, 0.0], 0, ""), (140, [1.0, None, 1.0], 0, ""), (160, [float("nan"), 1.0, 1.0], 0, ""), (180, [float("inf"), 1.0, 1.0], 0, ""), (200, [1.0], 0, ""), (220, [], 0, ""), (None, [1.0, 1.0, 1.0], 0, "")]
    df = spark.createDataFrame(good + bad + [(7, [1.0, 2.0, 0.5], None, None)], SCHEMA)
    index = nb.fit(df, depth=1)
    index.visits = index.parts
    got = nb.search(df, df.where("vec_id % 20 = 0"), index, k=5, block=16).collect()
    assert {r.query_id for r in got} == {0, 20, 40}
    all_rows = good + [(7, [1.0, 2.0, 0.5], 0, "")]
    for q in (0, 20, 40):
        own = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        want = sorted((-float(np.dot(v, good[q][1])), i) for i, v, *_ in all_rows if i != q)[:5]
        assert [(-s, i) for _, i, s in own] == [(s, i) for s, i in want] or [(i, s) for _, i, s in own] == [(i, -s) for s, i in want]


def whole_answers(spark, vectors, k=20):
    """Every query gets min(k, its candidates) rows; and all candidates where they are no more."""
    df = spark.createDataFrame([(i, v, 0, "") for i, v in vectors], SCHEMA)
    index = nb.fit(df)
    got = {q: list(own) for q, own in nb.search(df, df.dropDuplicates(["vec_id"]), index).toPandas().groupby("query_id").vec_id}
    for q in {i for i, _ in vectors}:
        others = sorted(i for i, _ in vectors if i != q)
        assert len(got.get(q, [])) == min(k, len(others))
        assert len(others) > k or sorted(got.get(q, [])) == others
    return index


def test_small_tables_are_answered_whole(spark):
    for n in (2, 5, 18, 24, 30):
        x = np.random.default_rng(3).normal(size=(n, 3))
        whole_answers(spark, list(enumerate(x.tolist())))


def test_own_rows_are_topped_up(spark):
    rng = np.random.default_rng(4)
    x = [(np.eye(16)[i % 16] * 20 + rng.normal(size=16)).tolist() for i in range(16 * 21)]
    index = whole_answers(spark, [(0 if i % 16 == 0 and i < 160 else i, v) for i, v in enumerate(x)])
    assert index.visits < index.parts


def test_repeated_query_rows(spark):
    x = np.random.default_rng(6).normal(size=(200, 6)).tolist()
    rows = [(i, v, 0, "") for i, v in enumerate(x)]
    twice = [(20, x[20], 1, "again"), (20, x[20], 0, ""), (40, x[41], 0, "another vector")]
    df = spark.createDataFrame(rows + twice, SCHEMA)
    index = nb.fit(df, depth=1)
    index.visits = index.parts
    got = sorted((r.query_id, r.vec_id, round(r.score, 9), r["rank"]) for r in nb.search(df, df.where("vec_id % 20 = 0"), index, k=7).collect())
    every = rows + twice
    want = []
    for q, v, *_ in (r for r in every if r[0] % 20 == 0):
        best = sorted((-float(np.dot(c, v)), i) for i, c, *_ in every if i != q)[:7]
        want += [(q, i, round(-s, 9), k + 1) for k, (s, i) in enumerate(best)]
    assert got == sorted(want)


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert nb.search(none, none, nb.fit(none)).count() == 0
