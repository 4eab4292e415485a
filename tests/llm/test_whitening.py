from fractions import Fraction

import numpy as np
import pytest

from adsieve.llm import queries
from adsieve.llm import whitening as wh

SCHEMA = "vec_id long, embedding array<float>, n string, x int, `a.b` int"


def plain(rows, count=32):
    """Exact integers for the mean and the deviations, then a covariance of centred doubles."""
    x = [[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for v in rows]
    n, d = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(d)]
    centred = np.array([[float(Fraction(r[j] * n - sums[j], n)) for j in range(d)] for r in x])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:count], axes[:, ::-1][:, :count]
    return [sum((n * r[j] - sums[j]) ** 2 for j in range(d)) for r in x], values, values / np.trace(centred.T @ centred / n), centred @ axes / np.sqrt(values)


def compared(got, rows, count=32):
    deviations, values, explained, whitened = plain(rows, count)
    place = {r.vec_id: i for i, r in enumerate(got) if r.component == 1}
    assert len(got) == len(rows) * len(values)
    table = np.full((len(rows), len(values)), np.nan)
    for r in got:
        table[r.vec_id, r.component - 1] = r.whitened
        assert r.deviation == deviations[r.vec_id] and r.n == len(rows)
        assert abs(r.explained - explained[r.component - 1]) <= 1e-9 * explained[r.component - 1] and r.identity_error <= 1e-9
    signs = np.sign((table * whitened).sum(axis=0))
    assert len(place) == len(rows) and np.allclose(table, whitened * signs, atol=1e-7)


def test_equals_exact_arithmetic(spark):
    rng = np.random.default_rng(5)
    rows = (rng.normal(size=(300, 5)) * [5, 3, 2, 1, 0.5] + 7).tolist()
    df = spark.createDataFrame([(i, v, "", 0, 0) for i, v in enumerate(rows)], SCHEMA).repartition(5)
    compared(wh.whiten(df).collect(), rows)
    compared(wh.whiten(df, count=2).collect(), rows, 2)


def test_query_on_its_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [r for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = queries.QUERIES["op13_whitening"](spark, sf).toPandas()
    deviations, _, explained, whitened = plain([r.embedding for r in rows])
    assert len(got) == 32 * len(rows) and got.identity_error.nunique() == 1 and got.identity_error.max() <= 1e-4
    wide = got.pivot(index="vec_id", columns="component", values="whitened").loc[[r.vec_id for r in rows]].to_numpy()
    assert np.allclose(np.abs(wide), np.abs(whitened), atol=1e-6)
    assert dict(zip(got.vec_id, got.deviation)) == {r.vec_id: d for r, d in zip(rows, deviations)}
    assert np.allclose(got.groupby("component").explained.first(), explained, rtol=1e-9)


def test_odd_rows(spark):
    good = [(i, [float(i), float(i * i % 7), 1.5], None, 1, 1) for i in range(9)]
    bad = [(20, None, "", 0, 0), (21, [1.0, None, 2.0], "", 0, 0), (22, [1.0, float("nan"), 2.0], "", 0, 0), (23, [float("-inf"), 1.0, 2.0], "", 0, 0), (24, [], "", 0, 0), (25, [1.0], "", 0, 0)]
    twice = [(0, [0.0, 0.0, 1.5], "", 0, 0), (None, [3.0, 2.0, 1.5], "", 0, 0), (30, [0.0, 0.0, 0.0], "", 0, 0)]
    got = wh.whiten(spark.createDataFrame(good + bad + twice, SCHEMA)).collect()
    ids = sorted((r.vec_id is None, r.vec_id or 0) for r in got if r.component == 1)
    assert ids == sorted([(False, i) for i in [*range(9), 0, 30]] + [(True, 0)])
    assert {r.n for r in got} == {12}


def test_without_spread(spark):
    got = wh.whiten(spark.createDataFrame([(1, [2.0, 3.0], "", 0, 0)] * 3, SCHEMA)).collect()
    assert len(got) == 6 and all(r.whitened is None and r.explained is None and r.identity_error is None and r.deviation == 0 for r in got)
    flat = wh.whiten(spark.createDataFrame([(i, [float(i), 5.0], "", 0, 0) for i in range(4)], SCHEMA)).collect()
    assert {(r.component, r.whitened is None) for r in flat} == {(1, False), (2, True)} and flat[0].identity_error < 1e-12


def test_empty(spark):
    assert wh.whiten(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("size", [1.0, 1e5, 1e15, 1e300])
def test_large_values_stay_exact(size):
    x = wh.whole_numbers(np.random.default_rng(1).normal(size=(50, 3)) * size, 64.0, 1_000_000)
    exact = x.astype(object)
    sums = [int(s) for s in exact.sum(axis=0)]
    want = [sum((50 * int(v) - s) ** 2 for v, s in zip(r, sums)) for r in exact]
    assert wh.Centre(50, sums).deviations(x) == [w if w < 1 << 63 else None for w in want]
