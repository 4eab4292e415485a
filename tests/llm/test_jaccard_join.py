import random
import re

import numpy as np
import pyarrow as pa
import pytest

from adsieve.llm import jaccard_join as jj
from adsieve.llm.components import components

SCHEMA = "doc_id long, text string, cid string, n long, bucket int"


def shingles(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute(texts, percent):
    sets = [shingles(t) for t in texts]
    label = list(range(len(texts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                label[y] = x
    return [(len(s), root(i)) for i, s in enumerate(sets)]


def corpus(seed, copies):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)]
    texts = ["", None, "one", "One", "two words", "TWO words ", "two  words extra"]
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(5, 200))]
        for _ in range(rng.randrange(1, 9)):
            own = list(base)
            for _ in range(rng.randrange(0, 1 + len(base) // 25)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts.append(" ".join(own))
    base = [rng.choice(vocabulary) for _ in range(120)]
    for _ in range(copies):  # a large group of near copies around the threshold
        own = list(base)
        for _ in range(rng.randrange(0, 5)):
            own[rng.randrange(len(own))] = rng.choice(vocabulary)
        texts.append(" ".join(own))
    line = " ".join(vocabulary[:20])
    texts += [f"{line} {' '.join(rng.choice(vocabulary) for _ in range(6))}" for _ in range(40)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("frequent", [None, 8, 0, -1])
def test_against_brute_force(spark, frequent, monkeypatch):
    if frequent is not None:  # make most tokens frequent, so that pairs are the signatures
        plain = jj.Order.__init__

        def low(self, step, mean):
            plain(self, step, mean)
            self.frequent = frequent

        monkeypatch.setattr(jj.Order, "__init__", low)
    texts = corpus(4, 60)
    rows = [(i, t, None, 1, 2) for i, t in enumerate(texts)]
    got = jj.join(spark.createDataFrame(rows, SCHEMA).repartition(4), list_block=7 if frequent else jj.LIST_BLOCK, long_list=5 if frequent else jj.LONG_LIST).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == [(i, *w) for i, w in enumerate(brute(texts, 90))]


def test_signatures_meet_for_all_similar_pairs():
    rng = np.random.default_rng(2)
    step = np.zeros(jj.CELLS, np.uint8)
    universe = np.unique(rng.integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
    common = universe[rng.random(len(universe)) < 0.6]
    step[jj.cells(common)] = 200
    order = jj.Order(step, 1.0)
    for _ in range(400):
        n = int(rng.integers(10, 400))
        a = rng.choice(universe, n, replace=False)
        b = np.concatenate([a[: n - int(rng.integers(0, 1 + n // 10))], rng.choice(universe, int(rng.integers(0, 1 + n // 12)))])
        a, b = np.unique(a), np.unique(b)
        if jj.similar(len(np.intersect1d(a, b)), len(a), len(b), 90):
            assert len(np.intersect1d(order.signatures(a, 90), order.signatures(b, 90))) or len(a) == len(b) == len(np.intersect1d(a, b))


@pytest.mark.parametrize("step", [1, 2, 3, 50])
def test_lists_of_a_sorted_stream(step):
    rng = random.Random(step)
    rows = sorted((rng.randrange(12), rng.randrange(9)) for _ in range(40)) + [(20, 1), (20, 1), (21, 5)]
    batches = [pa.record_batch({"signature": [s for s, _ in part], "cid": [c for _, c in part], "size": pa.array([9] * len(part), pa.int32())}) for part in (rows[at : at + step] for at in range(0, len(rows), step))]
    got = [tuple(r.values()) for batch in jj._listed(iter(batches)) for r in batch.to_pylist()]
    distinct, want = sorted(set(rows)), []
    for at, (s, c) in enumerate(distinct):
        own = [x for x in distinct if x[0] == s]
        later = [x[1] for x in own if x[1] > c] + [None, None]
        cut = at in (0, len(distinct) - 1)
        if len(own) > 1 or cut:
            want.append((s, c, 9, later[0], later[1], cut))
    assert got == want and (20, 1) not in {r[:2] for r in got}
    assert list(jj._listed(iter([]))) == []


def test_components(spark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(0, 150)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)] + [(500, k) for k in range(501, 560)] + [(9, 9)]
    label = {x: x for e in edges for x in e}
    for _ in range(400):
        for u, v in edges:
            label[u] = label[v] = min(label[u], label[v])
    got = dict(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert got == {k: v for k, v in label.items() if k in got} and {x for u, v in edges if u != v for x in (u, v)} == set(got)


def test_repeats_and_empty(spark):
    rows = [(7, "a b c d", "", 1, 1), (7, "a b c d", "", 1, 1), (None, "a b c d", "", 1, 1), (None, "z", "", 1, 1), (8, "", "", 1, 1)]
    got = jj.join(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == [("7", 2, "7"), ("7", 2, "7"), ("8", 0, "8"), ("None", 1, "None"), ("None", 2, "7")]
    assert jj.join(spark.createDataFrame([], SCHEMA)).count() == 0
