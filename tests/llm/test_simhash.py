import random

import pytest
import xxhash

from adsieve.llm import queries
from adsieve.llm import simhash as sh
from adsieve.llm import words

SCHEMA = "doc_id long, text string, print string, n int, `a.b` int"


def plain_print(text, size=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        lowered = lowered.replace(c, " ")
    parts = [w for w in lowered.split(" ") if w]
    shingles = [" ".join(parts[i : i + size]) for i in range(len(parts) - size + 1)] or [" ".join(parts)] * bool(parts)
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain(rows, radius=2):
    """All pairs compared; components by repeated relabelling."""
    prints = [(i, plain_print(t)) for i, t in rows]
    label = [i for i, _ in rows]
    moved = True
    while moved:
        moved = False
        for a, (i, p) in enumerate(prints):
            near = [label[b] for b, (j, q) in enumerate(prints) if i is not None and j is not None and bin(p ^ q).count("1") <= radius]
            if near and min(near) < label[a]:
                label[a], moved = min(near), True
    return sorted(((i, f"{p:016x}", c) for (i, p), c in zip(prints, label)), key=str)


def some_texts(seed, groups=12, each=8):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(50)]
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(1, 150))]
        for _ in range(each):
            yield " ".join(rng.choice(vocabulary).upper() if rng.random() < 0.01 else w for w in base)


def test_equals_all_pairs(spark):
    texts = list(some_texts(1))
    rows = [(1000 - 3 * i, t) for i, t in enumerate(texts)] + [(5000, None), (4000, ""), (6000, " \n\t"), (7, "one"), (8, "ONE"), (9, "two words"), (10, "a b c d e"), (7, "one"), (7, texts[0]), (None, texts[0]), (None, None)]
    df = spark.createDataFrame([(i, t, "x", None, 0) for i, t in rows], SCHEMA).repartition(7)
    got = sorted(map(tuple, sh.near_duplicates(df).collect()), key=str)
    want = plain(rows)
    assert got == want
    assert len({c for _, _, c in want}) < len(want) / 2


def test_query_equals_all_pairs(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(some_texts(2, 10, 6))]
    spark.createDataFrame([(i, t, "x", 1, 0) for i, t in rows], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op11_simhash"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows)


@pytest.mark.parametrize("radius", [0, 2, 4])
def test_links_connect_all_within_the_radius(spark, radius):
    rng = random.Random(radius)
    values = {rng.getrandbits(64) for _ in range(15)}
    for v in list(values):
        for _ in range(6):
            values.add(v ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, radius + 1))))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    made = sh.links(spark.createDataFrame([(v,) for v in signed], "print long"), radius).collect()
    group = {v: v for v in signed}

    def root(v):
        while group[v] != v:
            v = group[v]
        return v

    for u, v in made:
        assert bin((u ^ v) & (1 << 64) - 1).count("1") <= radius
        group[root(u)] = root(v)
    for u in signed:
        for v in signed:
            if bin((u ^ v) & (1 << 64) - 1).count("1") <= radius:
                assert root(u) == root(v)


def test_odd_radius_is_refused(spark):
    with pytest.raises(ValueError):
        sh.links(spark.range(1).toDF("print"), 3)


def test_hot_fingerprint_is_looked_up_by_broadcast(spark):
    rows = spark.range(4000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'the same text in a third of all rows' ELSE concat('text number ', id, ' of its own kind ', id * 7) END AS text")
    got = sh.near_duplicates(rows)
    assert got.where("doc_id % 3 = 0").select("component_id").distinct().count() == 1
    assert got.count() == 4000 and got.where("component_id > doc_id").count() == 0


def test_long_text_in_slices(spark):
    rng = random.Random(9)
    text = " ".join(rng.choice(["alpha", "Beta", "gamma", "delta"]) + str(rng.randint(0, 30)) for _ in range(800_000))
    assert len(text) > 4 << 20 and len(list(words.slices(text.encode()))) > 1
    got = sh.near_duplicates(spark.createDataFrame([(1, text, "", 0, 0), (2, text.lower(), "", 0, 0)], SCHEMA)).collect()
    shingles = text.lower().split()
    hashes = [xxhash.xxh64_intdigest(" ".join(shingles[i : i + 3]), 42) for i in range(len(shingles) - 2)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert {(r.fingerprint, r.component_id) for r in got} == {(f"{want:016x}", 1)}


def test_empty(spark):
    assert sh.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
