import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from adsieve.llm import mixing as mx

SCHEMA = "doc_id long, text string, source string, copies long, n string, rest long"


def docs(spark):
    rows = [(i, "w " * (1 + i % 7), "big" if i % 3 else f"s{i % 5}", 1, None, 2) for i in range(400)]
    rows += [(1000, None, None, 0, "", 0), (1001, "", None, 0, "", 0), (1002, "a b c\td", None, 0, "", 0), (5, "w w", "s1", 1, "", 1), (5, "w w", "s1", 1, "", 1)]
    return spark.createDataFrame(rows + [(2000, None, "void", None, None, None)], SCHEMA)


def test_token_count(spark):
    df = spark.createDataFrame([("",), (None,), (" a  b\n",), ("é x y\x0bz",), (" \t",)], "t string")
    assert [r[0] for r in df.select(mx.token_count(F.col("t"))).collect()] == [0, 0, 2, 3, 0]


@pytest.mark.parametrize("target", [{"max_repeats": 2.0}, {"target_entropy": 1.3}, {"max_repeats": 1.5, "budget": None}])
def test_against_brute_force(spark, target):
    df = docs(spark)
    block = 40
    got = mx.mix(df, block_tokens=block, **target).collect()
    rows = df.select("*", mx.token_count(F.col("text")).alias("tokens")).collect()
    tokens = Counter()
    for r in rows:
        tokens[r.source] += r.tokens
    total = sum(tokens.values())
    weights = {r.source: r.mix_weight for r in got}
    exponents = [math.log(weights[a] / weights["big"]) / math.log(tokens[a] / tokens["big"]) for a in weights if a != "big" and tokens[a]]
    assert max(exponents) - min(exponents) < 1e-9
    if "target_entropy" in target:
        assert abs(mx.entropy(weights) - 1.3) < 1e-9
    budget = total if target.get("budget", 1) else max(tokens[s] / w for s, w in weights.items() if w)
    spent = Counter()
    for r in got:
        spent[r.source] += r.mix_tokens
    for source, n in tokens.items():
        if n:
            assert -1 <= spent[source] - weights[source] * budget <= 8
            if "max_repeats" in target:
                assert weights[source] * budget <= target["max_repeats"] * n * (1 + 1e-6)
    # the copies of each document follow from the blocks' order alone
    keys = df.select("doc_id", "source", F.xxhash64(F.lit(mx.SEED), "doc_id", "text").alias("h"), F.xxhash64(F.lit(mx.SEED + 1), "doc_id", "text").alias("g"), mx.token_count(F.col("text")).alias("tokens")).collect()
    blocks = defaultdict(list)
    for r in keys:
        blocks[r.source, r.h % (1 + tokens[r.source] // block)].append(r)
    named = spark.createDataFrame([(s, b) for s, b in blocks], "s string, b long")
    order = {(r.s, r.b): r.k for r in named.select("s", "b", F.xxhash64(F.lit(mx.SEED), F.coalesce("s", F.lit("")), "b").alias("k")).collect()}
    want = Counter()
    for source, n in tokens.items():
        own = round(weights.get(source, 0) * budget)
        passes, rest = (own // n, own % n) if n else (int(target.get("budget", 1) is None), 0)
        taken = 0
        for k in sorted((k for k in blocks if k[0] == source), key=order.get):
            whole = sum(r.tokens for r in blocks[k])
            cut = taken + whole >= rest > taken
            for r in sorted(blocks[k], key=lambda r: (r.g, r.doc_id)):
                want[r.doc_id] += passes + ((taken < rest) if rest and (cut or taken < rest) else 0)
                taken += r.tokens if cut else 0
            taken += 0 if cut else whole
    found = Counter(r.doc_id for r in got)
    odd = {d for d in want if found[d] != want[d]} - {1000, 1001}
    assert not odd
    if target.get("budget", 1) is None:
        assert set(want) == set(found)
    assert got[0].asDict().keys() == {*df.columns, "mix_tokens", "mix_weight", "mix_epoch", "mix_block"}


def test_limits(spark):
    assert mx.mix(docs(spark).limit(0), max_repeats=2).count() == 0
    with pytest.raises(ValueError):
        mx.mix(docs(spark))
    assert abs(mx.choose_exponent({"a": 90, "b": 10}, lambda w: 100, max_repeats=3.0) - math.log(3 / 7) / math.log(1 / 9)) < 1e-9


@pytest.mark.parametrize("target", [{"max_repeats": 2.0}, {"target_entropy": 1.3}, {"max_repeats": 1.5, "budget": None}, {"max_repeats": 99.0}, {"target_entropy": 0.01}])
def test_many_sources_give_the_same_mix(spark, target):
    rows = lambda df: sorted((r.doc_id or 0, r.source or "", r.mix_tokens, round(r.mix_weight, 9), r.mix_epoch, r.mix_block) for r in df.collect())
    df = docs(spark)
    assert rows(mx.mix(df, block_tokens=40, max_sources=2, **target)) == rows(mx.mix(df, block_tokens=40, **target))
    assert mx.mix(df.limit(0), max_sources=0, **target).count() == 0


def test_clashing_columns(spark):
    names = ["plan_source", "edge_key", "mix_tokens", "mix_source", "copies", "row", "taken", "before", "key_range", "mix_hash"]
    df = docs(spark).select("doc_id", "text", "source", *[F.lit(7).alias(c) for c in names])
    got = mx.mix(df, max_repeats=2, block_tokens=40)
    assert got.columns == ["doc_id", "text", "source", *[c for c in names if c != "mix_tokens"], *mx.MIX]
    assert got.select("doc_id", "mix_epoch").exceptAll(mx.mix(docs(spark), max_repeats=2, block_tokens=40).select("doc_id", "mix_epoch")).count() == 0
    assert got.where("plan_source <> 7 OR `row` <> 7").count() == 0
