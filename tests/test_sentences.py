"""Learned sentence boundaries on a labelled fixture."""

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from adsieve.operators import chunking, sentences
from adsieve.plans import jobs

SF = "/root/testdata/sf0.001"
# A bar stands where a sentence ends.
LABELLED = [
    "Phòng khám ở TP. Hồ Chí Minh mở cửa lúc 7.30 sáng. |BS. An và ThS. Bình trực. |Giá 1.500 đồng.",
    "Xin gọi BS. Hoa trước! |Chờ… một lát… |Rồi vào. |(TP. Thủ Đức ở xa.) Ngày 3. 5 nghỉ?",
    "BS. A. Nguyễn rất tốt... và rẻ. |Đúng thế.",
    "Ông A. và bà B. |",
    "Không có gì",
    "",
]


def test_labelled_boundaries(spark):
    learnt = sentences.learn(jobs.spoken(spark, SF))
    assert {"tp", "bs", "ths", "gs"} <= set(learnt.abbreviations)
    docs = spark.createDataFrame([(k, t.replace("|", "")) for k, t in enumerate(LABELLED)] + [(9, None)], "doc_id long, text string")
    got = {r.doc_id: r.s for r in docs.select("doc_id", learnt.split(F.col("text")).alias("s")).collect()}
    for k, text in enumerate(LABELLED):
        want = [p.strip() for p in text.split("|") if p.strip()]
        assert [p.text for p in got[k]] == want
        assert all(text.replace("|", "")[p.start : p.end] == p.text for p in got[k])
    assert got[9] is None
    plain = docs.select("doc_id", chunking.by_marks(F.col("text")).alias("s")).where("doc_id = 0").first().s
    assert len(plain) > len(got[0])
    cut = chunking.chunks(docs, 9, learnt.split).where("doc_id = 0").orderBy("chunk_id").collect()
    assert [c.text for c in cut] == ["Phòng khám ở TP. Hồ Chí Minh mở cửa lúc 7.30 sáng.", "BS. An và ThS. Bình trực. Giá 1.500 đồng."]


def test_scores_equal_plain_formulas(spark):
    texts = ["Cty. abc mua. Cty. xyz bán. Hôm nay cty. def nghỉ.", "Hôm nay mua. Hôm nay bán. abc xyz."] * 20
    rows = sentences.statistics(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    words = [w for t in texts for w in t.lower().split()]
    n, dots = len(words), sum(w.endswith(".") for w in words)
    dot, plain = Counter(w[:-1] for w in words if w.endswith(".")), Counter(w for w in words if not w.endswith("."))
    for kind in dot:
        a, b = dot[kind], plain[kind]
        ratio = -2 * (a * math.log(dots / n) + b * math.log(1 - dots / n) - a * math.log(0.99) - b * math.log(0.01))
        score = ratio * math.exp(-len(kind)) * len(kind) ** -b
        found = [r for r in rows if (r.kind, r.item) == ("abbreviation", kind)]
        assert bool(found) == (score >= 0.3) and all(abs(r.score - score) < 1e-9 and r.n == a for r in found)
    assert any(r.item == "cty" for r in rows)


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    learnt = sentences.learn(empty)
    assert learnt == sentences.Boundaries()
    docs = spark.createDataFrame([(1, "An ba. Cu dê.")], "doc_id long, text string")
    assert [p.text for p in docs.select(learnt.split(F.col("text")).alias("s")).first().s] == ["An ba.", "Cu dê."]


def test_texts_are_passed_once_whatever_is_asked_of_their_words(spark):
    """Words are counted as written, then by type: as word by word; the statistics' plan reads no text again."""
    texts = ["Ô. an (BS.) \"Lê.\" x… ¿y", "BS. \"'( an ...  Xin! \"", "  ", "", None, "an"]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    bare = lambda w: re.sub("^[\"'“‘«(\\[{]+|[\"'”’»)\\]},;:]+$", "", w).lower()
    kind = lambda w: re.sub(r"\.+$", "", bare(w))
    wanted = Counter()
    for text in texts:
        words = (text or "").split()
        for word, after in zip(words, [*words[1:], None]):
            goes_on = after is not None and bool(re.search("[.!?…]$", bare(word)))
            dot = bare(word).endswith(".") and not bare(word).endswith("..")
            wanted[kind(word), dot, kind(after) if goes_on else "", goes_on] += 1
    assert {tuple(r)[:4]: r["n"] for r in sentences.tallies(docs).collect()} == wanted
    plan = sentences.statistics(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan


def test_learning_passes_the_texts_once(spark):
    docs = jobs.spoken(spark, SF)
    seen = spark.sparkContext.accumulator(0)
    counted = docs.rdd.map(lambda r: seen.add(1) or r).toDF(docs.schema)
    learnt = sentences.learn(counted)
    assert learnt.abbreviations and seen.value == docs.count()


def test_all_that_is_learned_is_kept(spark):
    """More starters than the 2,000 that were once kept: each decides."""
    text = F.repeat(F.concat(F.lit("W"), F.col("id"), F.lit(" aa bb cc hh dd ee ff gg hh. ")), 10)
    docs = spark.range(2100).select("id", text.alias("text"))
    learnt = sentences.learn(docs)
    assert learnt.starters == sorted(f"w{k}" for k in range(2100))
    known = sentences.Boundaries(["hh"], learnt.starters)
    n = docs.select(F.size(known.split(F.col("text"))).alias("n")).groupBy("n").count().collect()
    assert [tuple(r) for r in n] == [(10, 2100)]
