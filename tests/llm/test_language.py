import math

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from adsieve.llm import language as lg

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocabulary():
    return lg.Vocabulary(PATH)


def test_forward_sums_all_segmentations(vocabulary):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    usable = [k for k in range(model.get_piece_size()) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k))]
    pieces = [p for p in map(model.id_to_piece, usable) if "▁" not in p[1:]]
    table = np.random.default_rng(0).random((vocabulary.size, 2)) / 1000
    p = {piece: table[k] for k, piece in enumerate(pieces)}

    def total(run):
        if not run:
            return np.ones(2)
        out = np.zeros(2)
        for n in range(1, len(run) + 1):
            if (q := p.get(run[:n])) is not None:
                out = out + q * total(run[n:])
            elif n == 1:
                out = out + lg.UNKNOWN * total(run[1:])
        return out

    runs = ["▁the", "▁a", "▁étion", "▁日本", "▁other", "▁ཀx"]
    assert np.allclose(lg.run_scores(vocabulary, table, runs), np.log([total(r) for r in runs]))


def test_letter_runs():
    assert lg.letter_runs("Don't3x") == ["▁don", "▁t", "▁x"]
    assert lg.letter_runs("12.") == lg.letter_runs("½ ² Ⅷ ٣") == []
    assert lg.letter_runs("हिन्दी") == ["▁हिन्दी"]
    assert [len(r) for r in lg.letter_runs("a" * 70)] == [71]
    run = "▁" + "abcdefg" * 10
    assert [len(r) for r in lg.in_parts(run)] == [33, 32, 6] and "".join(lg.in_parts(run)) == run
    assert lg.in_parts(run[:33]) == [run[:33]] and lg.in_parts(run[:34]) == [run[:33], run[33]]


def test_long_runs_equal_a_plain_forward_pass(vocabulary):
    """A run is one run however long it is: brute force in logarithms, letter by letter."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    usable = [k for k in range(model.get_piece_size()) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k))]
    pieces = [p for p in map(model.id_to_piece, usable) if "▁" not in p[1:]]
    rng = np.random.default_rng(5)
    table = rng.random((vocabulary.size, 2)) ** 4 / 1000 + 1e-9
    p = {piece: np.log(table[k]) for k, piece in enumerate(pieces)}

    def plain(run):
        sums = np.full((len(run) + 1, 2), -np.inf)
        sums[0] = 0
        for at in range(len(run)):
            for n in range(1, min(vocabulary.longest, len(run) - at) + 1):
                q = p.get(run[at : at + n])
                if q is None and n == 1:
                    q = np.log(lg.UNKNOWN)
                if q is not None:
                    sums[at + n] = np.logaddexp(sums[at + n], sums[at] + q)
        return sums[-1]

    assert 2 * vocabulary.longest - 1 <= lg.RUN + 1
    letters = "etaoinshrdluethethetionationê日本ཀ"
    runs = ["▁" + "".join(letters[i] for i in rng.integers(0, len(letters), n)) for n in (1, 15, 31, 32, 33, 34, 46, 47, 48, 49, 63, 64, 65, 500, 10_000)]
    runs += ["▁" + "ཀ" * 400, "▁" + "other" * 200]
    assert np.allclose(lg.run_scores(vocabulary, table, runs), [plain(r) for r in runs], rtol=1e-9)


def test_learning_in_spark(spark, vocabulary):
    """Expected counts don't depend on partitions, equal plain sums, and raise the likelihood."""
    words = [("x", w, 2) for w in "the other one then there".split()] + [("y", w, 1) for w in "une autre fois encore".split()]
    runs = spark.createDataFrame([(lang, "▁" + w, n) for lang, w, n in words], "lang string, run string, n long")
    tables = [lg.learn(runs.repartition(n), ["x", "y"], PATH, rounds) for n, rounds in ((1, 1), (1, 3), (5, 3))]
    assert (tables[1] == tables[2]).all()
    local = np.full((vocabulary.size, 2), 1 / vocabulary.size)
    for _ in range(3):
        own = [[("▁" + w, n) for lang, w, n in words if lang == name] for name in "xy"]
        local = lg.maximised(np.stack([lg.expected(vocabulary, local[:, [k]], [w for w, _ in ws], np.array([n for _, n in ws], float)) for k, ws in enumerate(own)], axis=1))
    assert (tables[1] == local).all()
    ll = [lg.run_scores(vocabulary, t, [r.run for r in runs.where("lang = 'x'").collect()])[:, 0].sum() for t in tables[:2]]
    assert ll[1] > ll[0]


def test_fit_runs_no_job_for_each_partition(spark):
    docs = spark.createDataFrame([(k, "a b c " * 3, "x") for k in range(60)], "doc_id long, text string, lang string").repartition(40)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("fit", "fit")
    lg.fit(docs, PATH)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < len(tracker.getJobIdsForGroup("fit")) < 20


def test_held_out_accuracy_and_cases(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = lg.fit(docs, PATH, sample_docs=80)
    found = lg.predict(docs, PATH, model).join(docs.select("doc_id", "lang"), "doc_id").where(lg.is_held_out(F.col("doc_id"))).collect()
    assert len(found) > 150
    assert sum(r.lang_pred == r.lang for r in found) >= 0.98 * len(found)
    assert all(0 <= r.score <= 1 and not math.isnan(r.score) for r in found)
    odd = spark.createDataFrame([(1, None, 1.0), (1, "", 1.0), (None, "12 34 !?", 1.0), (4, "the " * 400_000, 1.0), (5, "z" * 3000, 2.0)], "doc_id long, text string, score double")
    got = lg.predict(odd, PATH, model).collect()
    assert [r.lang_pred for r in got[:3]] == ["und"] * 3 and got[3].lang_pred in model[0] and len(got) == 5


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([(1, "a b", None)], "doc_id long, text string, lang string")
    model = lg.fit(none, PATH)
    assert [tuple(r) for r in lg.predict(none, PATH, model).collect()] == [(1, "und", 0.0)]
    assert lg.predict(none.limit(0), PATH, model).count() == 0


def test_scores_survive_forgetting(vocabulary, monkeypatch):
    monkeypatch.setattr(lg, "CACHE_WORDS", 40)
    rng = np.random.default_rng(4)
    table = rng.random((vocabulary.size, 2)) / 1000
    scorer = lg.Scorer(PATH, ["x", "y"], table)
    words = ["".join(chr(97 + k) for k in rng.integers(0, 26, 5)) for _ in range(300)]
    for k in range(0, 300, 30):
        text = " ".join(words[:10] + words[k : k + 30]).encode()
        scorer.learn_words([text])
        want = sum(lg.run_scores(vocabulary, table, lg.letter_runs(w))[0] for w in text.decode().split())
        assert np.allclose(scorer.text(text)[:2], want)
    scorer.learn_words([b"1 22 333"])
    assert not scorer.text(b"1 22 333").any()
    scorer.learn_words([" ".join(words).encode()])
    assert len(scorer.row) <= len(scorer.scores)


def test_rare_letters_do_not_underflow(vocabulary):
    table = np.full((vocabulary.size, 2), 1e-15)
    got = lg.run_scores(vocabulary, table, ["▁" + "ཀ" * lg.RUN, "▁" + "q" * lg.RUN])
    assert np.isfinite(got).all() and (got < 0).all()
    assert 0 < lg.UNKNOWN * lg.SCALE <= 1
