import struct
from collections import Counter, defaultdict

import corpus_pipeline as cp
from tokenizers import Tokenizer

from adsieve.llm import line_quality as lq
from adsieve.llm import mixing
from adsieve.llm.storage import keep
from tests.llm.test_jaccard_join import brute as groups
from tests.llm.test_jaccard_join import shingles
from tests.llm.test_suffix_dedup import brute as without

SF = "/root/testdata/sf0.001"
ODD = "doc_id long, text string, lang string, source string, n_chars long"


def test_every_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(140)
    names = docs.columns
    kept = keep(cp.quality(spark, docs, SF), "kept", scoped=False)
    want = {}
    for r in docs.collect():
        fine, text = lq.judge_text((r.text or "").encode(), 20, 30, 50)[-2:]
        if fine:
            want[r.doc_id] = text
    assert {r.doc_id: r.text for r in kept.collect()} == want and kept.columns == names

    single = keep(cp.near_duplicates(spark, kept, SF), "single", scoped=False)
    ids = sorted(want)
    label = linked([want[i] for i in ids])
    assert sorted(r.doc_id for r in single.collect()) == [i for k, i in enumerate(ids) if label[k] == k] and single.columns == names

    rows = {r.doc_id: r.text for r in single.collect()}
    plain = keep(cp.repeated_passages(spark, single, SF), "plain", scoped=False)
    removed = without([rows[i] for i in sorted(rows)], 200)
    got = {r.doc_id: r for r in plain.collect()}
    for i, (n, gone, _, bytes_left) in zip(sorted(rows), removed):
        if i in got:
            assert len(got[i].text.encode()) - len(bytes_left) in range(0, 7) and (gone or got[i].text == rows[i])
            assert got[i].n_chars == len(got[i].text)
        else:
            assert len(bytes_left.split()) <= 1
    assert plain.columns == names

    mixed = keep(cp.mixture(spark, plain, SF), "mixed", scoped=False)
    copies = Counter(r.doc_id for r in mixed.collect())
    assert set(copies) == set(got) and set(copies.values()) <= {1, 2} and mixed.columns == names

    coder = Tokenizer.from_file(cp.TOKENIZER)
    found, used = defaultdict(list), Counter()
    for p in cp.sequences(spark, mixed, SF).collect():
        found[p.doc_id].append((p.start, p.length, p.ids, p.doc_tokens))
        used[p.sequence_id] += p.length
    assert max(used.values()) <= 2048
    for i, n in copies.items():
        ids_of = coder.encode(got[i].text, add_special_tokens=False).ids + [1]
        covered = Counter()
        for start, length, ids_, total in found[i]:
            assert list(struct.unpack(f"<{length}I", ids_)) == ids_of[start : start + length] and total == len(ids_of)
            covered.update(range(start, start + length))
        assert covered == Counter({k: n for k in range(len(ids_of))})


def test_mixture_is_in_order(spark):
    rows = [(i, f"word {i} " * 5, "en", "small" if i % 8 == 0 else "large", 1) for i in range(400)]
    docs = spark.createDataFrame(rows, ODD)
    got = [r.doc_id for r in cp.mixture(spark, docs, "").collect()]
    mixed = mixing.mix(docs, max_repeats=1.5, budget=None).collect()
    assert Counter(got) == Counter(r.doc_id for r in mixed) and len(got) > 400
    at = {(r.doc_id, r.mix_epoch): r.mix_block for r in mixed}
    seen, order = Counter(), []
    for i in got:
        order.append((seen[i], at[i, seen[i]]))
        seen[i] += 1
    assert order == sorted(order) and got[:400] != sorted(got[:400])


def linked(texts):
    sets = [shingles(t, 5) for t in texts]
    label = list(range(len(texts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                x, y = sorted((root(i), root(j)))
                label[y] = x
    return [root(i) for i in range(len(texts))]


def test_run_and_odd_rows(spark, tmp_path):
    text = "".join(f"Row {k} of table {k * 5} tells {k * 11} things, and {k + 7} more.\n" for k in range(9))
    other = "".join(f"Nothing here {k * 3} repeats what {k} another text may say about {k * k}.\n" for k in range(9))
    rows = [(1, text, "en", "a", 1), (2, text, "en", "b", 1), (2, text, "en", "b", 1), (None, other, None, None, None), (4, None, None, None, None), (5, "", "en", "a", 0)]
    spark.createDataFrame(rows, ODD).write.parquet(f"{tmp_path}/documents.parquet")
    got = cp.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == {1, None}
    one = spark.createDataFrame([(3, text, "en", "a", 1), (3, text, "en", "a", 1)], ODD)
    assert cp.near_duplicates(spark, one, "").count() == 1
    spark.createDataFrame([], ODD).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert cp.run(spark, f"{tmp_path}/none").count() == 0
    assert groups(["a b c", "a b c"], 90)[1][1] == 0
