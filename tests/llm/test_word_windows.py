import random
import re

import numpy as np
import pytest
import xxhash

from adsieve.llm import blocks as bk
from adsieve.llm import word_windows as ww

SCHEMA = "doc_id long, text string, block_id string, masks string, n_words long"


def brute(rows, size):
    """rows in order; the kept words and removed counts of each."""
    seen, out = set(), []
    for text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(words)
        for i in range(len(words) - size + 1):
            w = tuple(words[i : i + size])
            if w in seen:
                gone[i : i + size] = [True] * size
            seen.add(w)
        out.append((len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g)))
    return out


@pytest.mark.parametrize("size", [1, 3, 4, 7])
def test_against_brute_force(spark, size, monkeypatch):
    rng = random.Random(size)
    texts = ["", None, "a", "a b c d e f g h", " a\tb\x0bc\nd  e\x0c\rf ", "a " * 50, "é x y z"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(40))) for _ in range(120)]
    passage = " ".join(f"w{k}" for k in range(15))
    texts += [f"x{k} {passage} y{k}" for k in range(30)]
    rows = [(i, t, "q", "q", 3) for i, t in enumerate(texts)]
    got = ww.remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(5), size).collect()
    want = brute(texts, size)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.n_removed, r.kept_text) == want[r.doc_id], (r.doc_id, texts[r.doc_id])
        assert sum(s.words for s in r.removed) == r.n_removed


def test_equal_ids_nulls_and_empty(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(7, text, None, None, None)] * 3 + [(None, text, "", "", 1)]
    got = ww.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id is None, r.n_removed) for r in got) == [(False, 30)] * 3 + [(True, 0)]
    assert ww.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_window_hash_is_the_polynomial():
    words = np.array([xxhash.xxh3_64_intdigest(str(k).encode()) for k in range(50)], np.uint64)
    for size in (1, 2, 3, 5, 20, 31, 50):
        want = []
        for i in range(len(words) - size + 1):
            h = 0
            for w in words[i : i + size].tolist():
                h = (h * ww.BASE + w) % (1 << 64)
            want.append(h)
        assert (ww.window_hashes(words, size) == bk.mixed(np.array(want, np.uint64))).all()


def test_ranges_and_planes():
    h = np.unique(np.random.default_rng(0).integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2))
    edges = bk.range_edges(h, 300)
    assert edges[0] == 0 and edges[-1] == len(h) and (np.diff(edges) >= 0).all()
    assert (bk.from_planes(bk.to_planes(h)) == h).all()


def test_equal_first_hashes_are_told_apart():
    own = ww.Windows([b"a b c d a b c x", b"q a b c"], 3)
    own.hashes = np.zeros_like(own.hashes)
    pairs = ww.Pairs(own, np.ones(len(own.hashes), bool))
    windows = ["abc", "bcd", "cda", "dab", "abc", "bcx", "qab", "abc"]
    assert len(pairs.one) == len(set(windows))
    assert [windows[k] for k in pairs.first[pairs.which]] == windows
    assert [windows.index(w) for w in windows] == pairs.first[pairs.which].tolist()
