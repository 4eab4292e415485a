import random
from collections import Counter

import numpy as np
import pytest

from adsieve.llm import suffix_dedup as sd

SCHEMA = "doc_id long, text string, masks string, answers string, block_id long"


def brute(texts, size):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i : i + size] for t in raw for i in range(len(t) - size + 1))
    out = []
    for t in raw:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - size + 1):
            if seen[t[i : i + size]] > 1:
                gone[i : i + size] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int), [0]])) == 1).sum())
        out.append((len(t), int(gone.sum()), spans, bytes(b for b, g in zip(t, gone) if not g)))
    return out


def corpus(seed):
    rng = random.Random(seed)
    letters = "abcdé ü"
    make = lambda n: "".join(rng.choice(letters) for _ in range(n))
    texts = [None, "", "abc", "a" * 500, "a" * 90, "ab" * 200, make(30)]
    passages = [make(rng.randrange(20, 200)) for _ in range(5)]
    for _ in range(60):
        t = make(rng.randrange(150))
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            t += p[a : a + rng.randrange(5, 200)] + make(rng.randrange(30))
        texts.append(t)
    base = make(400)
    for _ in range(40):  # a group of near copies
        own = list(base)
        for _ in range(rng.randrange(3)):
            own[rng.randrange(len(own))] = rng.choice("xyz")
        texts.append("".join(own))
    texts += texts[10:14]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("hot", [1, 3, 5])
def test_hot_anchors(spark, hot):
    for size in (8, 40):
        texts = corpus(size + hot)
        rows = [(i, t, "", "", 1) for i, t in enumerate(texts)]
        want = brute(texts, size)
        for r in sd.remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(4), size, hot=hot).collect():
            assert (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) == want[r.doc_id], texts[r.doc_id]


@pytest.mark.parametrize("size,chunk", [(8, 1 << 20), (40, 1 << 20), (40, 64), (41, 100)])
def test_against_brute_force(spark, size, chunk, monkeypatch):
    if chunk < 1 << 20:
        monkeypatch.setattr(sd, "CHUNK", chunk)
        texts = corpus(size)
        own = sd.Segments([(t or "").encode() for t in texts], size, size // 2)
        covered = [s + k for s, n in zip(own.starts.tolist(), own.counts.tolist()) for k in range(n)]
        want = [e - len((t or "").encode()) + k for e, t in zip(own.ends.tolist(), texts) for k in range(max(0, len((t or "").encode()) - size + 1))]
        assert sorted(covered) == want
        return
    texts = corpus(size)
    rows = [(i, t, "", "", 1) for i, t in enumerate(texts)]
    got = sd.remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(5), size, shard=300).collect()
    want = brute(texts, size)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) == want[r.doc_id], texts[r.doc_id]


def test_repeated_windows():
    rng = random.Random(1)
    parts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(4, 40))) for _ in range(30)]
    got = sd.repeated_windows(np.frombuffer(b"".join(parts), np.uint8), np.array([len(p) for p in parts]), 6)
    seen = Counter(p[i : i + 6] for p in parts for i in range(len(p) - 5))
    want = [seen[p[i : i + 6]] > 1 for p in parts for i in range(len(p))]
    assert got.tolist() == want


def test_anchor_sizes():
    assert sd.anchor_sizes(200) == [100, 150, 175, 188, 194, 197, 199, 200]
    assert all(sd.anchor_sizes(n)[-1] == n for n in range(2, 70))


def test_levels_part_windows():
    """Whatever anchors are hot, each window lies in one segment of one level, and equal windows share their anchor."""
    texts, size = [(t or "").encode() for t in corpus(3)], 40
    seen, allowed = np.zeros(sum(map(len, texts)), int), None
    rng, anchor_of = random.Random(4), {}
    hot = {}
    for anchor in sd.anchor_sizes(size):
        own = sd.Segments(texts, size, anchor, allowed)
        last = anchor == size
        flags = np.array([not last and hot.setdefault((anchor, a), rng.random() < 0.5) for a in own.anchors.tolist()], bool)
        for k, (s, n) in enumerate(zip(own.starts.tolist(), own.counts.tolist())):
            if not flags[own.which[k]]:
                seen[s : s + n] += 1
                for p in range(s, s + n):
                    text = own.data[p : p + size].tobytes()
                    assert anchor_of.setdefault(text, (anchor, own.anchors[own.which[k]])) == (anchor, own.anchors[own.which[k]])
        allowed = own.windows_of(flags)
    want = np.concatenate([np.arange(len(t)) < len(t) - size + 1 for t in texts])
    assert (seen == want).all()


def test_production_sorts_recurse_and_spill(monkeypatch):
    """A shard of some megabytes goes through the queue's file, scratch files and recursion at the default sizes."""
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(3000)]
    passages = [" ".join(rng.choices(words, k=120)) for _ in range(300)]
    texts = []
    for k in range(6500):
        own = rng.choice(passages).split()
        for _ in range(2):
            own[rng.randrange(len(own))] = rng.choice(words)
        texts.append(" ".join(own + rng.choices(words, k=30)).encode())
    data, lengths = np.frombuffer(b"".join(texts), np.uint8), np.array(list(map(len, texts)))
    calls, spills = [], []
    whole, spill = sd.induced_sort.induce, sd.induced_sort.DiskQueue._spill
    monkeypatch.setattr(sd.induced_sort, "induce", lambda text, *a: calls.append(len(text)) or whole(text, *a))
    monkeypatch.setattr(sd.induced_sort.DiskQueue, "_spill", lambda self: spills.append(1) or spill(self))
    got = sd.repeated_windows(data, lengths, 200)
    assert len(calls) > 1 and calls[1] < calls[0] / 2 and spills
    seen, names = Counter(), []
    for t in texts:
        names += [hash(t[i : i + 200]) if i + 200 <= len(t) else None for i in range(len(t))]
    seen.update(n for n in names if n is not None)
    assert got.tolist() == [n is not None and seen[n] > 1 for n in names]


def test_whole_characters():
    text = "aéüb".encode()
    assert sd.whole_characters(text, [(2, 2)]) == "aéüb"  # half of é, half of ü
    assert sd.whole_characters(text, [(1, 3)]) == "aüb"
    assert sd.whole_characters(text, [(0, 6)]) == ""


def test_nulls_repeats_and_empty(spark):
    text = "".join(chr(97 + k % 26) + str(k) for k in range(200))
    rows = [(None, text, None, None, None), (3, text, None, None, None), (3, text[:100], None, None, None)]
    got = sorted((r.n_bytes, r.n_removed) for r in sd.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(100, 0), (len(text), len(text)), (len(text), len(text))]
    assert sd.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
