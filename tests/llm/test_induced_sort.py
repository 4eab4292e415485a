import random

import numpy as np
import pytest

from adsieve.llm import induced_sort as ind


def brute(text):
    """Separators differ and are ordered by place."""
    unique = [(0, k) if c == 0 else (1, c) for k, c in enumerate(text)]
    order = sorted(range(len(text)), key=lambda i: unique[i:])
    common = [0]
    for a, b in zip(order, order[1:]):
        n = 0
        while a + n < len(text) and b + n < len(text) and unique[a + n] == unique[b + n]:
            n += 1
        common.append(n)
    return order, common


def strings():
    rng = random.Random(8)
    yield [0]
    yield [0, 0, 0]
    yield [1, 1, 1, 1, 0]
    yield [0, 2, 1, 0, 2, 1, 0]
    yield [3, 2, 1, 2, 3, 0]
    yield [2, 1] * 40 + [0]
    yield [1, 2] * 40 + [0]
    for n in range(1, 260):
        sigma = rng.choice([1, 2, 3, 5, 200])
        text = [rng.choice([0] + [rng.randrange(1, sigma + 1)] * 20) for _ in range(n)]
        if rng.random() < 0.5:
            text += text[: n // 2] * rng.randrange(3)
        yield text + [0]


@pytest.mark.parametrize("base", [1 << 24, 0])
def test_against_brute_force(base, monkeypatch):
    monkeypatch.setattr(ind, "STEP", 7)
    for text in strings():
        order, common = ind.suffix_array(np.array(text), base=base, limit=200)
        assert (order.tolist(), common.tolist()) == brute(text), text


def test_queue_spills_and_keeps_order():
    queue = ind.DiskQueue(limit=300)
    rng, want = random.Random(2), {}
    for k in range(200):
        symbol = rng.randrange(4)
        part = ind.entries(np.arange(k, k + 5), np.arange(5))
        queue.push(symbol, part)
        want.setdefault(symbol, []).append(part)
        if k % 50 == 49:
            for s in range(4):
                got = list(queue.pop(s))
                assert (np.concatenate(got) == np.concatenate(want.pop(s))).all()
    assert queue.file is not None
    queue.close()
