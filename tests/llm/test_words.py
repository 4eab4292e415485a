from hypothesis import given
from hypothesis import strategies as st

from adsieve.llm.words import slices, sole


@given(st.lists(st.sampled_from(["a", "bcd", " ", "\n", "é", "\x0b"])), st.integers(1, 9))
def test_slices_never_part_words(parts, size):
    text = "".join(parts).encode()
    cut = list(slices(text, size))
    assert b"".join(text[a:b] for a, b in cut) == text
    assert [w for a, b in cut for w in text[a:b].split()] == text.split()


def test_one_cache_at_a_time():
    a, b = {1: 1}, {}
    assert sole(a) is a and a
    sole(b)
    assert not a
    a[2] = 2
    assert sole(a) == {2: 2}
