from __future__ import annotations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from ledgersieve.llm import words as W
from llm_helpers import words


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB1 .é日\n-", max_size=12)), max_size=8))
def test_words_equal_the_pattern(texts):
    array = pa.array(texts, pa.string())
    found = []
    for _, _, w in W.each_slice(array, budget=10):
        found += [[w.text[a:b].tobytes().decode() for a, b in zip(w.start[i:j], w.end[i:j])] for i, j in zip(w.first[:-1], w.first[1:])]
    assert found == [words(t) for t in texts]


def test_equal_words_have_equal_hashes_wherever_they_stand():
    (_, _, w), = W.each_slice(pa.array(["alpha beta", None, "beta Alpha", "gamma"]))
    a, b, c, d, e = w.hash
    assert (a, b) == (d, c) and len({a, b, e}) == 3


def test_grams_stay_inside_a_text():
    (_, _, w), = W.each_slice(pa.array(["a b c d", "a b c", "b c d"]))
    hashes, at = W.grams(w.hash, w.first, 3)
    assert at.tolist() == [0, 1, 4, 7]
    assert hashes[0] == hashes[2] and hashes[1] == hashes[3] and hashes[0] != hashes[1]


def test_a_sliced_array_and_an_empty_one():
    array = pa.array(["x y", "z", "y x"]).slice(1, 2)
    (_, _, w), = W.each_slice(array)
    assert np.diff(w.first).tolist() == [1, 2]
    assert list(W.each_slice(pa.array([], pa.string()))) == []


def test_long_words_of_one_pattern_have_their_own_hash():
    """A pattern and its complement, which no sum of powers modulo 2**64 tells apart."""
    pattern = np.array([bin(i).count("1") & 1 for i in range(2048)], np.uint8) + 97
    for size in (1024, 2048):
        raw = np.r_[pattern[:size], np.uint8(32), 195 - pattern[:size]]
        found = W.find(raw, np.array([0, len(raw)]))
        assert len(found.hash) == 2 and found.hash[0] != found.hash[1]
        again = W.find(np.r_[np.uint8(32), raw], np.array([0, len(raw) + 1]))
        assert (again.hash == found.hash).all()
