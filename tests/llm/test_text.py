import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from aeris.llm.text import shingle_sets, slices, words

TEXT = st.text(alphabet=st.sampled_from("aAbBé漢 \t\n\x0b\x1f"), max_size=60)
SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def lower_az(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.none() | TEXT, max_size=8))
def test_words_and_shingles_agree_with_regular_expressions(texts):
    array = pa.array(texts, pa.string())
    w = words(array)
    expected = [SPLIT.findall(lower_az(t or "")) for t in texts]
    assert [w.data[a:b].tobytes().decode() for a, b in zip(w.start, w.end)] == sum(expected, [])
    assert np.diff(w.first).tolist() == [len(e) for e in expected]
    by_hash = {}
    for h, word in zip(w.hash.tolist(), sum(expected, [])):
        assert by_hash.setdefault(h, word) == word
    for own, found in zip(expected, shingle_sets(array, 3)):
        sets = {tuple(own[i : i + 3]) for i in range(len(own) - 2)} or ({tuple(own)} if own else set())
        assert len(found) == len(sets)


def test_equal_words_hash_alike_wherever_they_stand():
    w = words(pa.array(["ab cd", "cd  ab", "x" * 5000 + " ab"]))
    h = w.hash.tolist()
    assert h[0] == h[3] == h[5] and h[1] == h[2] and len(set(h)) == 3


def test_slices_cover_all_rows():
    texts = pa.array(["a" * n if n else None for n in (5, 0, 100, 3, 3, 0)])
    assert list(slices(texts, 10)) == [(0, 2), (2, 3), (3, 6)]
    assert list(slices(pa.array([], pa.string()))) == []
