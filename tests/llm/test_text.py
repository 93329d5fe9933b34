import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from filetally.llm.text import buffer_of, runs, slices, word_bounds, words

TEXT = st.text(alphabet="aAbZ é\n\t.\x85\xa0\x0b", max_size=30)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), min_size=1, max_size=6))
def test_words_are_those_of_the_pattern(texts):
    data, bounds = buffer_of(pa.array(texts, pa.string()))
    hashes, starts, ends, before = words(data, bounds)
    found = slices(data, starts, ends).to_pylist()
    expected = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert [found[a:b] for a, b in zip(before, before[1:], strict=False)] == expected
    folded = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for ws in expected for w in ws]
    same = {}
    for h, w in zip(hashes.tolist(), folded, strict=True):
        assert same.setdefault(w, h) == h
    assert len(set(same.values())) == len(same)


def test_slices_of_a_batch_keep_their_own_texts():
    column = pa.array(["one two", None, "three", "", "four"], pa.string()).slice(1, 3)
    data, bounds = buffer_of(column)
    assert bounds.tolist() == [0, 0, 5, 5] and bytes(data) == b"three"


def test_a_text_longer_than_a_piece_is_one_run():
    assert list(runs(np.array([0, 10, 500, 505]), 20)) == [(0, 1), (1, 2), (2, 3)]


def test_words_end_at_the_bounds_of_texts():
    starts, ends = word_bounds(np.frombuffer(b"abcd", np.uint8), np.array([0, 2, 4]))
    assert starts.tolist() == [0, 2] and ends.tolist() == [2, 4]
