from __future__ import annotations

import brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from parcelflow.llm.words import PLAIN, SPACED, Words, pieces, spans_of, windows

TEXTS = st.lists(st.text(alphabet="aZ09 \t\n\x0b-_|é漢 \x1c\x7f", max_size=30), min_size=1, max_size=6)


def _cut(texts, letters, lower):
    words = Words(pa.array(texts, pa.large_string()), letters, lower)
    return [
        [words.data[s:e].tobytes().decode() for s, e in zip(words.start[a:b], words.end[a:b], strict=True)]
        for a, b in zip(words.first[:-1], words.first[1:], strict=True)
    ]


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_patterns(texts):
    assert _cut(texts, SPACED, False) == [brute.SPACED.findall(t) for t in texts]
    assert _cut(texts, PLAIN, True) == [brute.PLAIN.findall(brute.lowered(t)) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "abcdefgh", "abcdefghi", "x" * 40, "x" * 41]), min_size=1, max_size=40), st.integers(1, 9))
def test_equal_windows_have_equal_hashes(words, size):
    hashes = windows(Words(pa.array([" ".join(words)], pa.large_string()), SPACED).hashes(), size)
    texts = [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]
    assert len(hashes) == len(texts)
    assert len(set(hashes.tolist())) == len(set(texts))
    assert all((hashes[i] == hashes[j]) == (texts[i] == texts[j]) for i in range(len(texts)) for j in range(i))


def test_pieces_cut_between_texts_only():
    text = pa.array(["a" * 10, None, "b" * 100, "", "c"], pa.string()).slice(1)
    got = list(pieces(None, text, 20))
    assert [t for _, part in got for t in part.to_pylist()] == ["", "b" * 100, "", "c"]
    assert [first for first, _ in got][0] == 0


@pytest.mark.parametrize("hit", [[], [True], [False, True, True, False, True]])
def test_spans(hit):
    begin, end = spans_of(np.array(hit, bool))
    assert [list(range(a, b)) for a, b in zip(begin, end, strict=True)] == {0: [], 1: [[0]], 5: [[1, 2], [4]]}[len(hit)]
