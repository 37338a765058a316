"""The fold of one text equals the plain loop, and is not quadratic in long texts."""

import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from glyphlex.operators.fold import Dictionary, fold_text


def plain(text, entries):
    for k, v in entries:
        if k:
            text = text.replace(k, v)
    return text


small = st.text("ab🐶", max_size=4)


@settings(max_examples=600, deadline=None)
@given(st.text("ab🐶", max_size=30), st.lists(st.tuples(small, small), max_size=8))
def test_cascades_and_repeated_keys(text, entries):
    assert fold_text(text, Dictionary(entries)) == plain(text, entries)


@settings(max_examples=200, deadline=None)
@given(st.text("ab", max_size=60), st.lists(st.tuples(
    st.sampled_from(["aa", "aba", "abab", "aaa", "b", "ba"]), st.sampled_from(["", "a", "b", "ab", "aab", "bb"])),
    max_size=10))
def test_keys_that_overlap_themselves(text, entries):
    assert fold_text(text, Dictionary(entries)) == plain(text, entries)


@pytest.mark.parametrize("seed", range(10))
def test_long_words(seed):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdef") for _ in range(r.randint(1, 6))) for _ in range(60)]
    entries = [(r.choice(words)[:r.randint(1, 6)], r.choice(words + [""])) for _ in range(25)]
    text = " ".join(r.choice(words) for _ in range(100))
    assert fold_text(text, Dictionary(entries)) == plain(text, entries)


def test_without_text_or_keys():
    assert fold_text(None, Dictionary([("a", "b")])) is None
    assert fold_text("", Dictionary([("a", "b")])) == ""
    assert fold_text("ab", Dictionary([])) == fold_text("ab", Dictionary([("", "x")])) == "ab"
    assert fold_text("aaa", Dictionary([("aa", ""), ("a", "")])) == ""
    assert [Dictionary([("a", "")]).occurs(t) for t in ("ba", "b", "", None)] == [True, False, False, None]


def test_ten_thousand_words_and_five_thousand_keys():
    r = random.Random(5)
    keys = [f"w{k}x" for k in range(5000)]
    entries = [(k, f"<{k[1:-1]}>") for k in keys]
    text = " ".join(r.choice(keys) for _ in range(10_000))
    dictionary = Dictionary(entries)
    began = time.time()
    got = fold_text(text, dictionary)
    took = time.time() - began
    assert got == plain(text, entries)
    assert took < 1.5  # below 0.7 s on a machine with nothing else to do
