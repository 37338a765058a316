"""Blocks and opcodes equal to the standard library's, and the time for long texts."""

import difflib
import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from glyphlex.operators import matching
from glyphlex.operators.diff import diff_blocks
from glyphlex.operators.matching import Matcher


def edited(text, share, letters, r):
    out = []
    for ch in text:
        kind = r.random()
        if kind < share / 3:
            continue
        out.append(r.choice(letters) if kind < 2 * share / 3 else ch)
        if kind > 1 - share / 3:
            out.append(r.choice(letters))
    return "".join(out)


def check(a, b):
    assert Matcher(None, a, b).get_opcodes() == difflib.SequenceMatcher(None, a, b).get_opcodes()


@pytest.mark.parametrize("seed", range(40))
def test_opcodes_equal(seed, monkeypatch):
    r = random.Random(seed)
    if seed % 2:  # the digest search on short ranges too
        monkeypatch.setattr(matching, "SHORT", r.choice([0, 3]))
        monkeypatch.setattr(matching, "SMALL", 0)
    letters = [chr(0x100 + k) for k in range(r.choice([2, 3, 10, 60, 120, 150, 400, 3000]))]
    n = r.choice([5, 60, 199, 200, 201, 700, 2500])
    a = "".join(r.choice(letters) for _ in range(n))
    b = r.choice([lambda: edited(a, 0.05, letters, r), lambda: edited(a, 0.5, letters, r),
                  lambda: "".join(r.choice(letters) for _ in range(n)), lambda: a[n // 2:] + a[:n // 2],
                  lambda: a[:n // 3] * 3, lambda: a[::-1]])()
    check(a, b)
    check(b, a)


@settings(max_examples=150, deadline=None)
@given(st.text("abc ", max_size=260), st.text("abc ", max_size=260))
def test_few_letters(a, b):
    check(a, b)


def test_repeats_and_odd_characters():
    unit = "".join(chr(0x4E00 + k) for k in range(150))
    for a, b in ((unit * 8, unit * 7 + "x"), (unit * 6, unit[75:] + unit * 6), ("x" * 900, "x" * 700),
                 ("ab" * 300, "ba" * 300), ("", "a" * 300), ("\U0010ffff\U0010fffe" * 150 + unit, unit * 3),
                 ("".join(c + "," for c in unit * 2), "".join(c + "," for c in unit[20:] * 2))):
        check(a, b)


@pytest.mark.parametrize("letters", [150, 3000])
def test_long_texts(letters):
    r = random.Random(letters)
    pool = [chr(0x4E00 + k) for k in range(letters)]
    a = "".join(r.choice(pool) for _ in range(100_000))
    b = edited(a, 0.05, pool, r)
    began = time.time()
    blocks = list(diff_blocks(a, b))
    assert time.time() - began < 6  # below 3 s on a machine with nothing else to do
    assert "".join(t for op, t in blocks if op != "+") == a
    assert "".join(t for op, t in blocks if op != "-") == b


def test_every_twentieth_character():
    r = random.Random(1)
    a = [chr(0x4E00 + r.randrange(500)) for _ in range(40_000)]
    b = a[:]
    b[::20] = ["x"] * len(b[::20])
    began = time.time()
    blocks = list(diff_blocks("".join(a), "".join(b)))
    assert time.time() - began < 6
    assert sum(len(t) for op, t in blocks if op == " ") == 38_000
