"""Texts that differ by characters which the other lacks are diffed without a search,
and an ASCII text is not searched for symbols; the results stay the same."""

import difflib
import random

import pytest
from pyspark.sql import functions as F

from glyphlex.functions import symbols as sym
from glyphlex.operators import diff, matching

WORDS = [f"w{i * 37 % 91}{chr(97 + i % 26)} e" for i in range(80)]


def texts(seed, n):
    """Pairs of the same pieces between symbols and words, some with a flaw."""
    r = random.Random(seed)
    for _ in range(n):
        letters = r.choice(["ab", "abc ", "eta nqzxj", "abcdefghijklmnop qz"])
        size = r.choice([2, 5, 12, 90])
        a = b = ""
        for i in range(r.choice([1, 2, 3, 5, 10])):
            piece = "".join(r.choice(letters) for _ in range(r.randint(1, size)))
            if i or r.random() < 0.3:
                a += "".join(r.choice("🐶🐱") for _ in range(r.randint(1, 3)))
            if i or r.random() < 0.3:
                b += "".join(r.choice("狗猫" if r.random() < 0.95 else "狗a") for _ in range(r.randint(1, 3)))
            a, b = a + piece, b + piece
        yield a + r.choice(["", "🐶"]), b + r.choice(["", "狗", "狗" * 30])


@pytest.mark.parametrize("words", [6, 80])  # the longer text has popular characters
def test_symbols_for_words_need_no_search(monkeypatch, words):
    def none(*_a):
        raise AssertionError("a search")
    monkeypatch.setattr(matching.Matcher, "_by_find", none)
    monkeypatch.setattr(matching.Matcher, "_by_digests", none)
    a = " ".join("🤵\u200d♂️" if i % 20 == 3 else w for i, w in enumerate(WORDS[:words]))
    b = " ".join("帅哥" if i % 20 == 3 else w for i, w in enumerate(WORDS[:words]))
    assert (len(b) >= matching.POPULAR_FROM) == (words == 80)
    n = sum(i % 20 == 3 for i in range(words))
    assert diff.extract_pairs(a, b) == [("🤵\u200d♂️", "帅哥")] * n


def test_blocks_are_those_of_the_library():
    some = 0
    for a, b in [*texts(5, 4000), ("", ""), ("", "x"), ("x", ""), ("🐶", "狗"), ("aa🐶aa", "aa狗aa")]:
        own = matching.Matcher(None, a, b)
        some += matching._aligned(a, b, own.bpopular) is not None
        assert own.get_matching_blocks() == difflib.SequenceMatcher(None, a, b).get_matching_blocks(), (a, b)
    assert some > 3000


def test_ascii_texts_hold_no_symbol(spark):
    rows = [None, "", "a 1 # *", "1\ufe0f\u20e3", "a 🐶 b", "é", "#\u20e3", "🤵\u200d♂️x❤️", "\u00a9 c"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, t string")
    slow = sym.Symbols(sym.SYMBOL_PATTERN, sym.PLAIN_RUN)
    got = df.orderBy("i").select(sym.extract_symbols("t").alias("a"), sym.extract_symbols("t", slow).alias("b")).collect()
    assert [r.a for r in got] == [r.b for r in got]
    assert got[0].a is None and got[2].a == [] and got[4].a == ["🐶"]
    plan = df.select(sym.extract_symbols(F.col("t")).alias("a"))._jdf.queryExecution().optimizedPlan().toString()
    assert "octet_length" in plan
    listed = sym.closed_list(["ab", "🐶"])  # a list may hold ASCII symbols
    assert df.select(sym.extract_symbols(F.lit("xab"), listed).alias("a")).first().a == ["ab"]
