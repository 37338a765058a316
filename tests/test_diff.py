"""Character diff, pair extraction and the reconcile walk."""

import difflib
import random
import time

import pytest

from glyphlex.operators.diff import diff_ops, extract_pairs, mine_pairs, reconcile_decision

PAIR_GOLDENS = [
    ("我爱🐶了", "我爱小狗了", [("🐶", "小狗")]),
    ("X我🐶了", "我狗了", [("X🐶", "狗")]),
    ("我爱啊🐶呀", "我很爱啊狗呀", [("🐶", "很狗")]),
    ("我🐶", "我狗", []),
    ("a 🐶b", "a狗b", [(" 🐶", "狗")]),
    ("🐶和🐱啊", "狗和猫啊", [("🐶", "狗"), ("🐱", "猫")]),
    ("🐶🐱啊", "狗猫啊", [("🐶🐱", "狗猫")]),
    ("我 爱🐶啊", "我爱狗啊", [(" 🐶", "狗")]),
]


@pytest.mark.parametrize("a,b,want", PAIR_GOLDENS)
def test_pair_goldens(a, b, want):
    assert extract_pairs(a, b) == want


def test_strict_mode_flushes_at_end():
    assert extract_pairs("我🐶", "我狗", strict=True) == [("🐶", "狗")]
    assert extract_pairs("X我🐶了", "我狗了", strict=True) == [("🐶", "狗")]


def test_block_order_goldens():
    assert [o for o in diff_ops("甲A乙", "甲a乙") if o[0] != " "] == [("-", "A"), ("+", "a")]
    assert [o for o in diff_ops("甲A乙", "甲xa乙") if o[0] != " "] == [
        ("-", "A"), ("+", "x"), ("+", "a")]
    assert [o for o in diff_ops("甲AB乙", "甲a乙") if o[0] != " "] == [
        ("+", "a"), ("-", "A"), ("-", "B")]


@pytest.mark.parametrize("raw,model,use_rule,repaired", [
    ("我爱NBA", "我爱nba", False, "我爱NBA"),
    ("AB好", "ab，好b", False, "AB，好B"),
    ("A好", "xa好", False, "xA好"),
    ("VIP客户", "vip客户啊", False, "VIP客户啊"),
    ("我爱狗", "我狗", True, None),
    ("第1名", "第名", True, None),
])
def test_reconcile_goldens(raw, model, use_rule, repaired):
    import re
    clean = re.sub("[^一-龥a-zA-Z0-9]+", "", model)
    got_rule, got_model = reconcile_decision(raw, clean, model)
    assert got_rule is use_rule
    if repaired is not None:
        assert got_model == repaired


def test_mine_pairs_spark_equals_python(spark):
    rows = [(i, a, b) for i, (a, b, _w) in enumerate(PAIR_GOLDENS)]
    df = spark.createDataFrame(rows, "row_id long, source_text string, target_text string")
    got = sorted((r.row_id, r.seq, r.key, r.text) for r in mine_pairs(df).collect())
    want = sorted((i, s, k, t) for i, (a, b, w) in enumerate(PAIR_GOLDENS)
                  for s, (k, t) in enumerate(w))
    assert got == want


def test_long_texts_are_diffed_whole():
    # past 200 characters the popular-character rule of the diff applies; the
    # text is still processed whole (no prefix, no skip)
    a = "好" * 150 + "🐶" + "好" * 150
    b = "好" * 150 + "狗" + "好" * 150
    pairs = extract_pairs(a, b)
    assert all(len(k) + len(t) > 0 for k, t in pairs)


def test_diff_table(spark):
    from glyphlex.operators.diff import diff_table
    df = spark.createDataFrame([(7, "甲AB乙", "甲a乙")], "row_id long, a string, b string")
    got = [(r.step, r.op, r.ch) for r in diff_table(df, "a", "b").orderBy("step").collect()]
    assert got == [(0, " ", "甲"), (1, "+", "a"), (2, "-", "A"), (3, "-", "B"), (4, " ", "乙")]


def library_ops(a, b):
    return [(x[0], x[-1]) for x in difflib.Differ().compare(a, b) if x[0] in "-+ "]


def test_equals_library_differ():
    rng = random.Random(11)
    for alpha in ["ab 🐶狗猫AaBb.", "ab", "the quick 🐱 fox", "xyzxyzxy狗"]:
        for _ in range(1500):
            a = "".join(rng.choice(alpha) for _ in range(rng.randint(0, 190)))
            b = "".join(rng.choice(alpha) for _ in range(rng.randint(0, 199)))
            assert diff_ops(a, b) == library_ops(a, b), (a, b)


def test_equals_library_differ_on_long_texts():
    rng = random.Random(12)
    for alpha in ["ab", "abc 🐶", "the quick 🐱 fox jumps", [chr(0x4E00 + k) for k in range(300)]]:
        for _ in range(40):
            a = "".join(rng.choice(alpha) for _ in range(rng.randint(0, 120)))
            b = list(a) + [rng.choice(alpha) for _ in range(rng.randint(0, 100))]
            for _ in range(rng.randint(0, 60)):
                b.insert(rng.randint(0, len(b)), rng.choice(alpha))
                del b[rng.randint(0, len(b) - 1)]
            b += [rng.choice(alpha) for _ in range(max(0, 200 - len(b)))]
            assert diff_ops(a, "".join(b)) == library_ops(a, "".join(b)), (a, b)


def test_long_text_takes_no_time():
    rng = random.Random(13)
    words = [w * 3 for w in ("the", "and", "ing", "er", "tion", " ")]
    a = " ".join(rng.choice(words) for _ in range(6000))
    b = a.replace(" the", " 狗").replace("and ", "猫 ")
    start = time.perf_counter()
    ops = diff_ops(a, b)
    assert time.perf_counter() - start < 10
    assert "".join(c for o, c in ops if o != "+") == a and "".join(c for o, c in ops if o != "-") == b
