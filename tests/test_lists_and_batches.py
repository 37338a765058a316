"""Closed symbol lists, signature joins, block lookups and batches by length."""

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from glyphlex.functions import symbols as S
from glyphlex.operators import dataset, predict, vocab
from glyphlex.operators import dictionaries as D
from glyphlex.operators import substitute


def leftmost_longest(text, listed):
    out, i = [], 0
    while i < len(text):
        best = max((s for s in listed if text.startswith(s, i)), key=len, default="")
        if best:
            out.append(best)
        i += len(best) or 1
    return out


def python_pattern(p):
    return re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: "\\U%08X" % int(m[1], 16), p)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("ab🐶-]^", min_size=1, max_size=4), max_size=8), st.text("ab🐶-]^ ", max_size=25))
def test_pattern_is_leftmost_longest(listed, text):
    s = S.closed_list(listed)
    assert re.findall(python_pattern(s.pattern), text) == leftmost_longest(text, listed)
    if s.plain_run:
        short = re.sub(python_pattern(s.plain_run), " ", text)
        assert re.findall(python_pattern(s.pattern), short) == leftmost_longest(text, listed)


def test_closed_list_on_spark(spark):
    listed = ["🐶🐱", "🐱", "👨‍👩", "👨", "(c)", "a b"]
    table = spark.createDataFrame([(s,) for s in [*listed, None, "", "🐱"]], "symbol string")
    own = vocab.symbol_list(table)
    texts = ["🐶🐱🐱🐶", "👨‍👩‍👧", "x (c) a b🐱", "", "🏃"]
    rows = spark.createDataFrame(list(enumerate(texts)), "row_id int, t string")
    got = {r.row_id: r for r in rows.select("row_id", S.extract_symbols("t", own).alias("s"),
                                            S.is_symbol("t", own).alias("one")).collect()}
    assert [got[k].s for k in range(5)] == [leftmost_longest(t, listed) for t in texts]
    assert [r.row_id for r in rows.where(S.has_symbol("t", own)).orderBy("row_id").collect()] == [0, 1, 2]
    assert not S.closed_list([]).plain_run
    assert rows.where(S.has_symbol("t", S.closed_list([]))).count() == 0
    pairs = spark.createDataFrame([(1, "🏃", "跑"), (2, "🐱", "猫")], "row_id long, source_text string, target_text string")
    assert [r.row_id for r in dataset.prepare_pairs(pairs, symbols=own).collect()] == [2]


def test_list_bytes_are_checked(spark, monkeypatch):
    monkeypatch.setattr(vocab, "LIST_BYTES", 10)
    with pytest.raises(ValueError, match="bytes"):
        vocab.symbol_list(spark.createDataFrame([("🐶🐱🏃",)], "symbol string"))


@pytest.mark.parametrize("seed", range(3))
def test_signature_join(spark, seed):
    r = random.Random(seed)
    letters = "abcde🐶é"
    keys = {"".join(r.choice(letters) for _ in range(r.randint(1 + seed, 6))) for _ in range(400)}
    texts = ["".join(r.choice(letters + "xyz") for _ in range(r.randint(0, 12))) for _ in range(300)]
    texts += [None, "", "hot abcde"] + ["hot abcde"] * 200  # a text that a large share of rows has
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    table = spark.createDataFrame([(k,) for k in keys], "key string")
    for row_id in ("id", None):
        got = substitute.contains_any_key(rows, "text", table, "hit", row_id=row_id, max_bytes=0)
        assert got.columns == ["id", "text", "hit"]
        assert {x.id: x.hit for x in got.collect()} == {
            k: any(key in (t or "") for key in keys) for k, t in enumerate(texts)}


def test_block_lookup_of_a_hot_symbol(spark):
    rows = spark.createDataFrame([(k, "🐶 x 🐱🐶" if k % 3 else "🐶🏃") for k in range(900)], "row_id long, text string")
    d = D.from_mapping(spark, {"🐶": "狗", "🐱": None})
    got = substitute.demojize(rows, "text", d, "out", path="join")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" in plan and "posexplode" not in plan
    assert {r.row_id: r.out for r in got.collect()} == {
        k: "狗 x [UNK]狗" if k % 3 else "狗[UNK]" for k in range(900)}


def padder():
    """A model that answers with its token and the characters that padding to the
    longest would add (made by value, as the workers can't import the tests)."""
    class Padder:
        def __init__(self):
            import uuid
            self.token = uuid.uuid4().hex

        def __call__(self, texts, **options):
            longest = max(map(len, texts))
            return [f"{self.token},{longest - len(t)},{sorted(options.items())}" for t in texts]
    return Padder


def test_batches_by_length_options_and_one_model(spark):
    r = random.Random(1)
    rows = spark.createDataFrame([(k, "x" * r.randint(1, 90)) for k in range(600)], "id long, text string").coalesce(1)
    d = D.from_mapping(spark, {"🐶": "狗"})
    tokens = set()
    for call in range(3):
        out = predict.predict_table(rows, d, factory=padder(), options=predict.GENERATION_OPTIONS).collect()
        assert sorted(x.id for x in out) == list(range(600))
        split = [x.prediction.split(",", 2) for x in out]
        assert sum(int(p) for _, p, _ in split) < 600 * 6  # batches as they come waste 40 a text
        assert all("'max_length',100" in o and "'num_beams',10" in o for _, _, o in split)
        tokens.add(frozenset(t for t, _, _ in split))
    assert len(tokens) == 3 and all(len(t) == 1 for t in tokens)

    def models_held(batches):
        import pandas as pd
        from glyphlex.operators import predict as own
        for _ in batches:
            pass
        yield pd.DataFrame({"n": [len(own._MODEL) // 2]})
    held = rows.mapInPandas(models_held, "n long").first().n
    assert held <= 1


def test_predictor_must_answer_every_text(spark):
    rows = spark.createDataFrame([(1, "x"), (2, "y")], "id long, text string")
    with pytest.raises(Exception, match="predictions for"):
        predict.predict_table(rows, D.from_mapping(spark, {}), lambda texts: texts[:-1]).collect()
    same = predict.predict_table(rows, D.from_mapping(spark, {}), lambda texts: texts)
    assert {(r.id, r.prediction) for r in same.collect()} == {(1, "x"), (2, "y")}


def test_length_batches():
    texts = ["aaa", "", "b", "cc", "d"]
    assert predict.length_batches(texts, 2) == [[1, 2], [4, 3], [0]]
