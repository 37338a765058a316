"""Joins that lose no row, the reconcile key list, the symbol grammar, the split mark
and both ways of encoding."""

import hashlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from glyphlex.functions import symbols as S
from glyphlex.operators import dataset, pseudo, reconcile, vocab
from glyphlex.operators import dictionaries as D


def ids(spark, values, col="x"):
    return spark.createDataFrame([(v, str(v)) for v in values], f"id long, {col} string")


def test_aligned_keeps_all_rows(spark):
    got = reconcile.aligned(ids(spark, [1, 2, 3]), ids(spark, [3, 1, 2], "y")).collect()
    assert sorted((r.id, r.x, r.y) for r in got) == [(i, str(i), str(i)) for i in (1, 2, 3)]


@pytest.mark.parametrize("left,right", [
    ([1, 2, 3], [1, 2]), ([1, 2], [1, 2, 3]), ([1, 2], [1, 3]), ([1, 1], [1, 1]), ([1, None], [1, None])])
def test_aligned_fails(spark, left, right):
    with pytest.raises(PySparkException, match="identifier"):
        reconcile.aligned(ids(spark, left), ids(spark, right, "y")).collect()


def test_lookups_fail_on_missing_text(spark):
    cand = spark.createDataFrame([(1, "a", "p"), (2, "a", "p")], "id long, system string, prediction string")
    raw, rule = ids(spark, [1, 2], "text"), ids(spark, [1], "prediction")
    keys = D.from_mapping(spark, {}).select("key", "rank")
    with pytest.raises(PySparkException, match="no rule for identifier: 2"):
        reconcile.reconcile_many(cand, raw, rule, keys).collect()
    labels = spark.createDataFrame([(2, 3, "p")], "id long, min_votes int, prediction string")
    with pytest.raises(PySparkException, match="identifier: 2"):
        pseudo.pseudo_pairs(labels, rule).collect()


def test_key_list_takes_keycaps_out_of_the_raw_text(spark):
    refined = D.from_mapping(spark, {"🐶": "狗", "狗🐶": "x"})
    oov = D.from_mapping(spark, {"7️⃣": "7", "🐶": "犬"})
    keys = reconcile.reconcile_keys(refined, oov)
    assert [r.key for r in keys.orderBy("rank").collect()] == ["🐶", "7️⃣"]
    rows = spark.createDataFrame([(1, "好7️⃣", "好7", "好七")], "id long, raw string, rule string, model string")
    # with the keycap left in, its digit would count as deleted and the rule would win
    assert reconcile.reconcile(rows, keys).first().decision == "model"


def test_null_and_equal_rows(spark):
    rows = spark.createDataFrame(
        [(1, None, None, None), (2, "a", None, "b"), (3, "好a", "x", None), (4, "a", "s", "s")],
        "id long, raw string, rule string, model string")
    keys = D.from_mapping(spark, {}).select("key", "rank")
    got = {r.id: (r.decision, r.prediction) for r in reconcile.reconcile(rows, keys).collect()}
    assert got == {1: ("equal", None), 2: ("model", "b"), 3: ("rule", "x"), 4: ("equal", "s")}


def test_plain_arrows_are_text(spark):
    text = "a → b ⌀ ↔ ⌚ ⬅ 7️⃣ 7 🇩🇪 👩🏽‍🚀 ❤️‍🔥 好"
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(S.extract_symbols("t").alias("s"), S.has_symbol(F.lit("a → 7")).alias("h")).first()
    assert got.s == ["↔", "⌚", "⬅", "7️⃣", "🇩🇪", "👩🏽‍🚀", "❤️‍🔥"] and not got.h


@pytest.mark.parametrize("bucket", [10_000, 3])
def test_split_mark(spark, monkeypatch, bucket):
    monkeypatch.setattr(dataset, "BUCKET", bucket)
    df = spark.range(5000).withColumnRenamed("id", "row_id")
    order = sorted(range(5000), key=lambda i: hashlib.md5(f"42{i}".encode()).hexdigest())
    got = dataset.train_valid_split(df, 0.1).where("split = 'valid'").collect()
    assert {r.row_id for r in got} == set(order[:500])
    assert dataset.train_valid_split(df.where("row_id < 0")).count() == 0


def test_both_ways_of_encoding_agree(spark, monkeypatch):
    rows = [(1, "héllo 🐶"), (2, ""), (3, None), (4, "x" * 30), (5, "\U000f0001a￿")]
    df = spark.createDataFrame(rows, "row_id long, t string")
    voc = vocab.char_vocab(df.where("row_id in (1, 4)"), ["t"])
    inline = {r.row_id: (r.e, r.e_mask) for r in dataset.encode(df, "t", voc, 10, "e").collect()}
    monkeypatch.setattr(dataset, "PRIVATE_MAX", 2)
    joined = {r.row_id: (r.e, r.e_mask) for r in dataset.encode(df, "t", voc, 10, "e").collect()}
    assert inline == joined
    assert inline[3][0] == inline[2][0] == [2, 3] + [0] * 8
    assert all(len(e) == len(m) == 10 for e, m in inline.values())
