"""Texts that are filtered and kept are computed once a row, with the same rows."""

from pyspark.sql import functions as F

from glyphlex.operators.dataset import prepare_pairs
from glyphlex.operators.diff import mine_pairs
from glyphlex.operators.equal_rows import computed_once

ROWS = [(1, "A 🐶 b", "A 狗 b"), (2, "same", "same"), (3, None, "x"), (4, "x", None), (None, "🐱 c!", "猫 c!"),
        (1, "A 🐶 b", "A 狗 b"), (7, "", ""), (8, "no symbol", "another")]


def raw(spark):
    return spark.createDataFrame(ROWS, "row_id long, source_text string, target_text string")


def test_same_rows_and_schema(spark):
    df = raw(spark).withColumnRenamed("row_id", "row id.")
    got = computed_once(df)
    assert got.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(repr, got.collect())) == sorted(map(repr, df.collect()))


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_mining_computes_its_texts_once(spark):
    df = raw(spark).withColumn("source_text", F.translate("source_text", "b", "d"))
    assert plan_of(mine_pairs(df)).count("translate(") == 1
    got = sorted((r.row_id, r.key, r.text, r.weight) for r in mine_pairs(raw(spark).where("row_id > 0")).collect()
                 if r.key == "🐶")
    assert got == [(1, "🐶", "狗", 2)]


def test_prepared_pairs_compute_their_texts_once(spark):
    out = prepare_pairs(raw(spark))
    assert plan_of(out).count("translate(") == 2  # one a side
    rows = [(r.row_id, r.source_text, r.target_text) for r in out.collect()]
    assert sorted(rows, key=str) == sorted([(1, "a 🐶 b", "a狗b"), (1, "a 🐶 b", "a狗b"),
                                            (None, "🐱 c!", "猫c!")], key=str)
