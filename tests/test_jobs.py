"""End-to-end jobs on the sf0.001 fixture (the three ways the reference is used)."""

from pyspark.sql import functions as F

from glyphlex.operators import dictionaries as D
from glyphlex.plans import fixtures as fx
from glyphlex.plans import jobs

SF = "/root/testdata/sf0.001"


def test_rule_baseline_rewrites_symbols(spark):
    out = jobs.rule_baseline(fx.raw_pairs(spark, SF), fx.test_table(spark, SF))
    lex = {r.key: r.value for r in out["dictionary"].collect()}
    assert lex["🐶"] == "狗" and lex["🐱"] == "猫"
    preds = out["predictions"].join(fx.pairs(spark, SF).select(
        F.col("row_id").alias("id"), "target_text"), "id")
    # on this fixture the rule rewrite restores every target exactly
    assert preds.where(F.col("prediction") != F.col("target_text")).count() == 0


def test_training_table_and_feedback(spark):
    train = fx.raw_pairs(spark, SF)
    t = jobs.training_table(train)
    table = t["table"]
    assert table.count() > 0
    assert table.where(F.col("source_text").contains(" ")).count() == 0
    prof = {r.column: r.n for r in t["profile"].collect()}
    assert prof["source_text"] == table.count()
    test = fx.test_table(spark, SF)
    rule = jobs.rule_baseline(train, test)["predictions"].select("id", "prediction")
    keys = jobs.rule_baseline(train, test)["reconcile_keys"]
    post = jobs.post_process(test, rule, fx.candidates(spark, SF), keys)
    assert post["voted"].count() == test.count()
    assert {r.system for r in post["counters"].collect()} == {"s0", "s1", "s2", "s3"}
    fed = jobs.feed_back(post["pseudo_labels"], test, table, t["dictionary"])
    assert fed.where("origin = 'pseudo'").count() == post["pseudo_labels"].where(
        "min_votes = 3").count()


def test_lookup_first_and_missing_ids(spark):
    import pytest as _pt

    from glyphlex.operators.pseudo import lookup_first
    left = spark.createDataFrame([(1,), (2,)], "id long")
    right = spark.createDataFrame([(1, "b", 5), (1, "a", 3), (2, "z", 1)],
                                  "id long, text string, pos long")
    got = {r.id: r.src for r in lookup_first(left, right, "id", "text", "src", "pos").collect()}
    assert got == {1: "a", 2: "z"}
    with _pt.raises(KeyError):
        lookup_first(spark.createDataFrame([(9,)], "id long"), right, "id", "text", "src", "pos")


XML = """<?xml version="1.0" encoding="UTF-8"?>
<ldml><annotations>
  <annotation cp="🐶">狗 | 小狗</annotation>
  <annotation cp="‼" type="tts">双感叹号</annotation>
  <annotation cp="🌕">满月 | 月亮</annotation>
</annotations></ldml>
"""


def test_rule_baseline_with_annotations(spark, tmp_path):
    from glyphlex.sources import io
    p = tmp_path / "ann.xml"
    p.write_text(XML, encoding="utf-8")
    ann = io.read_annotations(spark, str(p))
    train = spark.createDataFrame(
        [(i, "我🐶了", "我🐶了", "我狗了") for i in range(3)],
        "row_id long, raw_text string, source_text string, target_text string")
    test = spark.createDataFrame([(1, "看🌕和🐶‼")], "id long, text string")
    out = jobs.rule_baseline(train, test, annotations=ann)
    d = {r.key: r.value for r in out["dictionary"].collect()}
    # mined entry wins over the label; labels fill the rest (alias padding kept,
    # as the rules-B quirk requires); specials override labels
    assert d["🐶"] == "狗" and d["🌕"] == "满月 " and d["‼"] == "吃惊"
    assert out["predictions"].first().prediction == "看满月 和狗吃惊"
    c = out["counters"].first()
    assert (c.n_rows, c.n_with_ambiguous) == (1, 0)
