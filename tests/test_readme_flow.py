"""The README's usage example, run on files written from the sf0.001 fixture."""

from pyspark.sql import functions as F

from glyphlex.operators import dictionaries as D
from glyphlex.plans import fixtures as fx
from glyphlex.plans import jobs
from glyphlex.session import ship_package
from glyphlex.sources import io

SF = "/root/testdata/sf0.001"
XML = """<?xml version="1.0" encoding="UTF-8"?>
<ldml><annotations><annotation cp="🐶">狗 | 小狗</annotation></annotations></ldml>
"""


def test_readme_flow(spark, scratch, tmp_path):
    ship_package(spark)
    base = scratch("readme")
    fx.raw_pairs(spark, SF).write.parquet(f"{base}/train.parquet")
    io.write_tsv(fx.test_table(spark, SF), f"{base}/test.tsv")
    cand = fx.candidates(spark, SF)
    systems = {}
    for name, score, _pos in fx.SYSTEMS:
        io.write_tsv(cand.where(F.col("system") == name).select("id", "prediction"),
                     f"{base}/res{score}")
        systems[name] = f"{base}/res{score}"
    (tmp_path / "ann.xml").write_text(XML, encoding="utf-8")

    train = io.read_pairs(spark, f"{base}/train.parquet")
    test = io.read_tsv(spark, f"{base}/test.tsv", "id long, text string")
    ann = io.read_annotations(spark, str(tmp_path / "ann.xml"))

    rule = jobs.rule_baseline(train, test, annotations=ann)
    io.write_dict(rule["dictionary"], f"{base}/dict")
    io.write_tsv(rule["predictions"].select("id", "prediction"), f"{base}/rule_pred")

    training = jobs.training_table(train)
    models = io.read_candidates(spark, systems)
    post = jobs.post_process(test, rule["predictions"].select("id", "prediction"), models,
                             rule["reconcile_keys"])
    io.write_partitioned(post["pseudo_labels"], f"{base}/pseudo", "min_votes")
    more = jobs.feed_back(post["pseudo_labels"], test, training["table"], training["dictionary"])

    n_test = test.count()
    assert spark.read.parquet(f"{base}/dict").count() > 0
    assert post["voted"].count() == n_test
    assert more.where("origin = 'train'").count() == training["table"].count()
    assert more.where("origin = 'pseudo'").count() == post["pseudo_labels"].where(
        "min_votes = 3").count()
