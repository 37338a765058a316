"""Digest-first grouping, order keys and observed counters."""

from collections import defaultdict

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from glyphlex.operators import dataset, mining, pseudo
from glyphlex.operators import dictionaries as D
from glyphlex.operators.equal_rows import group_equal
from glyphlex.plans import fixtures as fx
from glyphlex.plans import jobs

SF = "/root/testdata/sf0.001"

ROWS = ([(i, f"s{i}", "t") for i in range(300)] + [(1000 + i, "hot", "pair") for i in range(150)]
        + [(2000, None, "x"), (2001, None, "x"), (2002, "x", None), (2003, "", ""), (2004, "", ""),
           (2005, None, None), (2006, "long " * 20_000, "t"), (2007, "long " * 20_000, "t"),
           (2008, "long " * 20_000 + ".", "t")])


def plain(rows):
    out = defaultdict(list)
    for r, a, b in rows:
        out[a, b].append(r)
    return {k: (min(v), len(v)) for k, v in out.items()}


@pytest.mark.parametrize("digest", [None, "one", "few"])
@pytest.mark.parametrize("bits", [2, 24])
def test_group_equal_with_clashing_digests_and_marks(spark, digest, bits):
    df = spark.createDataFrame(ROWS, "row_id long, a string, b string").repartition(7)
    lost = {"one": F.lit(0), "few": F.coalesce(F.length("a"), F.lit(0))}
    forced = lost[digest].cast("long") if digest else None
    key = F.struct(forced.alias("a"), forced.alias("b")) if digest else None
    got = group_equal(df, ("a", "b"), "row_id", digest=key, bits=bits).collect()
    assert len(got) == len(plain(ROWS))
    assert {(r.a, r.b): (r.row_id, r.n) for r in got} == plain(ROWS)


def test_group_equal_on_an_empty_table_and_other_types(spark):
    assert group_equal(spark.createDataFrame([], "row_id long, a string"), ("a",), "row_id").collect() == []
    df = spark.createDataFrame([(1, 0.0), (2, -0.0), (3, 1.0)], "row_id long, a double")
    assert {(r.row_id, r.n) for r in group_equal(df, ("a",), "row_id").collect()} == {(1, 2), (3, 1)}


def test_texts_that_do_not_repeat_are_not_shuffled(spark):
    df = spark.createDataFrame(ROWS, "row_id long, a string, b string")
    plan = group_equal(df, ("a", "b"), "row_id")._jdf.queryExecution().optimizedPlan().toString()
    alone = plan.split("Aggregate")[0]
    assert "Union" in alone and "Join LeftOuter" in alone  # the first branch: no grouping


def test_order_keys_give_the_ranks_of_ranked_merges(spark):
    first = D.from_mapping(spark, {"ccc": "1", "a": "2", "bb": "3"})
    second = D.from_mapping(spark, {"bb": "4", "dddd": "5", "": "6"})
    third = D.from_mapping(spark, {"e": "7", "a": "8"})
    for policy in ("last", "first"):
        for by_length in (False, True):
            step = D.merge([first, second], policy)
            loose = D.merge([first, second], policy, ranked=False)
            want = D.merge([step, third], policy, by_length).collect()
            assert sorted(D.merge([loose, third], policy, by_length).collect()) == sorted(want)
            keyed = D.merge([loose, third], policy, by_length, ranked=False)
            assert [tuple(r)[:2] for r in keyed.orderBy("rank").collect()] == [
                tuple(r)[:2] for r in sorted(want, key=lambda r: r.rank)]


def test_unranked_mining_keeps_the_order(spark):
    raw = fx.raw_pairs(spark, SF)
    ranked, loose = mining.mine_lexicon(raw), mining.mine_lexicon(raw, ranked=False)
    order = [(r.key, r.value) for r in ranked["common"].orderBy("rank").collect()]
    assert order and order == [(r.key, r.value) for r in loose["common"].orderBy("rank").collect()]
    prepared = dataset.prepare_pairs(raw)
    own = [mining.unique_dictionary(mining.mine_unique(prepared, ranked=k)) for k in (True, False)]
    assert len({tuple((r.key, r.value) for r in d.orderBy("rank").collect()) for d in own}) == 1


def test_counters_come_from_the_jobs_own_passes(spark):
    odd = spark.createDataFrame([(-1, None, None, "x"), (-2, None, "x", None)],
                                "row_id long, raw_text string, source_text string, target_text string")
    raw = fx.raw_pairs(spark, SF).unionByName(odd)
    out = jobs.training_table(raw)
    assert out["funnel"].collect() == dataset.funnel(raw).collect()
    assert out["duplicates"].first().n_rows == out["prepared"].count()
    assert out["duplicates"].first().n_pairs == out["table"].count()
    for keep in (True, False):
        seen = Observation()
        kept = dataset.prepare_pairs(raw, do_filter=keep, observation=seen)
        assert sorted(kept.collect()) == sorted(dataset.prepare_pairs(raw, do_filter=keep).collect())
        assert seen.get["n_raw"] == raw.count()
    seen = Observation()
    test = fx.test_table(spark, SF)
    labels = test.select("id", F.col("text").alias("prediction")).where("id % 3 = 0")
    fed = pseudo.add_pseudo(labels, test, out["table"], out["dictionary"], observation=seen).collect()
    assert seen.get == {"n_train": out["table"].count(), "n_pseudo": labels.count()}
    assert len(fed) == sum(seen.get.values())


def test_mining_report(spark):
    lex = mining.mine_lexicon(fx.pairs(spark, SF, ambiguous=True), report=True)
    want = mining.mining_summary(lex["counts"], lex["common"], lex["ambiguous"])
    assert sorted(lex["summary"].collect()) == sorted(want.collect())
