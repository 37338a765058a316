"""Properties from the test strategy: results do not depend on the number of
shuffle partitions (first-seen ranks, votes and folds are order-exact)."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["p2_symbol_vocab", "p4_common_map", "p13_vote_lowest",
                                  "o4_train_valid_split", "k4_char_vocab"])
def test_independent_of_shuffle_partitions(spark, name):
    from glyphlex.operators import ranking
    old = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for n, small in [(3, None), (11, 0)]:
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            ranking.SMALL_ROWS = ranking.SMALL_ROWS if small is None else small
            df = E.queries()[name](spark, SF)
            cols = sorted(df.columns)
            results.append(sorted(tuple(str(r[c]) for c in cols) for r in df.collect()))
            ranking.SMALL_ROWS = 100_000
    finally:
        ranking.SMALL_ROWS = 100_000
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1]
