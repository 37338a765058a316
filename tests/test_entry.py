"""Driver contract: entry() runs, every query has a builder, oracles line up."""

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = "documents benchmark".split()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["doc_id", "pos", "prediction"]


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 60


@pytest.mark.parametrize("name", ["g1_symbol_frequency", "p4_common_map", "p9_rule_predict",
                                  "p13_vote_lowest", "p11_reconcile", "p10_training_table"])
def test_query_matches_oracle_sf0001(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    sdf = E.queries()[name](spark, SF)
    cols = sorted(sdf.columns)
    srows = sorted(tuple(str(r[c]) for c in cols) for r in sdf.collect())
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    drows = sorted(tuple(str(row[i]) for i in idx) for row in res.fetchall())
    assert srows == drows
