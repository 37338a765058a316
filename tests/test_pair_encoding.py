"""K3, K4 and K5 over the training pairs of all documents, against their SQL."""

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["k3_encode_training", "k4_pair_char_vocab", "k5_pair_truncation"])
def test_encoding_of_document_pairs(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    got = E.queries()[name](spark, SF).toPandas()
    want = con.execute(E.oracle_sql()[name]).fetchdf()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols
    assert sorted(map(tuple, got[cols].astype(str).values)) == sorted(map(tuple, want[cols].astype(str).values))
    n_pairs = con.execute(f"WITH x AS ({E.oracle_sql()['p1_prepare_pairs']}) SELECT count(*) FROM x").fetchone()[0]
    if name == "k3_encode_training":
        assert len(got) == n_pairs
    if name == "k5_pair_truncation":
        assert got.n_rows[0] == n_pairs
