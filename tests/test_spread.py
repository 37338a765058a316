"""The spread of documents over scan tasks, and steps that must not grow too fast."""

from collections import Counter

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from glyphlex.operators import diff, matching
from glyphlex.plans import fixtures as fx


@pytest.fixture
def small_splits(spark):
    """Many splits of a small file."""
    names = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "1"}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k in names:
        spark.conf.unset(k)


def shares(df):
    return Counter(r.p for r in df.select(F.spark_partition_id().alias("p")).collect())


def test_one_row_group_is_spread_whatever_the_number_of_splits(spark, tmp_path, small_splits):
    n = 4000
    rows = pa.table({"doc_id": pa.array([None if i % 2 else i % 50 for i in range(n)], pa.int64()),
                     "text": [f"text {i * 7919}" for i in range(n)]})
    pq.write_table(rows, str(tmp_path / "documents.parquet"), row_group_size=n)
    read = fx.read_table(spark, str(tmp_path), "documents")
    assert read.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert len(shares(read)) == 1
    spread = fx.spread(read, "doc_id")
    assert max(shares(spread).values()) < n / 3
    assert sorted(map(tuple, spread.collect()), key=str) == sorted(map(tuple, read.collect()), key=str)


def test_many_even_row_groups_are_left_alone(spark, tmp_path, small_splits):
    n = 64 * 200
    rows = pa.table({"doc_id": list(range(n)), "text": [f"text {i * 7919}" for i in range(n)]})
    pq.write_table(rows, str(tmp_path / "documents.parquet"), row_group_size=200)
    read = fx.read_table(spark, str(tmp_path), "documents")
    assert fx.spread(read, "doc_id") is read


def test_sentences_are_searched_without_digests(monkeypatch):
    def none(*_a):
        raise AssertionError("digests of a sentence")
    monkeypatch.setattr(matching.Matcher, "_by_digests", none)
    words = [f"w{i * 37 % 91}{chr(97 + i % 26)}" for i in range(80)]
    a = " ".join("🐶" if i % 20 == 10 else w for i, w in enumerate(words))
    b = " ".join("狗" if i % 20 == 10 else w for i, w in enumerate(words))
    assert len(a) > 200
    assert diff.extract_pairs(a, b) == [("🐶", "狗")] * 4


def test_kept_characters_at_the_ends_of_their_ranges(spark):
    """E14 against a loop, with the neighbours of every range that is kept."""
    from glyphlex.functions import text as tx
    ends = [0x30, 0x39, 0x41, 0x5A, 0x61, 0x7A, 0x4E00, 0x9FA5]
    chars = [chr(c + d) for c in ends for d in (-1, 0, 1)] + [" ", "\x00", "\n", "é", "，", "퟿", "", "🐶", "\U0010ffff"]
    texts = chars + ["".join(chars), "".join(chars) * 2, "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    got = [r.k for r in df.select("i", tx.keep_cjk_alnum("t").alias("k")).orderBy("i").collect()]
    assert got == [None if t is None else "".join(
        c for c in t if c.isascii() and c.isalnum() or "一" <= c <= "龥") for t in texts]
    assert not tx.NOT_CJK_ALNUM.startswith("[^")  # far slower in Java


def test_keys_meet_few_texts_that_lack_them(spark):
    """F8: texts and keys of two letters share all short runs; the rows that meet are few."""
    import random
    from glyphlex.operators import substitute as subst
    r = random.Random(3)
    texts = ["".join(r.choice("ab") for _ in range(24)) for _ in range(300)]
    keys = ["".join(r.choice("ab") for _ in range(20)) for _ in range(300)] + [texts[5][2:22], texts[9][:6]]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "r long, t string")
    ks = spark.createDataFrame([(k,) for k in keys], "key string")
    met = subst.meetings(df, "r", "t", ks)
    assert met.count() < 300 * 300 / 10
    got = {x.r: x.hit for x in subst.by_signatures(df, "t", ks, "hit", row_id="r").collect()}
    assert got == {i: any(k in t for k in keys) for i, t in enumerate(texts)}
