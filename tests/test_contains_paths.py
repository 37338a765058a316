"""A text contains a key or not, whatever the number of keys and rows."""

import pytest
from pyspark.sql import functions as F

from glyphlex.operators import dictionaries as D
from glyphlex.operators import substitute as S

SYMBOLS = [chr(0x1F400 + k) for k in range(60)] + ["🤵", "❤"]
TEXTS = ["a 🤵‍♂️ b", "❤️", "🤵🏽", "no key", None, "", chr(0x1F400), "🤵"]
PATHS = {"inline": (256, 64 << 20), "automaton": (0, 64 << 20), "signatures": (0, 0)}


def rows(spark):
    """Row keys that repeat or are null tell no rows apart."""
    ids = [1, 1, None, 1, 2, None, None, 3]
    return spark.createDataFrame(list(zip(range(len(TEXTS)), ids, TEXTS)), "n int, row_id long, text string")


@pytest.mark.parametrize("path", PATHS)
@pytest.mark.parametrize("row_id", ["row_id", None])
def test_flag_is_the_same_for_any_number_of_keys(spark, monkeypatch, path, row_id):
    most, max_bytes = PATHS[path]
    monkeypatch.setattr(S, "NATIVE_MAX_KEYS", most)
    keys = spark.createDataFrame([(k,) for k in [*SYMBOLS, None, "", "🤵"]], "key string")
    got = S.contains_any_key(rows(spark), "text", keys, "hit", row_id=row_id, max_bytes=max_bytes)
    assert got.columns == ["n", "row_id", "text", "hit"]
    assert {r.n: r.hit for r in got.collect()} == {
        n: any(k in (t or "") for k in SYMBOLS) for n, t in enumerate(TEXTS)}


def test_unique_map_of_many_symbols_rewrites_within_longer_ones(spark):
    """More keys than go inline: 🤵 stands within 🤵‍♂️, and is replaced there as with few."""
    many = {chr(0x1F300 + k): f"v{k}" for k in range(S.NATIVE_MAX_KEYS)}
    pairs = rows(spark).select("row_id", F.col("text").alias("source_text"), F.lit("x").alias("target_text"))
    found = []
    for unique in ({"🤵": "人", "❤": "爱"}, {"🤵": "人", "❤": "爱", **{k: v for k, v in many.items() if k != chr(0x1F400)}}):
        unique.pop(chr(0x1F3FD), None)
        kept, counters = S.apply_unique_map(pairs, D.from_mapping(spark, unique))
        found.append((sorted(r.source_text for r in kept.collect()), tuple(counters.first())))
    assert found[0] == found[1]
    assert found[0][1] == (4, 4) and "a 人‍♂️ b" in found[0][0]
