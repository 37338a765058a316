"""Dictionary merges, ranks, refine rules and the three exact fold paths."""

from pyspark.sql import functions as F

from glyphlex.operators import dictionaries as D
from glyphlex.operators import substitute as S


def as_list(df):
    return [(r.key, r.value) for r in df.orderBy("rank").collect()]


def test_merge_last_keeps_first_position(spark):
    d1 = D.from_mapping(spark, {"a": "1", "b": "2"})
    d2 = D.from_mapping(spark, {"c": "3", "a": "9"})
    assert as_list(D.merge([d1, d2], "last")) == [("a", "9"), ("b", "2"), ("c", "3")]
    assert as_list(D.merge([d1, d2], "first")) == [("a", "1"), ("b", "2"), ("c", "3")]


def test_rank_by_key_length_is_stable(spark):
    d = D.from_mapping(spark, {"a": "1", "bbb": "2", "cc": "3", "d": "4", "eee": "5"})
    got = [k for k, _ in as_list(D.rank_by_key_length(d))]
    assert got == ["bbb", "eee", "cc", "a", "d"]


def test_refine_rules(spark):
    common = D.from_mapping(spark, {
        "金💍": "戒指",     # D6: CJK first char, remainder is a key -> dropped
        "💍": "戒指",
        "a": "啊",          # D5: one ASCII char without symbol -> dropped
        "🐶🐱": "狗 和 猫",  # two symbols, three words -> back-fill chars
        "🐶": "狗",
    })
    labels = D.from_mapping(spark, {"🐱": "猫咪", "🐶": "小狗"})
    got = dict(as_list(D.refine(common, labels)))
    assert "金💍" not in got and "a" not in got
    assert got["🐱"] == "猫咪"          # added: in labels, absent from the map
    assert got["🐶"] == "狗"            # present already: not overridden
    ranked = [k for k, _ in as_list(D.refine(common, labels))]
    assert ranked[0] == "🐶🐱"


def test_build_oov_placeholder_digit(spark):
    labels = D.from_mapping(spark, {"1️⃣": ":1:", "‼": "x"})
    out = dict(as_list(D.build_oov(labels, D.from_mapping(spark, D.SPECIAL_SYMBOLS))))
    assert out["1️⃣"] == "1" and out["‼"] == "吃惊"


def test_fold_paths_agree(spark):
    entries = {"🐶🐱": "🐱", "🐱": "猫", "🐶": "狗", "猫x": "Y", "狗": "犬"}
    d = D.from_mapping(spark, entries)
    texts = [("🐶🐱x",), ("a🐶b🐱c",), ("",), ("没有",), ("🐱x🐶",)]
    df = spark.createDataFrame(texts, "t string")
    native = [r.o for r in S.apply_fold(df, "t", d, "o", path="native").collect()]
    arrow = [r.o for r in S.apply_fold(df, "t", d, "o", path="arrow").collect()]
    chunked = [r.o for r in S.apply_fold(df, "t", d, "o", path="chunked", chunk_bytes=8)
               .collect()]

    def py(t):
        for k, v in entries.items():
            t = t.replace(k, v)
        return t
    want = [py(t) for (t,) in texts]
    assert native == want and arrow == want and chunked == want


def test_empty_dictionary_is_identity(spark):
    d = D.from_mapping(spark, {})
    df = spark.createDataFrame([("a🐶",)], "t string")
    assert S.apply_fold(df, "t", d, "o").first().o == "a🐶"


def test_demojize_join_equals_native(spark):
    d = D.from_mapping(spark, {"🐶": "狗", "❤️": "爱"})
    df = spark.createDataFrame([(1, "a🐶b❤️🐱"), (2, "无"), (3, "🐶🐶")], "row_id long, t string")
    nat = {r.row_id: r.o for r in S.demojize(df, "t", d, "o", path="native").collect()}
    join = {r.row_id: r.o for r in S.demojize(df, "t", d, "o", path="join").collect()}
    assert nat == join == {1: "a狗b爱[UNK]", 2: "无", 3: "狗狗"}


def test_contains_any_key_paths(spark):
    keys = spark.createDataFrame([(k,) for k in ["🐶", "🐱"]], "key string")
    df = spark.createDataFrame([("a🐶",), ("b",)], "t string")
    got = [r.hit for r in S.contains_any_key(df, "t", keys, "hit").orderBy("t").collect()]
    assert got == [True, False]
    old = S.NATIVE_MAX_KEYS
    try:
        S.NATIVE_MAX_KEYS = 0   # force the symbol semi-join path
        got = [r.hit for r in S.contains_any_key(df, "t", keys, "hit").orderBy("t").collect()]
        assert got == [True, False]
    finally:
        S.NATIVE_MAX_KEYS = old


def test_oov_symbols(spark):
    d = D.from_mapping(spark, {"🐶": "狗"})
    df = spark.createDataFrame([("🐶🐱🐱",)], "t string")
    got = {r.symbol: r.cnt for r in S.oov_symbols(df, "t", d).collect()}
    assert got == {"🐱": 2}


def test_json_export_round_trip(spark, scratch):
    from glyphlex.sources import io
    d = D.from_mapping(spark, {"🐶": "狗", "a\"b": "c\td", "é": "ü"})
    path = scratch("dict")
    io.write_dict_json(d, path)
    back = io.read_dict(spark, path)
    assert as_list(back) == as_list(d)
    assert back.select(F.max("rank")).first()[0] == 2


def test_unique_map_filter(spark):
    pairs = spark.createDataFrame([(1, "🐶好", "狗好"), (2, "🐱好", "猫啊"), (3, "无", "无!")],
                                  "row_id long, source_text string, target_text string")
    unique = D.from_mapping(spark, {"🐶": "狗", "🐱": "猫"})
    kept, counters = S.apply_unique_map(pairs, unique)
    assert sorted(r.row_id for r in kept.collect()) == [2, 3]
    c = counters.first()
    assert (c.n_touched, c.n_still_different) == (2, 1)


def test_read_dict_duplicate_keys_and_multimap(spark, tmp_path):
    from glyphlex.sources import io
    p = tmp_path / "d.json"
    p.write_text('{"a": "1", "b": "x", "a": "2"}', encoding="utf-8")
    got = [(r.key, r.value, r.rank) for r in io.read_dict(spark, str(p)).orderBy("rank").collect()]
    assert got == [("a", "2", 0), ("b", "x", 1)]
    m = tmp_path / "m.json"
    m.write_text('{"🐶": ["狗", "小狗"], "🐱": ["猫"]}', encoding="utf-8")
    got = [(r.key, r.value) for r in io.read_dict(spark, str(m), "array<string>")
           .orderBy("rank").collect()]
    assert got == [("🐶", ["狗", "小狗"]), ("🐱", ["猫"])]


def test_contains_any_symbol_join_with_row_key(spark):
    keys = spark.createDataFrame([(k,) for k in ["🐶", "🐱"]], "key string")
    df = spark.createDataFrame([(1, "a🐶🐶"), (2, "b"), (3, "🐱x🐶")], "row_id long, t string")
    old = S.NATIVE_MAX_KEYS
    try:
        S.NATIVE_MAX_KEYS = 0
        got = {r.row_id: r.hit for r in S.contains_any_key(df, "t", keys, "hit", row_id="row_id")
               .collect()}
    finally:
        S.NATIVE_MAX_KEYS = old
    assert got == {1: True, 2: False, 3: True}
