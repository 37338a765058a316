"""Native text and symbol expressions (E1-E14, E22-E24) against hand-computed goldens."""

from pyspark.sql import functions as F

from glyphlex.functions import substitute as fs
from glyphlex.functions import symbols as sy
from glyphlex.functions import text as tx


def one(spark, expr, *values, schema="a string, b string"):
    cols = schema.split(",")
    rows = [tuple(values) + (None,) * (len(cols) - len(values))]
    return spark.createDataFrame(rows, schema).select(expr.alias("x")).first()["x"]


def test_extract_symbols_golden(spark):
    text = "我🐶x🤵‍♂️👍🏽🇨🇳1️⃣❤️❤🐻‍❄️©‼ 9#"
    got = one(spark, sy.extract_symbols("a"), text)
    assert got == ["🐶", "🤵‍♂️", "👍🏽", "🇨🇳", "1️⃣", "❤️", "❤", "🐻‍❄️", "©", "‼"]


def test_symbol_count_and_membership(spark):
    assert one(spark, sy.symbol_count("a"), "🐶🐶a🐱") == 3
    assert one(spark, sy.symbol_count("a"), "") == 0
    assert one(spark, sy.is_symbol("a"), "🤵‍♂️") is True
    assert one(spark, sy.is_symbol("a"), "🐶🐶") is False
    assert one(spark, sy.is_symbol("a"), "X🐶") is False
    assert one(spark, sy.distinct_symbols("a"), "🐱🐶🐱") == sorted(["🐱", "🐶"])


def test_width_half_full_identity_on_ascii(spark):
    ascii_text = "".join(chr(c) for c in range(0x21, 0x7F))
    full = one(spark, tx.to_full("a"), ascii_text)
    assert all(0xFF01 <= ord(c) <= 0xFF5E for c in full)
    assert one(spark, tx.to_half(tx.to_full("a")), ascii_text) == ascii_text
    # U+3000 is not part of the table
    assert one(spark, tx.to_half("a"), "　ａ") == "　a"


def test_width_classes_switch(spark):
    got = one(spark, tx.to_half("a", lower=False, upper=False, digits=False), "ＡＢ１，！")
    assert got == "ＡＢ１,!"
    try:
        tx.convert_width("a", "sideways")
    except ValueError:
        pass
    else:
        raise AssertionError("bad mode must raise")


def test_normalize_text(spark):
    assert one(spark, tx.normalize_text("a"), "ÀB，Ｃ！") == "àb,ｃ!"


def test_remove_spaces_only_u0020(spark):
    assert one(spark, tx.remove_spaces("a"), " a\tb 　c ") == "a\tb　c"


def test_align_punct_goldens(spark):
    cases = [("好，的!", "好, 的!", "好，的!"), ("等…", "等...", "等…"),
             ("等。", "等...", "等。。。"), ("a…b。", "a...b.", "a…b。")]
    for raw, pred, want in cases:
        assert one(spark, tx.align_punct("a", "b"), raw, pred) == want


def test_keep_cjk(spark):
    assert one(spark, tx.keep_cjk_alnum("a"), "我爱NBA！ é9") == "我爱NBA9"
    assert one(spark, tx.keep_cjk("a"), "我爱NBA！") == "我爱"


def test_placeholder_digit_and_wrap(spark):
    assert one(spark, tx.placeholder_digit("a"), ":7:") == "7"
    assert one(spark, tx.placeholder_digit("a"), ":77:") == ":77:"
    assert one(spark, tx.strip_and_wrap("a", "<", ">"), ":dog:") == "<dog>"
    assert one(spark, tx.strip_and_wrap("a"), "x") == ""


def test_chars_code_points(spark):
    assert one(spark, tx.chars("a"), "a🐶b") == ["a", "🐶", "b"]
    assert one(spark, tx.chars("a"), "") == []


def test_demojize_golden(spark):
    got = one(spark, fs.demojize("a", {"🐶": "狗", "❤️": "爱"}), "a🐶b❤️🐱")
    assert got == "a狗b爱[UNK]"


def test_fold_cascade_golden(spark):
    entries = [("🐶🐱", "🐱"), ("🐱", "猫"), ("🐶", "狗")]
    assert one(spark, fs.fold_replace("a", entries), "🐶🐱x") == "猫x"
    assert one(spark, fs.fold_replace("a", []), "🐶🐱x") == "🐶🐱x"


def test_contains_any_and_delete(spark):
    assert one(spark, fs.contains_any("a", ["x", "🐶"]), "a🐶") is True
    assert one(spark, fs.contains_any("a", []), "a🐶") is False
    assert one(spark, fs.delete_keys("a", ["🐶", "🐱"]), "a🐶b🐱") == "ab"


def test_empty_search_string_is_noop(spark):
    assert one(spark, F.replace(F.col("a"), F.lit(""), F.lit("x")), "ab") == "ab"


def test_demojize_with_symbols(spark):
    got = one(spark, fs.demojize_with_symbols("a", {"🐶": "狗"}), "🐶x🐶🐱")
    assert got["text"] == "狗x狗[UNK]" and got["symbols"] == ["🐶", "🐶", "🐱"]


def test_symbol_table_narrows_grammar(spark):
    from glyphlex.operators import vocab
    df = spark.createDataFrame([("🐶→➡⌚🐶",)], "t string")
    all_ = {r.symbol: r.cnt for r in vocab.symbol_frequency(df, "t").collect()}
    assert all_ == {"🐶": 2, "➡": 1, "⌚": 1}
    table = spark.createDataFrame([("🐶",), ("⌚",)], "symbol string")
    got = {r.symbol: r.cnt for r in vocab.symbol_frequency(df, "t", table).collect()}
    assert got == {"🐶": 2, "⌚": 1}
