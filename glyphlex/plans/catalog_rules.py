"""Registered queries, part 3: tables on which every rule fires.

The pair fixtures of part 1 never meet some rules (one-character keys, keys with a
prefix, label words, case repair).  Here the inputs are built from the distinct words
of all ``documents``, so they grow with the corpus; the SQL states the expected rule
on its own, with its own spelling of the fixed tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels as lab
from ..functions import substitute as fsub
from ..operators import dataset, diff, mining, reconcile, vocab
from ..operators import dictionaries as dicts
from ..operators import labels as label_jobs
from ..session import materialize, scratch_path
from ..sources import io
from . import fixtures as fx
from .catalog import register
from .oracle_fixtures import PAT, q, with_fixtures

# ---------------------------------------------------------------------------
# the words of the corpus, their first place, and a hex digit that deals them out
# ---------------------------------------------------------------------------

WORDS = """words AS (
  SELECT word, count(*) AS cnt, row_number() OVER (ORDER BY word) - 1 AS r,
         substr(md5(word), 1, 1) AS h
  FROM (SELECT unnest(string_split_regex(text, '[^a-zA-Z]+')) AS word FROM documents)
  WHERE word <> '' GROUP BY word)"""


def words(spark, sf) -> DataFrame:
    """(word, cnt, r, h): every distinct ASCII word, its count, its place among the
    sorted words and the first hex digit of its digest."""
    from ..operators.ranking import dense_index
    docs = fx.spread(fx.read_table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    counted = (docs.select(F.explode(F.split("text", "[^a-zA-Z]+")).alias("word"))
               .where("word != ''").groupBy("word").agg(F.count(F.lit(1)).alias("cnt")))
    return dense_index(counted, ["word"], "r").withColumn("h", F.substring(F.md5("word"), 1, 1))


# A lexicon with all kinds of keys: plain words, words behind a CJK character (with and
# without a plain twin), symbol groups with three-word values, and digit placeholders.
LEXI = """lexi AS (
  SELECT word AS key, word || ' 词' AS value, r * 3 AS rank, 0 AS kind FROM words
  UNION ALL SELECT CASE WHEN h < '8' THEN '金' || word ELSE '金' || word || '_' END, '金 词', r * 3 + 1, 1
  FROM words
  UNION ALL SELECT CASE WHEN h < '8' THEN '🐶🐱' || word ELSE '🐶 🐶' || word END, 'one two ' || word, r * 3 + 2, 2
  FROM words)"""


def lexicon(spark, sf) -> DataFrame:
    w = materialize(words(spark, sf), "words")
    low = F.col("h") < "8"
    kinds = F.array(
        F.struct(F.col("word").alias("key"), F.concat("word", F.lit(" 词")).alias("value")),
        F.struct(F.when(low, F.concat(F.lit("金"), "word"))
                 .otherwise(F.concat(F.lit("金"), "word", F.lit("_"))).alias("key"),
                 F.lit("金 词").alias("value")),
        F.struct(F.when(low, F.concat(F.lit("🐶🐱"), "word"))
                 .otherwise(F.concat(F.lit("🐶 🐶"), "word")).alias("key"),
                 F.concat(F.lit("one two "), "word").alias("value")))
    return (w.select("r", F.posexplode(kinds).alias("k", "e"))
            .select("e.key", "e.value", (F.col("r") * 3 + F.col("k")).alias("rank")))


# Labels of single characters, from the first letters of the words, and of two symbols.
CHAR_LABELS = """labels1 AS (
  SELECT substr(word, 1, 1) AS key, 'L' || substr(word, 1, 1) AS value FROM words
  WHERE substr(word, 1, 1) < 'n' GROUP BY 1
  UNION ALL SELECT '🐶', '狗' UNION ALL SELECT '🐱', '猫')"""


def char_labels(spark, sf) -> DataFrame:
    first = F.substring("word", 1, 1)
    letters = (words(spark, sf).where(first < "n").select(first.alias("key")).distinct()
               .select("key", F.concat(F.lit("L"), "key").alias("value"),
                       F.ascii("key").cast("long").alias("rank")))
    return letters.unionByName(dicts.from_mapping(spark, {"🐶": "狗", "🐱": "猫"}))


_REFINED = """refined AS (
  SELECT key, value, rank FROM lexi
  WHERE NOT (length(key) = 1 AND regexp_matches(key, '^[a-zA-Z0-9一-龥]$'))
    AND NOT (substr(key, 1, 1) = '金' AND substr(key, 2) IN (SELECT key FROM lexi)))"""
_FILL = """fill AS (
  SELECT ch AS key, any_value(l.value) AS value, min({'r': rank, 'p': p}) AS pos
  FROM (SELECT rank, unnest(string_split(key, '')) AS ch, unnest(range(0, length(key))) AS p
        FROM refined WHERE contains(key, '🐱')) c JOIN labels1 l ON l.key = c.ch
  WHERE ch NOT IN (SELECT key FROM refined) GROUP BY ch)"""


@register("d5_d6_refine_words", "WITH " + ",\n".join([WORDS, LEXI, _REFINED]) + """
SELECT key, value, row_number() OVER (ORDER BY length(key) DESC, rank) - 1 AS rank FROM refined""")
def q_refine(spark, sf):
    """D5 drops the one-letter words, D6 the keys behind a CJK character with a twin."""
    return dicts.refine(lexicon(spark, sf))


@register("f7_refine_with_labels", "WITH " + ",\n".join([WORDS, LEXI, CHAR_LABELS, _REFINED, _FILL]) + """
SELECT key, value, row_number() OVER (ORDER BY length(key) DESC, g, a, b) - 1 AS rank
FROM (SELECT key, value, 0 AS g, rank AS a, 0 AS b FROM refined
      UNION ALL SELECT key, value, 1, pos.r, pos.p FROM fill)""")
def q_fill(spark, sf):
    """P5 with labels: characters of keys with two symbols and a three-word value come back."""
    return dicts.refine(lexicon(spark, sf), char_labels(spark, sf))


@register("d9_symbol_keys_words", "WITH " + ",\n".join([WORDS, LEXI]) + """
, reps AS (SELECT substr(key, 1, 1) AS key, min(rank) AS rank FROM lexi GROUP BY 1)
SELECT key, rank FROM reps WHERE key = '🐶'""")
def q_d9(spark, sf):
    """The first characters of all keys; one of them is a symbol."""
    first = lexicon(spark, sf).groupBy(F.substring("key", 1, 1).alias("key")).agg(
        F.min("rank").alias("rank"))
    return dicts.symbol_keys(first)


@register("e23_oov_digits", "WITH " + WORDS + """
SELECT key, value, row_number() OVER (ORDER BY length(key) DESC, p, a) - 1 AS rank FROM (
  SELECT word AS key, CASE WHEN h < '8' THEN CAST(cnt % 10 AS VARCHAR)
                           ELSE ':' || cnt || 'x:' END AS value, 0 AS p, r AS a FROM words
  UNION ALL SELECT * FROM (VALUES ('‼', '吃惊', 1, 0), ('⁉', '吃惊', 1, 1), ('❓', '疑惑', 1, 2),
    ('❔', '疑惑', 1, 3), ('❕', '吃惊', 1, 4), ('❗', '吃惊', 1, 5)) s(key, value, p, a))""")
def q_e23(spark, sf):
    """P7 with values such as ``:3:``, which become the digit."""
    w = words(spark, sf)
    value = (F.when(F.col("h") < "8", F.concat(F.lit(":"), (F.col("cnt") % 10).cast("string"), F.lit(":")))
             .otherwise(F.concat(F.lit(":"), F.col("cnt").cast("string"), F.lit("x:"))))
    given = w.select(F.col("word").alias("key"), value.alias("value"), F.col("r").alias("rank"))
    return dicts.build_oov(given, dicts.from_mapping(spark, dicts.SPECIAL_SYMBOLS))


@register("c4_p8_library", "WITH " + WORDS + """
SELECT key, CASE WHEN h = '0' THEN 'mined' WHEN h = '1' THEN 'speech' ELSE '<' || key || '>' END AS value, rank
FROM (SELECT word AS key, h, r AS rank FROM words)""")
def q_p8(spark, sf):
    """P8 with a library whose values lose their quotes (C4) and two sources above it."""
    w = materialize(words(spark, sf), "words").select(F.col("word").alias("key"), F.col("r").alias("rank"), "h")
    library = w.withColumn("value", F.concat(F.lit("["), "key", F.lit("]")))
    return dicts.build_dictionary(
        library, w.where("h in ('0', '1')").withColumn("value", F.lit("speech")),
        w.where("h = '0'").withColumn("value", F.lit("mined")), None, bos="<", eos=">")


# ---------------------------------------------------------------------------
# mining with rare keys, keys with spaces and many texts to a key
# ---------------------------------------------------------------------------

WORD_PAIRS = """wp AS (SELECT r AS row_id, key, word AS text FROM (
  SELECT r, word, substr(word, 1, 3) AS key FROM words))"""
WP_COUNTS = """wc AS (SELECT key, text, count(*) AS cnt, min(row_id) AS first FROM (
  SELECT row_id, key, text FROM wp UNION ALL SELECT row_id, key, text FROM wp WHERE row_id % 3 = 0
  UNION ALL SELECT row_id, key, text FROM wp WHERE row_id % 6 = 0) GROUP BY key, text)"""


def word_counts(spark, sf) -> DataFrame:
    """Pairs (first letters, word), a third of them twice and a sixth three times."""
    w = materialize(words(spark, sf), "words")
    weight = F.when(F.col("r") % 6 == 0, 3).when(F.col("r") % 3 == 0, 2).otherwise(1).cast("long")
    return mining.pair_counts(w.select(
        F.col("r").alias("row_id"), F.lit(0).alias("seq"), F.substring("word", 1, 3).alias("key"),
        F.col("word").alias("text"), weight.alias("weight")))


_WC = "WITH " + ",\n".join([WORDS, WORD_PAIRS, WP_COUNTS])


@register("d4_min_support_words", _WC + """
SELECT key, text AS value, cnt, row_number() OVER (ORDER BY length(key) DESC, kf) - 1 AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY cnt DESC, first) AS n,
         min(first) OVER (PARTITION BY key) AS kf FROM wc) WHERE n = 1 AND cnt >= 2""")
def q_d4(spark, sf):
    return mining.common_map(word_counts(spark, sf)).select("key", "value", "cnt", "rank")


@register("h3_first_texts_words", _WC + """
SELECT key, text, cnt, n - 1 AS text_pos FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY first) AS n FROM wc) WHERE n <= 3""")
def q_h3(spark, sf):
    return mining.first_texts(word_counts(spark, sf)).select(
        "key", "text", "cnt", F.col("text_pos").cast("long").alias("text_pos"))


@register("g6_ambiguous_words", _WC + """
SELECT key, text, cnt, row_number() OVER (PARTITION BY key ORDER BY n) - 1 AS text_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY first) AS n,
         count(*) OVER (PARTITION BY key) AS nk FROM wc) WHERE n <= 3 AND nk > 1 AND cnt > 2""")
def q_g6(spark, sf):
    return mining.ambiguous_map(word_counts(spark, sf))


# changed words: a deleted and an inserted group at the end, closed by a full stop
MINED_WORDS = """mw AS (
  SELECT r AS row_id, CASE h WHEN '0' THEN '🐶' WHEN '1' THEN '🐶 🐱' WHEN '2' THEN 'Ω ' WHEN '3' THEN '🏃'
                             ELSE '🐱' END AS k,
         CASE WHEN h = '0' THEN '狗' WHEN h < '4' THEN '猫' WHEN h < 'a' THEN '咪' ELSE '喵' END AS t FROM words)"""


def changed_words(spark, sf) -> DataFrame:
    h, w = F.col("h"), words(spark, sf)
    k = (F.when(h == "0", "🐶").when(h == "1", "🐶 🐱").when(h == "2", "Ω ").when(h == "3", "🏃")
         .otherwise("🐱"))
    t = F.when(h == "0", "狗").when(h < "4", "猫").when(h < "a", "咪").otherwise("喵")
    return w.select(F.col("r").alias("row_id"), F.concat("word", k, F.lit(".")).alias("source_text"),
                    F.concat("word", t, F.lit(".")).alias("target_text"))


@register("e17_clean_keys_words", "WITH " + ",\n".join([WORDS, MINED_WORDS]) + """
SELECT replace(k, ' ', '') AS key, t AS text, count(*) AS cnt FROM mw GROUP BY 1, 2""")
def q_e17(spark, sf):
    """Keys with spaces, which the clean-up takes out."""
    return mining.pair_counts(mining.mined_pairs(changed_words(spark, sf))).select("key", "text", "cnt")


@register("d7_unique_words", "WITH " + ",\n".join([WORDS, MINED_WORDS]) + """
SELECT key, value, n_texts, key IN ('🐶', '🏃', '🐱') AS is_symbol,
       key IN ('🐶', '🏃', '🐱') AND n_texts = 1 AS "unique", row_number() OVER (ORDER BY f) - 1 AS rank
FROM (SELECT k AS key, min(t) AS value, count(DISTINCT t) AS n_texts, min(row_id) AS f FROM mw GROUP BY k)""")
def q_d7(spark, sf):
    """A symbol with one text, one with several, a symbol group and a letter."""
    return mining.mine_unique(changed_words(spark, sf))


@register("e15_diff_words", "WITH " + ",\n".join([WORDS, MINED_WORDS]) + """
, sides AS (SELECT r AS row_id, word AS w, k, t FROM words JOIN mw ON mw.row_id = r),
lines AS (
  SELECT row_id, unnest(CASE WHEN length(t) < length(k) THEN [' ', '+', '-', ' '] ELSE [' ', '-', '+', ' '] END) AS op,
         unnest(CASE WHEN length(t) < length(k) THEN [w, t, k, '.'] ELSE [w, k, t, '.'] END) AS s,
         unnest(range(0, 4)) AS part FROM sides),
chars AS (SELECT row_id, part, op, unnest(string_split(s, '')) AS ch, unnest(range(0, length(s))) AS p FROM lines)
SELECT row_id, CAST(row_number() OVER (PARTITION BY row_id ORDER BY part, p) - 1 AS INTEGER) AS step, op, ch
FROM chars""")
def q_e15(spark, sf):
    """The diff as a table, one row for each character."""
    return diff.diff_table(changed_words(spark, sf), "source_text", "target_text")


# ---------------------------------------------------------------------------
# reconcile: phrase, case repair, rule and equal rows
# ---------------------------------------------------------------------------

_RECON_WORDS = """rw AS (SELECT r AS id, word, h,
  CASE WHEN h < '4' THEN word || '人工驾驶' WHEN h < '8' THEN 'X' || word || '人工驾驶'
       WHEN h < 'c' THEN word || '狗🐶人工驾驶' ELSE word END AS raw,
  CASE WHEN h < '4' THEN word || '人工驾驶' WHEN h < '8' THEN word
       WHEN h < 'c' THEN word || '狗人工驾驶' ELSE word || '！' END AS rule,
  CASE WHEN h < '4' THEN word || '人工驾驶' WHEN h < '8' THEN 'x' || word || '人工驾驶'
       WHEN h < 'c' THEN word ELSE word || '猫' END AS model FROM words)"""
_RECON_DONE = """done AS (SELECT id,
  CASE WHEN h < '4' THEN 'equal' WHEN h < '8' THEN 'model' WHEN h < 'c' THEN 'rule' ELSE 'model' END AS decision,
  CASE WHEN h < '4' THEN word || '人工驾驶' WHEN h < '8' THEN 'X' || replace(word, 'x', 'X') || '跑步'
       WHEN h < 'c' THEN word || '狗跑步' ELSE word || '猫' END AS prediction FROM rw)"""


def reconcile_words(spark, sf) -> DataFrame:
    h, w = F.col("h"), F.col("word")
    phrase = F.lit("人工驾驶")

    def four(a, b, c, d):
        return F.when(h < "4", a).when(h < "8", b).when(h < "c", c).otherwise(d)
    return words(spark, sf).select(
        F.col("r").alias("id"),
        four(F.concat(w, phrase), F.concat(F.lit("X"), w, phrase),
             F.concat(w, F.lit("狗🐶"), phrase), w).alias("raw"),
        four(F.concat(w, phrase), w, F.concat(w, F.lit("狗"), phrase),
             F.concat(w, F.lit("！"))).alias("rule"),
        four(F.concat(w, phrase), F.concat(F.lit("x"), w, phrase), w,
             F.concat(w, F.lit("猫"))).alias("model"))


def _one_key(spark):
    return dicts.from_mapping(spark, {"🐶": ""}).select("key", "rank")


@register("e21_case_repair_words", "WITH " + ",\n".join([WORDS, _RECON_WORDS, _RECON_DONE]) + """
SELECT id, decision, prediction FROM done""")
def q_e21(spark, sf):
    """P11 where the phrase is rewritten and a capital comes back."""
    return reconcile.reconcile(reconcile_words(spark, sf), _one_key(spark)).select(
        "id", "decision", "prediction")


@register("p12_reconcile_systems", "WITH " + ",\n".join([WORDS, _RECON_WORDS, _RECON_DONE]) + """
SELECT id, 'a' AS system, decision, prediction FROM done
UNION ALL SELECT id, 'b', CASE WHEN h < 'c' THEN 'equal' ELSE 'model' END, replace(rule, '！', '') FROM rw""")
def q_p12(spark, sf):
    """System ``b`` answers with the rule output, its wide marks narrowed where the
    raw text has none of them."""
    rows = materialize(reconcile_words(spark, sf), "reconcile-words")
    candidates = (rows.select("id", F.lit("a").alias("system"), F.col("model").alias("prediction"))
                  .unionByName(rows.select("id", F.lit("b").alias("system"),
                                           F.replace("rule", F.lit("！"), F.lit("")).alias("prediction"))))
    return reconcile.reconcile_many(
        candidates, rows.select("id", F.col("raw").alias("text")),
        rows.select("id", F.col("rule").alias("prediction")), _one_key(spark)).drop("too_long")


@register("p11_key_list", "WITH " + ",\n".join([WORDS, """oov AS (
  SELECT CASE WHEN h < '8' THEN '🐶' ELSE substr(word, 1, 1) END AS key, min(r) AS r FROM words GROUP BY 1)"""]) + """
SELECT key, row_number() OVER (ORDER BY p, a) - 1 AS n FROM (
  SELECT '🐱' AS key, 0 AS p, 0 AS a UNION ALL SELECT '7️⃣', 0, 2
  UNION ALL SELECT key, 1, r FROM oov WHERE key = '🐶')""")
def q_keys(spark, sf):
    """The keys deleted before the walk: lexicon first, then out-of-vocabulary ones."""
    from ..operators.ranking import dense_index
    refined = dicts.from_mapping(spark, {"🐱": "猫", "狗狗": "犬", "7️⃣": "7"})
    oov = words(spark, sf).groupBy(F.when(F.col("h") < "8", "🐶").otherwise(
        F.substring("word", 1, 1)).alias("key")).agg(F.min("r").alias("rank"))
    keys = reconcile.reconcile_keys(refined, oov.withColumn("value", F.lit("")))
    return dense_index(keys, ["rank"], "n").select("key", "n")


# ---------------------------------------------------------------------------
# label rules
# ---------------------------------------------------------------------------

_TEMPLATES = ["人", "%s的猫脸", "有%s的男人", "戴%s的脸", "%s者男生手势按钮", "%s: 较浅肤色",
              "%s: 中等-深肤色", "成人成人%s较", "旗: %s: 人", "女生%s箭头", "%s：：", "  %s "]
_TEMPLATE_SQL = "[" + ", ".join(q(t) for t in _TEMPLATES) + "]"
LABELLED = f"""lw AS (SELECT r AS id, word, replace({_TEMPLATE_SQL}[1 + r % 12], '%s', word) AS t FROM words)"""


def _label_texts(spark, sf) -> DataFrame:
    w = words(spark, sf)
    pick = F.element_at(F.array(*map(F.lit, _TEMPLATES)), (F.col("r") % 12 + 1).cast("int"))
    return w.select(F.col("r").alias("id"), F.replace(pick, F.lit("%s"), F.col("word")).alias("t"), "word")


_SPEECH = ["'人'", "word || '的猫脸'", "'有' || word", "'脸'", "word", "word", "word", "word", "word || ': 人'",
           "word || '箭头'", "word", "word"]
_CASES = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(_SPEECH))


@register("e18_speech_labels", "WITH " + ",\n".join([WORDS, LABELLED]) + f"""
SELECT id, CASE id % 12 {_CASES} END AS label FROM lw""")
def q_e18(spark, sf):
    return _label_texts(spark, sf).select("id", lab.speech_label("t").alias("label"))


@register("e19_first_alias", "WITH " + WORDS + """
SELECT r AS id, CASE WHEN r % 4 = 0 THEN CASE WHEN length(word) < 5 THEN word ELSE ' 短' END
                     WHEN r % 4 = 1 THEN word || '禁止' WHEN r % 4 = 2 THEN NULL
                     ELSE word[1:1] || ' ' END AS label FROM words""")
def q_e19(spark, sf):
    """First usable alias: bare person words, cat faces and long aliases are passed over."""
    w, k = F.col("word"), F.col("r") % 4
    first = F.substring("word", 1, 1)
    t = (F.when(k == 0, F.concat(F.lit("男|的猫|"), w, F.lit("| 短")))
         .when(k == 1, F.concat(F.lit("人|"), w, F.lit("禁止箭头者")))
         .when(k == 2, F.concat(F.lit("女|"), w, F.lit("的猫")))
         .otherwise(F.concat(F.lit(" "), first, F.lit(" | x"))))
    return words(spark, sf).select(F.col("r").alias("id"), lab.first_usable_alias(t).alias("label"))


@register("e20_alias_lists", "WITH " + WORDS + """
SELECT r AS id, array_to_string(list_sort(list_distinct([word, '人', '脸'])), '|') AS aliases FROM words""")
def q_e20(spark, sf):
    t = F.concat(F.lit("人 | "), "word", F.lit("手势 | 戴"), "word", F.lit("的脸 | 按钮 | 人 | "), "word")
    return words(spark, sf).select(F.col("r").alias("id"), F.array_join(lab.alias_list(t), "|").alias("aliases"))


def _annotation_files(spark, sf) -> str:
    """Two annotation files of the words, each with all its rows in document order."""
    path = scratch_path(spark, "annotations")
    w = words(spark, sf).select(
        "r", F.when(F.col("h") < "8", "🐶").otherwise("🐱").alias("_cp"),
        F.when(F.col("h") < "c", "tts").alias("_type"), F.col("word").alias("_VALUE"))
    for name, part in (("a", "r % 2 = 0"), ("b", "r % 2 = 1")):
        (w.where(part).orderBy("r").select("_cp", "_type", "_VALUE").coalesce(1).write.format("xml")
         .option("rootTag", "annotations").option("rowTag", "annotation").mode("overwrite")
         .save(f"{path}/{name}"))
    return path


@register("a4_annotation_slice", "WITH " + WORDS + """
SELECT r % 2 AS file, (r - r % 2) // 2 AS pos, CASE WHEN h < '8' THEN '🐶' ELSE '🐱' END AS cp,
       CASE WHEN h < 'c' THEN 'tts' END AS type, word AS text
FROM words WHERE (r - r % 2) // 2 >= 3""")
def q_a4(spark, sf):
    """Annotations of two files from their fourth element on."""
    path = _annotation_files(spark, sf)
    ann = io.read_annotations(spark, path + "/a").unionByName(io.read_annotations(spark, path + "/b"))
    cut = io.slice_annotations(ann, 3)
    return cut.select(F.col("file").contains("/b/").cast("long").alias("file"),
                      F.col("pos").cast("long").alias("pos"), "cp", "type", "text")


@register("p6_alias_labels", "WITH " + WORDS + """
SELECT cp AS key, word AS texts, row_number() OVER (ORDER BY f) - 1 AS rank FROM (
  SELECT cp, arg_max(word, r) AS word, min(r) AS f FROM (
    SELECT r, word, '🐱' AS cp FROM words WHERE h >= 'c') GROUP BY cp)""")
def q_p6(spark, sf):
    """P6's alias side: of several annotations of a symbol the last one counts."""
    w = words(spark, sf).select(
        F.lit("f").alias("file"), F.col("r").alias("doc_pos"),
        F.when(F.col("h") < "8", "🐶").otherwise("🐱").alias("cp"),
        F.when(F.col("h") < "c", "tts").alias("type"), F.col("word").alias("text"))
    return label_jobs.build_labels([w])["aliases"].select(
        "key", F.array_join("texts", "|").alias("texts"), "rank")


# ---------------------------------------------------------------------------
# projections and scans
# ---------------------------------------------------------------------------

@register("a2_pair_scan", with_fixtures(["PAIRS"], body="""
SELECT row_id, source_text AS raw_text, source_text, target_text FROM pairs"""))
def q_a2(spark, sf):
    """The raw pair table written with more columns and read back by its schema."""
    path = scratch_path(spark, "raw-pairs")
    fx.raw_pairs(spark, sf).withColumn("more", F.lit(1)).write.parquet(path)
    return io.read_pairs(spark, path)


@register("c1_rename", with_fixtures(["PAIRS"], body="""
SELECT row_id AS id, source_text AS text, target_text AS answer FROM pairs"""))
def q_c1(spark, sf):
    p = fx.pairs(spark, sf).select("row_id", "source_text", "target_text")
    return dataset.rename(dataset.rename(p, {"row_id": "id", "source_text": "x"}), ["id", "text", "answer"])


@register("c3_task_prefix", with_fixtures(["PAIRS"], body="""
SELECT row_id, translate(lower('任务：' || source_text), '：', ':') AS source_text,
       replace(lower(target_text), ' ', '') AS target_text FROM pairs"""))
def q_c3(spark, sf):
    p = fx.raw_pairs(spark, sf)
    return dataset.prepare_pairs(p, prefix="任务：", do_filter=False)


@register("e9_with_symbols", with_fixtures(["PAIRS"], body=f"""
SELECT doc_id, pos, replace(replace(replace(replace(replace(source_text, '🐶', '狗'), '🐱', '猫'),
         '❤️', '[UNK]'), '🤵‍♂️', '[UNK]'), '🏃', '[UNK]') AS text,
       array_to_string(regexp_extract_all(source_text, {q(PAT)}, 0), '|') AS symbols
FROM pairs"""))
def q_e9(spark, sf):
    """Demojized text with the symbols found; three of them are not in the dictionary."""
    both = fsub.demojize_with_symbols("source_text", {"🐶": "狗", "🐱": "猫"})
    return fx.pairs(spark, sf).select("doc_id", "pos", both.alias("b")).select(
        "doc_id", "pos", "b.text", F.array_join("b.symbols", "|").alias("symbols"))


@register("k3_encode_pairs", "WITH " + ",\n".join([WORDS, MINED_WORDS]) + """
, sides AS (SELECT r AS row_id, [word || k || '.', word || t || '.'] AS s FROM words JOIN mw ON mw.row_id = r),
vocab AS (SELECT token, row_number() OVER (ORDER BY f) + 3 AS id FROM (
  SELECT token, min({'r': r, 'p': p}) AS f FROM (
    SELECT r, unnest(string_split(word, '')) AS token, unnest(range(0, length(word))) AS p FROM words)
  GROUP BY token)),
vm AS (SELECT map_from_entries(list({'k': token, 'v': id})) AS m FROM vocab),
enc AS (SELECT row_id, list_transform(s, lambda x: [2] || list_transform(string_split(x[1:10], ''),
          lambda c: coalesce(m[c], 1)) || [3]) AS e FROM sides, vm)
SELECT row_id, array_to_string(e[1] || list_transform(range(12 - len(e[1])), lambda x: 0), ' ') AS source_ids,
       len(e[1]) AS n_source,
       array_to_string(e[2] || list_transform(range(12 - len(e[2])), lambda x: -100), ' ') AS labels,
       len(e[2]) AS n_target FROM enc""")
def q_k3(spark, sf):
    """Both sides of the changed words as ids; symbols are unknown, padding of labels is -100."""
    w = materialize(words(spark, sf), "words")
    voc = vocab.char_vocab(w.select(F.col("r").alias("row_id"), "word"), ["word"])
    done = dataset.encode_pairs(changed_words(spark, sf), voc, 12, 12)

    def joined(c):
        return F.array_join(F.col(c).cast("array<string>"), " ")

    def ones(c):
        return F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)
    return done.select("row_id", joined("source_ids").alias("source_ids"),
                       ones("source_mask").alias("n_source"), joined("labels").alias("labels"),
                       ones("target_mask").alias("n_target"))
