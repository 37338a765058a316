"""Registered queries, part 4: closed symbol lists, key sets beyond a broadcast, diffs of
whole sentences, and the reports of the rewriting and splitting jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.symbols import closed_list, extract_symbols, is_symbol
from ..operators import dataset, diff, vocab
from ..operators import dictionaries as dicts
from ..operators import substitute as subst
from ..session import materialize
from . import fixtures as fx
from .catalog import INJ_CTE, COMMON_CTE, MINED_CTE, _lexicon, _occ_cte, register
from .catalog_jobs import _P1_CTE, _P1_KEPT, _UNIQUE_FROM_COMMON
from .catalog_rules import WORDS, words
from .oracle_fixtures import PAT, with_fixtures

# --- fixed values: a list that is both narrower and longer than the grammar ----
# a pair that the grammar reads as two symbols, the first part of a joined sequence,
# a heart without its variation selector, and plain letters
LISTED = ["🐱🐱", "🤵", "❤", "🏃", "(c)"]
LISTED_VALUES = {"🐱🐱": "两只猫", "🏃": "跑", "🤵": "人"}
# ---------------------------------------------------------------------------
#: The list's pattern in the oracle's own words, the longest first.
LIST_PAT = r"🐱🐱|\(c\)|🤵|❤|🏃"
LIST_TEXTS = """listed AS (
  SELECT doc_id, pos, row_id, replace(replace(source_text, '🐱', '🐱🐱🐱'), ' de ', ' (c) ') AS t FROM pairs)"""


def listed_texts(spark, sf):
    p = fx.pairs(spark, sf)
    t = F.replace(F.replace("source_text", F.lit("🐱"), F.lit("🐱🐱🐱")), F.lit(" de "), F.lit(" (c) "))
    return p.select("doc_id", "pos", "row_id", t.alias("t"))


def symbol_list(spark):
    return vocab.symbol_list(spark.createDataFrame([(s,) for s in LISTED], "symbol string"))


@register("e6_closed_list", with_fixtures(["PAIRS"], LIST_TEXTS, body=f"""
SELECT doc_id, pos, array_to_string(regexp_extract_all(t, '{LIST_PAT}', 0), '|') AS symbols FROM listed"""))
def q_e6_list(spark, sf):
    """E6 with a list that is narrower and longer than the grammar."""
    t = listed_texts(spark, sf)
    return t.select("doc_id", "pos", F.array_join(extract_symbols("t", symbol_list(spark)), "|").alias("symbols"))


@register("e8_closed_list", with_fixtures(["PAIRS"], LIST_TEXTS, body=f"""
SELECT doc_id, pos, list_reduce(list_concat([t], regexp_extract_all(t, '{LIST_PAT}', 0)),
       lambda acc, e: replace(acc, e, CASE e WHEN '🐱🐱' THEN '两只猫' WHEN '🏃' THEN '跑' WHEN '🤵' THEN '人'
                                      ELSE '[UNK]' END)) AS demojized FROM listed"""))
def q_e8_list(spark, sf):
    """E8 with the closed list, by the block lookup."""
    d = dicts.from_mapping(spark, LISTED_VALUES)
    return subst.demojize(listed_texts(spark, sf), "t", d, "demojized", path="join",
                          symbols=symbol_list(spark)).select("doc_id", "pos", "demojized")


@register("p1_closed_list", with_fixtures(["PAIRS"], _P1_CTE, body="""
SELECT row_id, source_text, target_text FROM prep
WHERE source_text <> target_text AND regexp_matches(source_text, '🐶|🏃')"""))
def q_p1_list(spark, sf):
    """P1 that keeps only sources with a listed symbol."""
    return dataset.prepare_pairs(fx.raw_pairs(spark, sf), symbols=closed_list(["🐶", "🏃"]))


@register("g1_closed_list", with_fixtures(["PAIRS"], LIST_TEXTS, body=f"""
SELECT symbol, count(*) AS cnt FROM (SELECT unnest(regexp_extract_all(t, '{LIST_PAT}', 0)) AS symbol FROM listed)
GROUP BY symbol"""))
def q_g1_list(spark, sf):
    return vocab.symbol_frequency(listed_texts(spark, sf), "t", symbols=symbol_list(spark))


@register("f8_signature_join", f"""WITH {WORDS}
SELECT word, EXISTS (SELECT 1 FROM words k WHERE k.h = '0' AND length(k.word) > 1 AND k.word <> w.word
                     AND contains(w.word, k.word)) OR (h = '0' AND length(word) > 1) AS hit
FROM words w""")
def q_f8_signatures(spark, sf):
    """F8 over the words of all documents, with a key set beyond the (here small) bound."""
    w = materialize(words(spark, sf).select("word", "h", "r"), "words")
    keys = w.where("h = '0' and length(word) > 1").select(F.col("word").alias("key"))
    return subst.contains_any_key(w, "word", keys, "hit", row_id="r", max_bytes=0).select("word", "hit")


@register("e15_sentence_diff", with_fixtures(["PAIRS"], body=f"""
SELECT row_id, CAST(length(source_text) - coalesce(list_sum(list_transform(s, lambda x: length(x))), 0) AS BIGINT) AS n_equal,
       CAST(coalesce(list_sum(list_transform(s, lambda x: length(x))), 0) AS BIGINT) AS n_deleted,
       CAST(length(target_text) - length(source_text) + coalesce(list_sum(list_transform(s, lambda x: length(x))), 0) AS BIGINT)
         AS n_inserted
FROM (SELECT *, regexp_extract_all(source_text, '{PAT}', 0) AS s FROM pairs)"""))
def q_e15_sentences(spark, sf):
    """E15 over whole sentences: equal, deleted and inserted characters of each."""
    p = fx.pairs(spark, sf)
    ops = diff.diff_table(p, "source_text", "target_text", "row_id")
    return ops.groupBy("row_id").agg(F.count_if(F.col("op") == " ").alias("n_equal"),
                                     F.count_if(F.col("op") == "-").alias("n_deleted"),
                                     F.count_if(F.col("op") == "+").alias("n_inserted"))


@register("e11_unique_map_counters", with_fixtures(
    ["PAIRS"], _P1_CTE, _P1_KEPT, _occ_cte(), INJ_CTE, MINED_CTE, COMMON_CTE, _UNIQUE_FROM_COMMON, body="""
SELECT count(*) AS n_touched, count(*) FILTER (WHERE new <> target_text) AS n_still_different FROM (
  SELECT target_text, source_text,
         list_reduce((SELECT list({'k': key, 'v': value} ORDER BY rank) FROM umap),
                     lambda acc, x: replace(acc, x.k, x.v), source_text) AS new FROM kept
  WHERE EXISTS (SELECT 1 FROM umap WHERE contains(source_text, key)))"""))
def q_e11_counters(spark, sf):
    """Rows that the unambiguous map touches, and those that still differ then."""
    common = _lexicon(spark, sf)["common"]
    unique = common.where(is_symbol("key")).select("key", "value", "rank")
    return subst.apply_unique_map(dataset.prepare_pairs(fx.raw_pairs(spark, sf)), unique)[1]


@register("o4_train_on_all", with_fixtures(["PAIRS"], body="""
SELECT count(*) AS n_rows, CAST(ceil(0.1 * count(*)) AS BIGINT) AS n_overlap FROM pairs"""))
def q_o4_all(spark, sf):
    """O4 that trains on all rows: how many rows are in both splits."""
    rows = fx.pairs(spark, sf).select("row_id")
    return dataset.split_overlap(dataset.train_valid_split(rows, train_on_all=True))
