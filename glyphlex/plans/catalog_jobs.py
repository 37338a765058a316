"""Registered queries, part 2: text functions, vote, reconcile, pseudo labels,
training-table jobs, encodings and I/O round trips (see ``catalog`` for part 1)."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import dataset, mining, pseudo, reconcile, vocab, vote
from ..operators import dictionaries as dicts
from ..operators import substitute as subst
from ..session import materialize
from . import fixtures as fx
from .catalog import (COMMON_CTE, CUSTOM_CTE, INJ_CTE, MINED_CTE, PREDICT_DICT_CTE, SPECIAL_CTE,
                      _lexicon, _occ_cte, register, rule_dictionary)
from .jobs import observed
from .oracle_fixtures import PAT, q, with_fixtures

# --- fixed values: the oracle's own width and punctuation tables -------------
HALF_P = r"""!"#$%&'()*+,-./:;<=>?@[\]^_`{|}~"""
FULL_P = "！＂＃＄％＆＇（）＊＋，－．／：；＜＝＞？＠［＼］＾＿｀｛｜｝～"
HALF_A = HALF_P + "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
FULL_A = (FULL_P + "０１２３４５６７８９ＡＢＣＤＥＦＧＨＩＪＫＬＭＮＯＰＱＲＳＴＵＶＷＸＹＺ"
          "ａｂｃｄｅｆｇｈｉｊｋｌｍｎｏｐｑｒｓｔｕｖｗｘｙｚ")
WIDEN = [(",", "，"), ("...", "…"), ("!", "！"), ("?", "？"), ("(", "（"), (")", "）"), ("#", "＃"),
         (".", "。"), (":", "："), (";", "；")]
# -----------------------------------------------------------------------------
NOT_CJK = "[^\\x{4E00}-\\x{9FA5}]+"
NOT_CJK_ALNUM = "[^\\x{4E00}-\\x{9FA5}a-zA-Z0-9]+"


def _sql_normalize(expr: str) -> str:
    return f"translate(lower({expr}), {q(FULL_P)}, {q(HALF_P)})"


def _sql_align(raw: str, pred: str) -> str:
    out = pred
    for narrow, wide in WIDEN:
        out = (f"replace({out}, {q(narrow)}, CASE WHEN contains({raw}, {q(wide)}) "
               f"THEN {q(wide)} ELSE {q(narrow)} END)")
    return f"replace({out}, ' ', '')"


# ---------------------------------------------------------------------------
# J1 text functions
# ---------------------------------------------------------------------------

@register("e2_width_to_half", with_fixtures(["WIDE"], body=f"""
SELECT doc_id, pos, translate(wide, {q(FULL_P)}, {q(HALF_P)}) AS restored,
       translate(wide, {q(FULL_P)}, {q(HALF_P)}) = narrow AS same,
       wide <> narrow AS widened
FROM wide"""))
def q_e2_half(spark, sf):
    w = fx.wide(spark, sf)
    r = tx.to_half("wide", lower=False, upper=False, digits=False)
    return w.select("doc_id", "pos", r.alias("restored"), (r == F.col("narrow")).alias("same"),
                    (F.col("wide") != F.col("narrow")).alias("widened"))


@register("e2_width_to_full", with_fixtures(["SENT"], body=f"""
SELECT doc_id, pos, translate(s, {q(HALF_A)}, {q(FULL_A)}) AS widened FROM sent"""))
def q_e2_full(spark, sf):
    s = fx.sentences(spark, sf)
    return s.select("doc_id", "pos", tx.convert_width("s", "half2full").alias("widened"))


@register("e3_normalize_text", with_fixtures(["WIDE"], body=f"""
SELECT doc_id, pos, {_sql_normalize('wide')} AS normalized FROM wide"""))
def q_e3(spark, sf):
    w = fx.wide(spark, sf)
    return w.select("doc_id", "pos", tx.normalize_text("wide").alias("normalized"))


@register("e4_remove_spaces", with_fixtures(["PAIRS"], body="""
SELECT doc_id, pos, replace(target_text, ' ', '') AS compact FROM pairs"""))
def q_e4(spark, sf):
    p = fx.pairs(spark, sf)
    return p.select("doc_id", "pos", tx.remove_spaces("target_text").alias("compact"))


@register("e5_align_punct", with_fixtures(["WIDE"], body=f"""
SELECT doc_id, pos, {_sql_align('wide', 'narrow')} AS aligned FROM wide"""))
def q_e5(spark, sf):
    w = fx.wide(spark, sf)
    return w.select("doc_id", "pos", tx.align_punct("wide", "narrow").alias("aligned"))


@register("e14_keep_cjk_alnum", with_fixtures(["PAIRS"], body=f"""
SELECT doc_id, pos, regexp_replace(target_text, {q(NOT_CJK_ALNUM)}, '', 'g') AS cjk_alnum,
       regexp_replace(target_text, {q(NOT_CJK)}, '', 'g') AS cjk
FROM pairs"""))
def q_e14(spark, sf):
    p = fx.pairs(spark, sf)
    return p.select("doc_id", "pos", tx.keep_cjk_alnum("target_text").alias("cjk_alnum"),
                    tx.keep_cjk("target_text").alias("cjk"))


@register("c4_strip_and_wrap", with_fixtures(["SENT"], body="""
SELECT doc_id, pos, '[' || substr(s, 2, greatest(length(s) - 2, 0)) || ']' AS wrapped
FROM sent"""))
def q_c4(spark, sf):
    s = fx.sentences(spark, sf)
    return s.select("doc_id", "pos", tx.strip_and_wrap("s", "[", "]").alias("wrapped"))


@register("e24_length_and_chars", with_fixtures(["PAIRS"], body="""
SELECT doc_id, pos, CAST(length(source_text) AS BIGINT) AS n_chars,
       CAST(len(string_split(source_text, '')) AS BIGINT) AS n_split,
       CAST(len(string_split(source_text, ' ')) AS BIGINT) AS n_words
FROM pairs"""))
def q_e24(spark, sf):
    p = fx.pairs(spark, sf)
    return p.select("doc_id", "pos", F.length("source_text").cast("long").alias("n_chars"),
                    F.size(tx.chars("source_text")).cast("long").alias("n_split"),
                    F.size(F.split("source_text", " ", -1)).cast("long").alias("n_words"))


@register("g13_row_distinct_symbols", with_fixtures(["PAIRS"], body=f"""
SELECT doc_id, pos, unnest(list_distinct(regexp_extract_all(source_text, {q(PAT)}, 0))) AS symbol
FROM pairs"""))
def q_g13(spark, sf):
    return vocab.row_distinct_symbols(fx.pairs(spark, sf), "source_text", keep=("doc_id", "pos"))


# ---------------------------------------------------------------------------
# J11 data set
# ---------------------------------------------------------------------------

_P1_CTE = f"""prep AS (
  SELECT row_id, {_sql_normalize('source_text')} AS source_text,
         replace({_sql_normalize('target_text')}, ' ', '') AS target_text
  FROM pairs)"""
_P1_KEPT = f"""kept AS (
  SELECT * FROM prep WHERE source_text <> target_text
    AND len(regexp_extract_all(source_text, {q(PAT)}, 0)) > 0)"""


@register("p1_prepare_pairs", with_fixtures(["PAIRS"], _P1_CTE, _P1_KEPT,
                                            body="SELECT row_id, source_text, target_text FROM kept"))
def q_p1(spark, sf):
    return dataset.prepare_pairs(fx.raw_pairs(spark, sf))


@register("d1_changed_pairs", with_fixtures(["PAIRS"], _P1_CTE, body="""
SELECT source_text <> target_text AS changed, count(*) AS n_rows FROM prep GROUP BY 1"""))
def q_d1(spark, sf):
    p = dataset.prepare_pairs(fx.raw_pairs(spark, sf), do_filter=False)
    return p.groupBy((F.col("source_text") != F.col("target_text")).alias("changed")).agg(
        F.count(F.lit(1)).alias("n_rows"))


@register("g10_row_funnel", with_fixtures(["PAIRS"], _P1_CTE, body=f"""
SELECT count(*) AS n_raw, count(*) AS n_nonnull,
       count(*) FILTER (WHERE source_text <> target_text) AS n_changed,
       count(*) FILTER (WHERE source_text <> target_text
                        AND len(regexp_extract_all(source_text, {q(PAT)}, 0)) > 0) AS n_kept
FROM prep"""))
def q_g10(spark, sf):
    """Observed while the prepared pairs are written."""
    counts = Observation()
    materialize(dataset.prepare_pairs(fx.raw_pairs(spark, sf), observation=counts), "prepared-pairs")
    return observed(spark, counts)


@register("o2_drop_duplicate_pairs", with_fixtures(["PAIRS"], _P1_CTE, body="""
SELECT min(row_id) AS row_id, source_text, target_text FROM prep
GROUP BY source_text, target_text"""))
def q_o2(spark, sf):
    p = dataset.prepare_pairs(fx.raw_pairs(spark, sf), do_filter=False)
    return dataset.drop_duplicate_pairs(p)


@register("o4_train_valid_split", with_fixtures(["PAIRS"], body="""
SELECT row_id, CASE WHEN rn <= ceil(0.1 * n) THEN 'valid' ELSE 'train' END AS split
FROM (SELECT row_id, row_number() OVER (ORDER BY md5('42' || CAST(row_id AS VARCHAR)), row_id) AS rn,
             count(*) OVER () AS n FROM pairs)"""))
def q_o4(spark, sf):
    p = fx.pairs(spark, sf).select("row_id")
    return dataset.train_valid_split(p).select("row_id", "split")


@register("g9_length_profile", with_fixtures(["PAIRS"], body="""
SELECT c AS "column", count(l) AS n, round(avg(l), 6) AS mean, round(stddev_samp(l), 6) AS std,
       CAST(min(l) AS DOUBLE) AS min, round(quantile_cont(l, 0.25), 6) AS p25,
       round(quantile_cont(l, 0.5), 6) AS p50, round(quantile_cont(l, 0.75), 6) AS p75,
       round(quantile_cont(l, 0.95), 6) AS p95, CAST(max(l) AS DOUBLE) AS max
FROM (SELECT 'source_text' AS c, length(source_text) AS l FROM pairs
      UNION ALL SELECT 'target_text', length(target_text) FROM pairs)
GROUP BY c"""))
def q_g9(spark, sf):
    prof = dataset.length_profile(fx.pairs(spark, sf), ["source_text", "target_text"])
    return prof.select("column", "n", *[F.round(c, 6).alias(c) for c in
                                        ("mean", "std")], "min",
                       *[F.round(c, 6).alias(c) for c in ("p25", "p50", "p75", "p95")], "max")


@register("i4_head_preview", with_fixtures(["PAIRS"], body="""
SELECT row_id, source_text, target_text FROM pairs ORDER BY row_id LIMIT 5"""))
def q_i4(spark, sf):
    p = fx.pairs(spark, sf).select("row_id", "source_text", "target_text")
    return dataset.head(p, 5)


@register("i4_tail_preview", with_fixtures(["PAIRS"], body="""
SELECT row_id, source_text, target_text FROM pairs ORDER BY row_id DESC LIMIT 5"""))
def q_i4_tail(spark, sf):
    p = fx.pairs(spark, sf).select("row_id", "source_text", "target_text")
    return dataset.head(p, 5, tail=True)


@register("i5_preview_sample", with_fixtures(["PAIRS"], body="""
SELECT row_id, source_text FROM pairs
WHERE substr(md5('7:' || CAST(row_id AS VARCHAR)), 1, 8) < '19999999'"""))
def q_i5(spark, sf):
    return dataset.preview_sample(fx.pairs(spark, sf).select("row_id", "source_text"), 0.1, 7)


_VOCAB_CTE = """chars AS (
  SELECT item_id, unnest(cs) AS token, unnest(range(0, len(cs))) AS p
  FROM (SELECT item_id, string_split(text, '') AS cs FROM benchmark WHERE length(text) > 0)),
vocab AS (
  SELECT token, CAST(row_number() OVER (ORDER BY f) - 1 + 4 AS BIGINT) AS token_id
  FROM (SELECT token, min({'r': item_id, 'p': p}) AS f FROM chars
        WHERE token NOT IN ('[PAD]', '[UNK]', '[CLS]', '[SEP]') GROUP BY token)
  UNION ALL SELECT * FROM (VALUES ('[PAD]', 0), ('[UNK]', 1), ('[CLS]', 2), ('[SEP]', 3))
    v(token, token_id))"""


@register("k4_char_vocab", f"WITH {_VOCAB_CTE} SELECT token, token_id FROM vocab")
def q_k4(spark, sf):
    b = fx.read_table(spark, sf, "benchmark").withColumnRenamed("item_id", "row_id")
    return vocab.char_vocab(b, ["text"])


@register("k3_encode", f"""WITH {_VOCAB_CTE},
ids AS (
  SELECT c.item_id, list(COALESCE(v.token_id, 1) ORDER BY c.p) AS l
  FROM chars c LEFT JOIN vocab v USING (token) GROUP BY c.item_id),
enc AS (
  SELECT b.item_id, [2] || COALESCE(l[1:48], []) || [3] AS s FROM benchmark b LEFT JOIN ids USING (item_id))
SELECT item_id, array_to_string(s || list_transform(range(50 - len(s)), lambda x: 0), ' ') AS input_ids,
       array_to_string(list_transform(range(len(s)), lambda x: 1)
                       || list_transform(range(50 - len(s)), lambda x: 0), ' ') AS attention_mask
FROM enc""")
def q_k3(spark, sf):
    b = fx.read_table(spark, sf, "benchmark").withColumnRenamed("item_id", "row_id")
    voc = vocab.char_vocab(b, ["text"])
    enc = dataset.encode(b, "text", voc, 50, "ids")
    return enc.select(F.col("row_id").alias("item_id"),
                      F.array_join(F.col("ids").cast("array<string>"), " ").alias("input_ids"),
                      F.array_join(F.col("ids_mask").cast("array<string>"), " ")
                      .alias("attention_mask"))


@register("k5_truncation_report", """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE length(text) > 48) AS n_truncated_text,
       CAST(floor(count(*) * 10 / 64) AS BIGINT) AS steps
FROM benchmark""")
def q_k5(spark, sf):
    b = fx.read_table(spark, sf, "benchmark")
    return dataset.truncation_report(b, ["text"], 50)


_PAIR_VOCAB_CTE = """chars AS (
  SELECT row_id, side, unnest(string_split(t, '')) AS token, unnest(range(0, length(t))) AS p
  FROM (SELECT row_id, 0 AS side, source_text AS t FROM kept UNION ALL
        SELECT row_id, 1, target_text FROM kept) WHERE length(t) > 0),
vocab AS (
  SELECT token, CAST(row_number() OVER (ORDER BY f) - 1 + 4 AS BIGINT) AS token_id
  FROM (SELECT token, min({'r': row_id, 'c': side, 'p': p}) AS f FROM chars
        WHERE token NOT IN ('[PAD]', '[UNK]', '[CLS]', '[SEP]') GROUP BY token)
  UNION ALL SELECT * FROM (VALUES ('[PAD]', 0), ('[UNK]', 1), ('[CLS]', 2), ('[SEP]', 3))
    v(token, token_id))"""


@register("k4_pair_char_vocab", with_fixtures(["PAIRS"], _P1_CTE, _P1_KEPT, _PAIR_VOCAB_CTE,
                                              body="SELECT token, token_id FROM vocab"))
def q_k4_pairs(spark, sf):
    """K4 over both sides of the training pairs of all documents."""
    prepared = materialize(dataset.prepare_pairs(fx.raw_pairs(spark, sf)), "pairs")
    return vocab.char_vocab(prepared, ["source_text", "target_text"])


@register("k3_encode_training", with_fixtures(["PAIRS"], _P1_CTE, _P1_KEPT, _PAIR_VOCAB_CTE, """
ids AS (
  SELECT row_id, list(token_id ORDER BY p) FILTER (WHERE side = 0) AS s,
         list(token_id ORDER BY p) FILTER (WHERE side = 1) AS t
  FROM chars JOIN vocab USING (token) GROUP BY row_id)""", """enc AS (
  SELECT row_id, [2] || COALESCE(s[1:48], []) || [3] AS s, [2] || COALESCE(t[1:48], []) || [3] AS t
  FROM kept LEFT JOIN ids USING (row_id))""", body="""
SELECT row_id, array_to_string(s || list_transform(range(50 - len(s)), lambda x: 0), ' ') AS source_ids,
       array_to_string(list_transform(range(len(s)), lambda x: 1)
                       || list_transform(range(50 - len(s)), lambda x: 0), ' ') AS source_mask,
       array_to_string(t || list_transform(range(50 - len(t)), lambda x: -100), ' ') AS labels,
       array_to_string(list_transform(range(len(t)), lambda x: 1)
                       || list_transform(range(50 - len(t)), lambda x: 0), ' ') AS target_mask
FROM enc"""))
def q_k3_pairs(spark, sf):
    """K3 over the training pairs of all documents, at the operator's own lengths."""
    prepared = materialize(dataset.prepare_pairs(fx.raw_pairs(spark, sf)), "pairs")
    done = dataset.encode_pairs(prepared, vocab.char_vocab(prepared, ["source_text", "target_text"]))
    return done.select("row_id", *[F.array_join(F.col(c).cast("array<string>"), " ").alias(c) for c in (
        "source_ids", "source_mask", "labels", "target_mask")])


@register("k5_pair_truncation", with_fixtures(["PAIRS"], _P1_CTE, _P1_KEPT, body="""
SELECT count(*) AS n_rows, count(*) FILTER (WHERE length(source_text) > 48) AS n_truncated_source_text,
       count(*) FILTER (WHERE length(target_text) > 48) AS n_truncated_target_text,
       CAST(floor(count(*) * 10 / 64) AS BIGINT) AS steps
FROM kept"""))
def q_k5_pairs(spark, sf):
    """K5 over both sides of the training pairs of all documents."""
    return dataset.truncation_report(dataset.prepare_pairs(fx.raw_pairs(spark, sf)),
                                     ["source_text", "target_text"], 50)


# ---------------------------------------------------------------------------
# J9 vote, J10 pseudo labels
# ---------------------------------------------------------------------------

def _vote_ctes(fb: str) -> list[str]:
    return [
        """agg AS (SELECT id, prediction, count(*) AS cnt, min(sys_pos) AS fp
                   FROM cand GROUP BY id, prediction)""",
        """rk AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY cnt DESC, fp) AS rn FROM agg)""",
        """top AS (SELECT id, max(CASE WHEN rn = 1 THEN prediction END) AS p1,
                          max(CASE WHEN rn = 1 THEN cnt END) AS c1,
                          max(CASE WHEN rn = 2 THEN prediction END) AS p2,
                          max(CASE WHEN rn = 2 THEN cnt END) AS c2 FROM rk GROUP BY id)""",
        f"fbt AS (SELECT id, prediction AS fb FROM cand WHERE system = {q(fb)})",
        """v AS (SELECT t.*, f.fb, p.source_text AS raw,
                   CASE WHEN c1 = 2 AND c2 = 2 AND contains(p2, f.fb) THEN p2 ELSE p1 END AS vp0,
                   CASE WHEN c1 = 2 AND c2 = 2 AND contains(p2, f.fb) THEN c2 ELSE c1 END AS vote_cnt
                 FROM top t JOIN fbt f USING (id) JOIN pairs p ON p.row_id = t.id)""",
        f"""w AS (SELECT *, CASE WHEN vote_cnt = 1 THEN fb ELSE vp0 END AS vp,
                         regexp_replace(raw, {q(NOT_CJK)}, '', 'g') AS raw_ch FROM v)""",
        f"""voted AS (SELECT id, CASE WHEN length(regexp_replace(vp, {q(NOT_CJK)}, '', 'g')) < length(raw_ch)
                                    OR regexp_replace(vp, {q(NOT_CJK)}, '', 'g') = raw_ch
                               THEN fb ELSE vp END AS prediction,
                          vote_cnt, c1 AS top_cnt, p1 AS top_prediction FROM w)""",
    ]


def _voted(spark, sf, fallback="lowest", p=None):
    return vote.vote(fx.candidates(spark, sf, p), fx.test_table(spark, sf, p), fallback,
                     systems=fx.SYSTEMS)


@register("p13_vote_lowest", with_fixtures(["CAND"], *_vote_ctes("s3"), body="SELECT * FROM voted"))
def q_p13_low(spark, sf):
    return _voted(spark, sf, "lowest")


@register("p13_vote_highest", with_fixtures(["CAND"], *_vote_ctes("s0"),
                                            body="SELECT * FROM voted"))
def q_p13_high(spark, sf):
    return _voted(spark, sf, "highest")


@register("g8_vote_histogram", with_fixtures(["CAND"], *_vote_ctes("s3"), body="""
SELECT vote_cnt, count(*) AS n_rows FROM voted GROUP BY vote_cnt"""))
def q_g8(spark, sf):
    return vote.vote_histogram(_voted(spark, sf))


@register("h4_top_two_answers", with_fixtures(["CAND"], *_vote_ctes("s3")[:3], body="""
SELECT id, p1, c1, p2, c2 FROM top"""))
def q_h4(spark, sf):
    c = fx.candidates(spark, sf)
    return vote.top_two(c, vote.fallback_position(c, systems=fx.SYSTEMS)).select(
        "id", "p1", "c1", "p2", "c2")


@register("f2_kway_alignment", with_fixtures(["CAND"], body="""
SELECT id, string_agg(prediction, '|' ORDER BY sys_pos) AS answers FROM cand GROUP BY id"""))
def q_f2(spark, sf):
    c = fx.candidates(spark, sf)
    return vote.aligned_answers(c).select("id", F.array_join(F.transform(
        "answers", lambda x: x["prediction"]), "|").alias("answers"))


_P14_BODY = """SELECT id, top_prediction AS prediction, CAST(k AS BIGINT) AS min_votes
FROM voted CROSS JOIN range(3, 7) r(k) WHERE top_cnt >= k"""


@register("p14_pseudo_labels", with_fixtures(["CAND"], *_vote_ctes("s3"), body=_P14_BODY))
def q_p14(spark, sf):
    return vote.pseudo_labels(_voted(spark, sf)).withColumn(
        "min_votes", F.col("min_votes").cast("long"))


_RULE_CTES = [_occ_cte(), INJ_CTE, MINED_CTE, COMMON_CTE, SPECIAL_CTE, PREDICT_DICT_CTE,
              """rulep AS (SELECT row_id AS id, list_reduce(
                   (SELECT list({'k': key, 'v': value} ORDER BY rank) FROM pdict),
                   lambda acc, x: replace(acc, x.k, x.v), source_text) AS prediction FROM pairs)"""]


def _rule_predictions(spark, sf, p=None, lex=None):
    d = rule_dictionary(spark, sf, lex)
    t = fx.test_table(spark, sf, p)
    return subst.apply_fold(t, "text", d, "prediction").select("id", "prediction")


@register("p15_pseudo_pairs", with_fixtures(["CAND"], *_vote_ctes("s3"), *_RULE_CTES, body=f"""
SELECT l.id, l.min_votes, r.prediction AS source_text, l.prediction AS target_text
FROM ({_P14_BODY}) l JOIN rulep r USING (id)"""))
def q_p15(spark, sf):
    labels = vote.pseudo_labels(_voted(spark, sf)).withColumn(
        "min_votes", F.col("min_votes").cast("long"))
    return pseudo.pseudo_pairs(labels, _rule_predictions(spark, sf))


def _train_dictionary(spark, sf, p=None):
    """P8 for the fixture: the mined common map stands in for the speech labels,
    P3's unique map and the custom symbols override it."""
    raw = fx.raw_pairs(spark, sf, materialize(fx.pairs(spark, sf), "pairs") if p is None else p)
    # mined here and rewritten by the callers: prepared once
    prepared = materialize(dataset.prepare_pairs(raw), "prepared-pairs")
    unique = mining.unique_dictionary(mining.mine_unique(prepared, ranked=False))
    labels = mining.mine_lexicon(raw, ranked=False)["common"].select("key", "value", "rank")
    return prepared, dicts.build_dictionary(None, labels, unique,
                                            dicts.from_mapping(spark, dicts.CUSTOM_SYMBOLS))


_TRAIN_DICT_CTE = """tdict AS (SELECT map_from_entries(list({'k': key, 'v': value})) AS m FROM (
  SELECT key, value FROM common WHERE key NOT IN (SELECT key FROM custom)
  UNION ALL SELECT key, value FROM custom))"""
_P10_CTE = f"""p10 AS (
  SELECT min(row_id) AS row_id, source_text, target_text FROM (
    SELECT row_id, replace(list_reduce(regexp_extract_all(source_text, {q(PAT)}, 0),
             lambda acc, e: replace(acc, e, coalesce(m[e], '[UNK]')), source_text), ' ', '')
             AS source_text, target_text
    FROM kept, tdict)
  GROUP BY source_text, target_text)"""


@register("p10_training_table", with_fixtures(["PAIRS"], _P1_CTE, _P1_KEPT, _occ_cte(), INJ_CTE,
                                              MINED_CTE, COMMON_CTE, CUSTOM_CTE, _TRAIN_DICT_CTE,
                                              _P10_CTE, body="SELECT * FROM p10"))
def q_p10(spark, sf):
    prepared, d = _train_dictionary(spark, sf)
    return dataset.training_table(prepared, d)


@register("p16_add_pseudo", with_fixtures(["CAND"], *_vote_ctes("s3"), _P1_CTE, _P1_KEPT,
                                          _occ_cte(), INJ_CTE, MINED_CTE, COMMON_CTE, CUSTOM_CTE,
                                          _TRAIN_DICT_CTE, _P10_CTE, body=f"""
SELECT row_id, source_text, target_text, 'train' AS origin FROM p10
UNION ALL
SELECT l.id AS row_id,
       replace(list_reduce(regexp_extract_all({_sql_normalize('p.source_text')}, {q(PAT)}, 0),
               lambda acc, e: replace(acc, e, coalesce(m[e], '[UNK]')),
               {_sql_normalize('p.source_text')}), ' ', '') AS source_text,
       replace({_sql_normalize('l.prediction')}, ' ', '') AS target_text, 'pseudo' AS origin
FROM ({_P14_BODY}) l JOIN pairs p ON p.row_id = l.id, tdict
WHERE l.min_votes = 4"""))
def q_p16(spark, sf):
    # mined, voted on and looked up here: the pairs are written once
    p = materialize(fx.pairs(spark, sf), "pairs")
    prepared, d = _train_dictionary(spark, sf, p)
    training = dataset.training_table(prepared, d)
    labels = vote.pseudo_labels(_voted(spark, sf, p=p)).where(F.col("min_votes") == 4)
    return pseudo.add_pseudo(labels, fx.test_table(spark, sf, p), training, d)


# ---------------------------------------------------------------------------
# J8 reconcile
# ---------------------------------------------------------------------------

def _symbol_keys(spark, sf, lex=None):
    return dicts.symbol_keys((_lexicon(spark, sf) if lex is None else lex)["common"])


@register("p11_reconcile", with_fixtures(["RECON"], body="""
SELECT id,
       CASE WHEN rule = model THEN 'equal' WHEN contains(rule, '猫') THEN 'rule' ELSE 'model' END
         AS decision,
       CASE WHEN rule = model THEN model
            WHEN contains(rule, '猫') THEN replace(rule, '人工驾驶', '跑步')
            ELSE replace(model, '人工驾驶', '跑步') END AS prediction
FROM recon"""))
def q_p11(spark, sf):
    r = reconcile.reconcile(fx.reconcile_inputs(spark, sf), _symbol_keys(spark, sf))
    return r.select("id", "decision", "prediction")


_DECIDED = f"""decided AS (
  SELECT CASE WHEN rule = model THEN 'equal' WHEN contains(rule, '猫') THEN 'rule'
              ELSE 'model' END AS decision,
         rule <> model AND
         length(regexp_replace(model, {q(NOT_CJK_ALNUM)}, '', 'g'))
           > 3 * greatest(1, len(list_distinct(regexp_extract_all(raw, {q(PAT)}, 0))))
             + length(regexp_replace(list_reduce(
                 (SELECT list(key ORDER BY rank) FROM common
                  WHERE regexp_full_match(key, {q(PAT)})),
                 lambda acc, k: replace(acc, k, ''), replace(raw, ' ', '')),
                 {q(NOT_CJK_ALNUM)}, '', 'g')) AS too_long
  FROM recon)"""


@register("g12_decision_counters", with_fixtures(["RECON"], _occ_cte(), INJ_CTE, MINED_CTE,
                                                 COMMON_CTE, _DECIDED, body="""
SELECT count(*) FILTER (WHERE decision = 'equal') AS same,
       count(*) FILTER (WHERE decision = 'rule') AS use_map,
       count(*) FILTER (WHERE decision = 'model') AS use_model,
       count(*) FILTER (WHERE too_long) AS too_long
FROM decided"""))
def q_g12(spark, sf):
    """Observed while the reconciled rows are written."""
    counts = Observation()
    materialize(reconcile.reconcile(fx.reconcile_inputs(spark, sf), _symbol_keys(spark, sf),
                                    observation=counts), "reconciled")
    return observed(spark, counts)


@register("d10_too_long_flag", with_fixtures(["RECON"], _occ_cte(), INJ_CTE, MINED_CTE, COMMON_CTE,
                                             _DECIDED, body="""
SELECT decision, count(*) FILTER (WHERE too_long) AS n_too_long, count(*) AS n_rows
FROM decided GROUP BY decision"""))
def q_d10(spark, sf):
    r = reconcile.reconcile(fx.reconcile_inputs(spark, sf), _symbol_keys(spark, sf))
    return r.groupBy("decision").agg(F.count_if("too_long").alias("n_too_long"),
                                     F.count(F.lit(1)).alias("n_rows"))


@register("p12_reconcile_many", None)
def q_p12(spark, sf):
    # the pairs are written and the lexicon mined once for the systems, texts and keys
    p = materialize(fx.pairs(spark, sf), "pairs")
    lex = _lexicon(spark, sf, p)
    return reconcile.reconcile_many(fx.candidates(spark, sf, p), fx.test_table(spark, sf, p),
                                    _rule_predictions(spark, sf, p, lex), _symbol_keys(spark, sf, lex))


@register("f1_row_aligned_join", with_fixtures(["CAND"], body="""
SELECT id, max(CASE WHEN system = 's0' THEN prediction END) AS s0_prediction,
       max(CASE WHEN system = 's1' THEN prediction END) AS s1_prediction
FROM cand GROUP BY id"""))
def q_f1(spark, sf):
    c = fx.candidates(spark, sf)
    left = c.where(F.col("system") == "s0").select("id", F.col("prediction").alias("s0_prediction"))
    right = c.where(F.col("system") == "s1").select("id", F.col("prediction").alias("s1_prediction"))
    return reconcile.aligned(left, right)


# ---------------------------------------------------------------------------
# J6 flags and deletions
# ---------------------------------------------------------------------------

_AMB_CTES = [_occ_cte("pairs_amb"), INJ_CTE, """mined_amb AS (
  SELECT key, text, count(*) AS cnt, min({'r': row_id, 's': seq}) AS first
  FROM (SELECT o.symbol AS key, o.row_id, o.seq,
               CASE WHEN o.symbol = '🐱' AND substr(md5(CAST(o.doc_id AS VARCHAR)), 1, 1) >= '8'
                    THEN '咪' ELSE i.word END AS text
        FROM occ o JOIN inj i ON i.sym = o.symbol)
  GROUP BY key, text)""", """amb AS (SELECT DISTINCT key FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY first) AS tp,
         count(*) OVER (PARTITION BY key) AS nk FROM mined_amb) WHERE tp <= 3 AND nk > 1 AND cnt > 2)"""]


@register("e12_ambiguity_flag", with_fixtures(["PAIRS_AMB"], *_AMB_CTES, body="""
SELECT EXISTS (SELECT 1 FROM amb WHERE contains(p.source_text, amb.key)) AS has_ambiguous,
       count(*) AS n_rows
FROM pairs_amb p GROUP BY 1"""))
def q_e12(spark, sf):
    p = fx.pairs(spark, sf, ambiguous=True)
    keys = mining.mine_lexicon(p)["ambiguous"].select("key").distinct()
    flagged = subst.contains_any_key(p, "source_text", keys, "has_ambiguous", row_id="row_id")
    return flagged.groupBy("has_ambiguous").agg(F.count(F.lit(1)).alias("n_rows"))


@register("f8_contains_semi_join", with_fixtures(["PAIRS"], _occ_cte(), INJ_CTE, MINED_CTE,
                                                 COMMON_CTE, body="""
SELECT doc_id, pos FROM pairs p
WHERE EXISTS (SELECT 1 FROM common c WHERE contains(p.source_text, c.key))"""))
def q_f8(spark, sf):
    p = fx.pairs(spark, sf)
    keys = _lexicon(spark, sf)["common"].select("key")
    flagged = subst.contains_any_key(p, "source_text", keys, "_hit", row_id="row_id")
    return flagged.where("_hit").select("doc_id", "pos")


@register("e13_symbol_deletion", with_fixtures(["PAIRS"], _occ_cte(), INJ_CTE, MINED_CTE,
                                               COMMON_CTE, body="""
SELECT doc_id, pos, list_reduce((SELECT list(key ORDER BY rank) FROM common
                                 WHERE regexp_full_match(key, '""" + PAT.replace("'", "''") + """')),
                                lambda acc, k: replace(acc, k, ''), source_text) AS stripped
FROM pairs"""))
def q_e13(spark, sf):
    p = fx.pairs(spark, sf)
    keys = _symbol_keys(spark, sf)
    return subst.delete_keys(p, "source_text", keys, "stripped").select("doc_id", "pos", "stripped")


@register("d9_symbol_key_filter", with_fixtures(["PAIRS"], _occ_cte(), INJ_CTE, MINED_CTE,
                                                COMMON_CTE, CUSTOM_CTE, SPECIAL_CTE, body=f"""
SELECT key FROM (SELECT key FROM common UNION SELECT key FROM special
                 UNION SELECT key FROM custom)
WHERE regexp_full_match(key, {q(PAT)})"""))
def q_d9(spark, sf):
    common = _lexicon(spark, sf)["common"]
    allk = dicts.merge([common, dicts.from_mapping(spark, dicts.SPECIAL_SYMBOLS),
                        dicts.from_mapping(spark, dicts.CUSTOM_SYMBOLS)])
    return dicts.symbol_keys(allk).select("key")


@register("o3_key_union_difference", with_fixtures(["PAIRS"], _occ_cte(), INJ_CTE, MINED_CTE,
                                                   COMMON_CTE, CUSTOM_CTE, body="""
SELECT key, 'union' AS kind FROM (SELECT key FROM common UNION SELECT key FROM custom)
UNION ALL
SELECT key, 'custom_only' FROM (SELECT key FROM custom EXCEPT SELECT key FROM common)"""))
def q_o3(spark, sf):
    common = _lexicon(spark, sf)["common"].select("key")
    custom = dicts.from_mapping(spark, dicts.CUSTOM_SYMBOLS).select("key")
    union = common.union(custom).distinct().withColumn("kind", F.lit("union"))
    only = custom.join(common, "key", "left_anti").distinct().withColumn("kind", F.lit("custom_only"))
    return union.unionByName(only)


# ---------------------------------------------------------------------------
# J7 batch prediction with a pluggable predictor
# ---------------------------------------------------------------------------

@register("k2_batch_predict", with_fixtures(["PAIRS"], _occ_cte(), INJ_CTE, MINED_CTE,
                                            COMMON_CTE, CUSTOM_CTE, _TRAIN_DICT_CTE, body=f"""
SELECT row_id AS id, replace(replace(replace(
         list_reduce(regexp_extract_all({_sql_normalize('source_text')}, {q(PAT)}, 0),
           lambda acc, e: replace(acc, e, coalesce(m[e], '[UNK]')),
           {_sql_normalize('source_text')}), ' ', ''), '狗', '小狗'), ' ', '') AS prediction
FROM pairs, tdict"""))
def q_k2(spark, sf):
    from ..operators import predict
    common = _lexicon(spark, sf)["common"]
    d = dicts.merge([common, dicts.from_mapping(spark, dicts.CUSTOM_SYMBOLS)], policy="last")
    t = fx.test_table(spark, sf)
    predictor = predict.DictionaryPredictor([("狗", "小狗")])
    return predict.predict_table(t, d, predictor, batch_size=32)


# ---------------------------------------------------------------------------
# sources and sinks: round trips through the shared scratch folder
# ---------------------------------------------------------------------------

@register("b1_tsv_round_trip", with_fixtures(["PAIRS"], body="""
SELECT row_id, source_text, target_text FROM pairs"""))
def q_b1(spark, sf):
    from ..session import scratch_path
    from ..sources import io
    path = scratch_path(spark, "pairs-tsv")
    p = fx.pairs(spark, sf).select("row_id", "source_text", "target_text")
    io.write_tsv(p, path)
    return io.read_tsv(spark, path, "row_id long, source_text string, target_text string")


@register("a7_candidate_scan", with_fixtures(["CAND"], body="""
SELECT id, system, CAST(score AS BIGINT) AS score, prediction FROM cand"""))
def q_a7(spark, sf):
    from ..session import scratch_path
    from ..sources import io
    base = scratch_path(spark, "candidates")
    c = fx.candidates(spark, sf).select("id", "prediction", F.col("score").alias("res"))
    names = {name: f"{base}/res={score}" for name, score, _pos in fx.SYSTEMS}
    for path in names.values():  # a system without rows has a file, too
        io.write_tsv(c.drop("res").limit(0), path)
    io.write_tsv(c, base, mode="append", by="res", compression="gzip")
    read = io.read_candidates(spark, names)
    return read.select("id", "system", F.col("score").cast("long").alias("score"), "prediction")


@register("b2_dictionary_json_round_trip", with_fixtures(["PAIRS"], _occ_cte(), INJ_CTE,
                                                         MINED_CTE, COMMON_CTE, SPECIAL_CTE,
                                                         PREDICT_DICT_CTE,
                                                         body="SELECT key, value, rank FROM pdict"))
def q_b2(spark, sf):
    from ..session import scratch_path
    from ..sources import io
    path = scratch_path(spark, "dictionary-json")
    io.write_dict_json(rule_dictionary(spark, sf), path)
    return io.read_dict(spark, path)


@register("b3_threshold_fanout", with_fixtures(["CAND"], *_vote_ctes("s3"), body=_P14_BODY))
def q_b3(spark, sf):
    from ..session import scratch_path
    from ..sources import io
    path = scratch_path(spark, "pseudo")
    labels = vote.pseudo_labels(_voted(spark, sf)).withColumn(
        "min_votes", F.col("min_votes").cast("long"))
    io.write_partitioned(labels, path, "min_votes")
    back = spark.read.parquet(path)
    return back.select("id", "prediction", F.col("min_votes").cast("long").alias("min_votes"))



# ---------------------------------------------------------------------------
# E11, G5, P8 and the annotation round trip
# ---------------------------------------------------------------------------

_UNIQUE_FROM_COMMON = """umap AS (SELECT key, value, rank FROM common
                                  WHERE regexp_full_match(key, '""" + PAT.replace("'", "''") + """'))"""


@register("e11_unique_map_filter", with_fixtures(["PAIRS"], _P1_CTE, _P1_KEPT, _occ_cte(), INJ_CTE,
                                                 MINED_CTE, COMMON_CTE, _UNIQUE_FROM_COMMON, body="""
SELECT row_id, source_text, target_text FROM (
  SELECT row_id, list_reduce((SELECT list({'k': key, 'v': value} ORDER BY rank) FROM umap),
                             lambda acc, x: replace(acc, x.k, x.v), source_text) AS source_text,
         target_text
  FROM kept)
WHERE source_text <> target_text"""))
def q_e11(spark, sf):
    # the unambiguous map: single-symbol keys of the mined lexicon (one text each)
    common = _lexicon(spark, sf)["common"]
    unique = common.where(F.col("key").rlike("^" + PAT + "$")).select("key", "value", "rank")
    prepared = dataset.prepare_pairs(fx.raw_pairs(spark, sf))
    kept, _counters = subst.apply_unique_map(prepared, unique)
    return kept.select("row_id", "source_text", "target_text")


@register("g5_texts_per_key", with_fixtures(["PAIRS"], _occ_cte(), INJ_CTE, MINED_CTE, body="""
SELECT key, text FROM mined"""))
def q_g5(spark, sf):
    pairs = mining.mined_pairs(fx.pairs(spark, sf))
    return mining.texts_per_key(pairs)


@register("p8_build_dictionary", with_fixtures(["PAIRS"], _occ_cte(), INJ_CTE, MINED_CTE,
                                               COMMON_CTE, CUSTOM_CTE, body="""
SELECT key, value, row_number() OVER (ORDER BY pos_p, pos_r) - 1 AS rank FROM (
  SELECT key, arg_max(value, prio * 1000000 + rank) AS value,
         min(prio) AS pos_p, arg_min(rank, prio * 1000000 + rank) AS pos_r
  FROM (SELECT key, value, 0 AS prio, rank FROM common
        UNION ALL SELECT key, value, 2, rank FROM custom)
  GROUP BY key)"""))
def q_p8(spark, sf):
    _prepared, d = _train_dictionary(spark, sf)
    return d


@register("p6_build_labels", with_fixtures(["PAIRS"], _occ_cte(), INJ_CTE, MINED_CTE, COMMON_CTE,
                                           body="""
SELECT key, value, rank FROM common"""))
def q_p6(spark, sf):
    """Annotation round trip: the mined lexicon is written as an annotation XML
    document (one ``tts`` and one alias element per symbol, in rank order) by
    Spark's XML writer, read back (A3) and turned into speech labels (P6).  The
    words are written as ``旗: WORD手势: 较浅肤色``, which the label rules undo."""
    from ..operators import labels as lj
    from ..session import scratch_path
    from ..sources import io
    common = _lexicon(spark, sf)["common"]
    rows = common.select(
        "rank", F.explode(F.array(
            F.struct(F.col("key").alias("_cp"), F.lit("tts").alias("_type"),
                     F.format_string("旗: %s手势: 较浅肤色", "value").alias("_VALUE"),
                     F.lit(1).alias("k")),
            F.struct(F.col("key").alias("_cp"), F.lit(None).cast("string").alias("_type"),
                     F.concat_ws(" | ", "value", "value").alias("_VALUE"), F.lit(0).alias("k"))))
        .alias("a"))
    path = scratch_path(spark, "annotations")
    (rows.orderBy("rank", "a.k").select("a._cp", "a._type", "a._VALUE")
     .write.format("xml").option("rootTag", "annotations").option("rowTag", "annotation")
     .mode("overwrite").save(path))
    ann = io.read_annotations(spark, path)
    return lj.build_labels([ann])["speech"]
