"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Names are ``<operator id>_<slug>`` so they line up with the SURVEY inventory.
Each Spark builder reads the driver tables at ``sf_dir`` (through the fixtures)
and returns a DataFrame whose column names equal the oracle's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import vocab
from . import fixtures as fx
from .oracle_fixtures import PAT, q, with_fixtures

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


# ---------------------------------------------------------------------------
# J2 symbols
# ---------------------------------------------------------------------------

@register("e6_extract_symbols", with_fixtures(["PAIRS"], body=f"""
SELECT doc_id, pos, array_to_string(regexp_extract_all(source_text, {q(PAT)}, 0), '|') AS symbols,
       CAST(len(regexp_extract_all(source_text, {q(PAT)}, 0)) AS BIGINT) AS n_symbols
FROM pairs"""))
def q_e6(spark, sf):
    from ..functions.symbols import extract_symbols
    p = fx.pairs(spark, sf).select("doc_id", "pos", extract_symbols("source_text").alias("a"))
    return p.select("doc_id", "pos", F.array_join("a", "|").alias("symbols"),
                    F.size("a").cast("long").alias("n_symbols"))


@register("g1_symbol_frequency", with_fixtures(["PAIRS"], body=f"""
SELECT symbol, count(*) AS cnt
FROM (SELECT unnest(regexp_extract_all(source_text, {q(PAT)}, 0)) AS symbol FROM pairs)
GROUP BY symbol"""))
def q_g1(spark, sf):
    return vocab.symbol_frequency(fx.pairs(spark, sf), "source_text")


@register("g2_symbol_totals", with_fixtures(["PAIRS"], body=f"""
SELECT count(symbol) AS total, count(DISTINCT symbol) AS n_distinct
FROM (SELECT unnest(regexp_extract_all(source_text, {q(PAT)}, 0)) AS symbol FROM pairs)"""))
def q_g2(spark, sf):
    return vocab.symbol_totals(fx.pairs(spark, sf), "source_text")


_P2_SQL = with_fixtures(["PAIRS"], f"""occ AS (
  SELECT row_id, unnest(syms) AS symbol, unnest(range(0, len(syms))) AS seq
  FROM (SELECT row_id, regexp_extract_all(source_text, {q(PAT)}, 0) AS syms FROM pairs))""",
                        """agg AS (
  SELECT symbol, count(*) AS cnt, min(row_id) AS r0 FROM occ GROUP BY symbol)""",
                        """firsts AS (
  SELECT a.symbol, a.cnt, a.r0, min(o.seq) AS s0
  FROM agg a JOIN occ o ON o.symbol = a.symbol AND o.row_id = a.r0
  GROUP BY a.symbol, a.cnt, a.r0)""", body="""
SELECT symbol, cnt,
       row_number() OVER (ORDER BY r0, s0) - 1 AS vocab_id,
       row_number() OVER (ORDER BY cnt DESC, r0, s0) - 1 AS count_rank
FROM firsts""")


@register("p2_symbol_vocab", _P2_SQL)
def q_p2(spark, sf):
    return vocab.symbol_vocab(fx.pairs(spark, sf), "source_text")


# ---------------------------------------------------------------------------
# shared oracle CTEs for the mining fixture
# ---------------------------------------------------------------------------
from ..functions.substitute import UNKNOWN  # noqa: E402
from ..operators import dictionaries as dicts  # noqa: E402
from ..operators import mining  # noqa: E402
from ..operators import substitute as subst  # noqa: E402

_INJ_VALUES = ", ".join(f"({q(s.strip())}, {q(t.strip())})" for _, s, t in fx.INJECTIONS)
_SPECIAL_VALUES = ", ".join(f"({q(k)}, {q(v)}, {i})"
                            for i, (k, v) in enumerate(dicts.SPECIAL_SYMBOLS.items()))
_CUSTOM_VALUES = ", ".join(f"({q(k)}, {q(v)}, {i})"
                           for i, (k, v) in enumerate(dicts.CUSTOM_SYMBOLS.items()))


def _occ_cte(src: str = "pairs", name: str = "occ") -> str:
    return f"""{name} AS (
  SELECT doc_id, row_id, unnest(syms) AS symbol, unnest(range(0, len(syms))) AS seq
  FROM (SELECT doc_id, row_id, regexp_extract_all(source_text, {q(PAT)}, 0) AS syms
        FROM {src} WHERE source_text <> target_text))"""


INJ_CTE = f"inj(sym, word) AS (VALUES {_INJ_VALUES})"
# mined pairs of the fixture: every symbol occurrence yields (symbol, its word)
MINED_CTE = """mined AS (
  SELECT o.symbol AS key, i.word AS text, count(*) AS cnt,
         min({'r': o.row_id, 's': o.seq}) AS first
  FROM occ o JOIN inj i ON i.sym = o.symbol GROUP BY o.symbol, i.word)"""
COMMON_CTE = """common AS (
  SELECT key, text AS value, cnt, first,
         row_number() OVER (ORDER BY length(key) DESC, first) - 1 AS rank
  FROM mined WHERE cnt >= 2)"""
SPECIAL_CTE = f"special(key, value, rank) AS (VALUES {_SPECIAL_VALUES})"
CUSTOM_CTE = f"custom(key, value, rank) AS (VALUES {_CUSTOM_VALUES})"
# P9 dictionary: lexicon, then specials not already present; stable sort by key length
PREDICT_DICT_CTE = """pdict AS (
  SELECT key, value, row_number() OVER (ORDER BY length(key) DESC, prio, rank) - 1 AS rank
  FROM (SELECT key, value, 0 AS prio, rank FROM common
        UNION ALL
        SELECT key, value, 1 AS prio, rank FROM special
        WHERE key NOT IN (SELECT key FROM common)))"""


def _lexicon(spark, sf, p=None):
    lex = mining.mine_lexicon(fx.pairs(spark, sf) if p is None else p)
    return lex


def rule_dictionary(spark, sf, lex=None):
    """P4 -> P5 -> P7 -> P9 dictionary, all derived from the pairs of ``sf``."""
    lex = _lexicon(spark, sf) if lex is None else lex
    refined = dicts.refine(lex["common"])
    oov = dicts.build_oov(dicts.from_mapping(spark, {}), dicts.from_mapping(
        spark, dicts.SPECIAL_SYMBOLS))
    return dicts.predict_dictionary(refined, oov)


# ---------------------------------------------------------------------------
# J3 mining
# ---------------------------------------------------------------------------

@register("e16_diff_pairs", with_fixtures(["PAIRS"], _occ_cte(), INJ_CTE, MINED_CTE,
                                          body="SELECT key, text, cnt FROM mined"))
def q_e16(spark, sf):
    return _lexicon(spark, sf)["counts"].select("key", "text", "cnt")


@register("p4_common_map", with_fixtures(["PAIRS"], _occ_cte(), INJ_CTE, MINED_CTE, COMMON_CTE,
                                         body="SELECT key, value, cnt, rank FROM common"))
def q_p4(spark, sf):
    return _lexicon(spark, sf)["common"].select("key", "value", "cnt", "rank")


_AMB_MINED = """mined_amb AS (
  SELECT key, text, count(*) AS cnt, min({'r': row_id, 's': seq}) AS first
  FROM (SELECT o.symbol AS key, o.row_id, o.seq,
               CASE WHEN o.symbol = '🐱' AND substr(md5(CAST(o.doc_id AS VARCHAR)), 1, 1) >= '8'
                    THEN '咪' ELSE i.word END AS text
        FROM occ o JOIN inj i ON i.sym = o.symbol)
  GROUP BY key, text)"""


@register("g6_ambiguous_keys", with_fixtures(["PAIRS_AMB"], _occ_cte("pairs_amb"), INJ_CTE,
                                             _AMB_MINED, body="""
SELECT key, text, cnt, CAST(row_number() OVER (PARTITION BY key ORDER BY first) - 1 AS BIGINT)
       AS text_rank
FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY first) AS tp,
             count(*) OVER (PARTITION BY key) AS nk FROM mined_amb) t
WHERE tp <= 3 AND nk > 1 AND cnt > 2"""))
def q_g6(spark, sf):
    counts = mining.pair_counts(mining.mined_pairs(fx.pairs(spark, sf, ambiguous=True)))
    return mining.ambiguous_map(counts)


@register("h2_top_text_ambiguous", with_fixtures(["PAIRS_AMB"], _occ_cte("pairs_amb"), INJ_CTE,
                                                 _AMB_MINED, body="""
SELECT key, text AS value, cnt FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY cnt DESC, first) AS rn FROM mined_amb)
WHERE rn = 1"""))
def q_h2(spark, sf):
    counts = mining.pair_counts(mining.mined_pairs(fx.pairs(spark, sf, ambiguous=True)))
    return mining.key_summary(counts).select("key", "value", "cnt")


@register("g11_mining_summary", with_fixtures(["PAIRS_AMB"], _occ_cte("pairs_amb"), INJ_CTE,
                                              _AMB_MINED, body="""
SELECT 'n_mined' AS metric, CAST(count(DISTINCT key) AS BIGINT) AS value FROM mined_amb
UNION ALL SELECT 'n_pairs', CAST(sum(cnt) AS BIGINT) FROM mined_amb
UNION ALL SELECT 'n_kept', CAST(count(*) AS BIGINT) FROM (
  SELECT key FROM mined_amb GROUP BY key HAVING max(cnt) >= 2)
UNION ALL SELECT 'n_ambiguous', CAST(count(DISTINCT key) AS BIGINT) FROM (
  SELECT key FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY first) AS tp,
                          count(*) OVER (PARTITION BY key) AS nk FROM mined_amb)
  WHERE tp <= 3 AND nk > 1 AND cnt > 2)"""))
def q_g11(spark, sf):
    """Observed while the maps are written."""
    return mining.mine_lexicon(fx.pairs(spark, sf, ambiguous=True), report=True)["summary"]


@register("p3_mine_unique", None)
def q_p3(spark, sf):
    from ..operators import dataset
    prepared = dataset.prepare_pairs(fx.raw_pairs(spark, sf))
    return mining.mine_unique(prepared).select("key", "value", "n_texts", "is_symbol",
                                               "unique", "rank")


# ---------------------------------------------------------------------------
# J4 dictionaries
# ---------------------------------------------------------------------------

@register("p5_refine_lexicon", with_fixtures(["PAIRS"], _occ_cte(), INJ_CTE, MINED_CTE,
                                             COMMON_CTE, body=f"""
SELECT key, value, row_number() OVER (ORDER BY length(key) DESC, rank) - 1 AS rank
FROM common c
WHERE NOT (length(key) = 1 AND regexp_matches(key, '^[\\x{{4E00}}-\\x{{9FA5}}a-zA-Z0-9]')
           AND len(regexp_extract_all(key, {q(PAT)}, 0)) = 0)
  AND NOT (regexp_matches(key, '^[\\x{{4E00}}-\\x{{9FA5}}]')
           AND substr(key, 2) IN (SELECT key FROM common))"""))
def q_p5(spark, sf):
    return dicts.refine(_lexicon(spark, sf)["common"])


@register("f5_precedence_merge", with_fixtures(["PAIRS"], _occ_cte(), INJ_CTE, MINED_CTE,
                                               COMMON_CTE, SPECIAL_CTE, CUSTOM_CTE, body="""
SELECT key, value, row_number() OVER (ORDER BY pos_p, pos_r) - 1 AS rank FROM (
  SELECT key, arg_max(value, prio * 1000000 + rank) AS value,
         min(prio) AS pos_p, arg_min(rank, prio * 1000000 + rank) AS pos_r
  FROM (SELECT key, value, 0 AS prio, rank FROM special
        UNION ALL SELECT key, value, 1, rank FROM common
        UNION ALL SELECT key, value, 2, rank FROM custom)
  GROUP BY key)"""))
def q_f5(spark, sf):
    common = _lexicon(spark, sf)["common"]
    return dicts.merge([dicts.from_mapping(spark, dicts.SPECIAL_SYMBOLS), common,
                        dicts.from_mapping(spark, dicts.CUSTOM_SYMBOLS)], policy="last")


def _label_table(spark, sf):
    """Speech-label stand-in derived from the data: the mined common map."""
    return _lexicon(spark, sf)["common"].select("key", "value", "rank")


@register("p7_build_oov", with_fixtures(["PAIRS"], _occ_cte(), INJ_CTE, MINED_CTE, COMMON_CTE,
                                        SPECIAL_CTE, body="""
SELECT key, regexp_replace(value, '^:(\\d):$', '\\1') AS value,
       row_number() OVER (ORDER BY length(key) DESC, pos_p, pos_r) - 1 AS rank FROM (
  SELECT key, arg_max(value, prio * 1000000 + rank) AS value,
         min(prio) AS pos_p, arg_min(rank, prio * 1000000 + rank) AS pos_r
  FROM (SELECT key, value, 0 AS prio, rank FROM common
        UNION ALL SELECT key, value, 1, rank FROM special)
  GROUP BY key)"""))
def q_p7(spark, sf):
    return dicts.build_oov(_label_table(spark, sf),
                           dicts.from_mapping(spark, dicts.SPECIAL_SYMBOLS))


# ---------------------------------------------------------------------------
# J6 substitution and the flagship rule prediction
# ---------------------------------------------------------------------------

@register("p9_rule_predict", with_fixtures(["PAIRS"], _occ_cte(), INJ_CTE, MINED_CTE, COMMON_CTE,
                                           SPECIAL_CTE, PREDICT_DICT_CTE, body="""
SELECT doc_id, pos, list_reduce(
         (SELECT list({'k': key, 'v': value} ORDER BY rank) FROM pdict),
         lambda acc, x: replace(acc, x.k, x.v), source_text) AS prediction
FROM pairs"""))
def q_p9(spark, sf):
    d = rule_dictionary(spark, sf)
    p = fx.pairs(spark, sf).select("doc_id", "pos", "source_text")
    return subst.apply_fold(p, "source_text", d, "prediction").select("doc_id", "pos",
                                                                      "prediction")


@register("e10_fold_cascade", with_fixtures(["PAIRS"], body="""
SELECT doc_id, pos, replace(replace(replace(source_text, '🐶 🐱', '🐱'), '🐱', '猫'), '🐶', '狗')
       AS rewritten
FROM pairs"""))
def q_e10(spark, sf):
    # a three-entry cascade: the output of the first key feeds the second
    d = dicts.from_mapping(spark, {"🐶 🐱": "🐱", "🐱": "猫", "🐶": "狗"})
    p = fx.pairs(spark, sf)
    return subst.apply_fold(p, "source_text", d, "rewritten").select("doc_id", "pos", "rewritten")


@register("e10_fold_arrow", with_fixtures(["PAIRS"], _occ_cte(), INJ_CTE, MINED_CTE, COMMON_CTE,
                                          SPECIAL_CTE, PREDICT_DICT_CTE, body="""
SELECT doc_id, pos, list_reduce(
         (SELECT list({'k': key, 'v': value} ORDER BY rank) FROM pdict),
         lambda acc, x: replace(acc, x.k, x.v), source_text) AS prediction
FROM pairs"""))
def q_e10_arrow(spark, sf):
    # the same dictionary as P9, forced through the Arrow automaton path
    d = rule_dictionary(spark, sf)
    p = fx.pairs(spark, sf).select("doc_id", "pos", "source_text")
    return subst.apply_fold(p, "source_text", d, "prediction", path="arrow").select(
        "doc_id", "pos", "prediction")


_DEMOJI_SQL = with_fixtures(["PAIRS"], _occ_cte(), INJ_CTE, MINED_CTE, COMMON_CTE, CUSTOM_CTE,
                            """dmap AS (SELECT map_from_entries(list({'k': key, 'v': value}))
                                        AS m FROM (SELECT key, value FROM common
                                                   WHERE key NOT IN (SELECT key FROM custom)
                                                   UNION ALL SELECT key, value FROM custom))""",
                            body=f"""
SELECT doc_id, pos, list_reduce(regexp_extract_all(source_text, {q(PAT)}, 0),
         lambda acc, e: replace(acc, e, coalesce(m[e], {q(UNKNOWN)})),
         source_text) AS demojized
FROM pairs, dmap""")


@register("e8_demojize", _DEMOJI_SQL)
def q_e8(spark, sf):
    common = _lexicon(spark, sf)["common"]
    d = dicts.merge([common, dicts.from_mapping(spark, dicts.CUSTOM_SYMBOLS)], policy="last")
    p = fx.pairs(spark, sf)
    return subst.demojize(p, "source_text", d, "demojized").select("doc_id", "pos", "demojized")


@register("f4_demojize_join", _DEMOJI_SQL)
def q_f4(spark, sf):
    common = _lexicon(spark, sf)["common"]
    d = dicts.merge([common, dicts.from_mapping(spark, dicts.CUSTOM_SYMBOLS)], policy="last")
    p = fx.pairs(spark, sf)
    return subst.demojize(p, "source_text", d, "demojized", path="join").select(
        "doc_id", "pos", "demojized")


@register("f9_oov_symbols", with_fixtures(["PAIRS"], _occ_cte(), INJ_CTE, MINED_CTE, COMMON_CTE,
                                          body=f"""
SELECT symbol, count(*) AS cnt
FROM (SELECT unnest(regexp_extract_all(source_text, {q(PAT)}, 0)) AS symbol FROM pairs)
WHERE symbol NOT IN (SELECT key FROM common WHERE key <> '🏃') GROUP BY symbol"""))
def q_f9(spark, sf):
    common = _lexicon(spark, sf)["common"].where(F.col("key") != "🏃")
    p = fx.pairs(spark, sf)
    return subst.oov_symbols(p, "source_text", common)


from . import catalog_jobs, catalog_lists, catalog_rules  # noqa: E402,F401  (registers parts 2 to 4)
