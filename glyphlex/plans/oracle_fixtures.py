"""DuckDB twins of ``plans.fixtures``: CTE text for the oracle SQL.

Built from the same fixed tables as the Spark fixtures so the two cannot drift.
"""

from __future__ import annotations

from ..functions.symbols import FULL_SYMBOL_PATTERN, SYMBOL_PATTERN
from .fixtures import AMBIGUOUS_WORD, INJECTIONS, ROW_ID_STRIDE, SYSTEMS

PAT = SYMBOL_PATTERN
FULL_PAT = FULL_SYMBOL_PATTERN


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def _inject(expr: str, column_index: int, ambiguous: bool = False) -> str:
    out = expr
    for find, src, tgt in INJECTIONS:
        if ambiguous and column_index == 2 and find == " and ":
            rep = (f"CASE WHEN substr(md5(CAST(doc_id AS VARCHAR)), 1, 1) < '8' "
                   f"THEN {q(tgt)} ELSE {q(' ' + AMBIGUOUS_WORD + ' ')} END")
        else:
            rep = q(src if column_index == 1 else tgt)
        out = f"replace({out}, {q(find)}, {rep})"
    return out


SENT = f"""sent AS (
  SELECT doc_id, CAST(pos AS BIGINT) AS pos, doc_id * {ROW_ID_STRIDE} + pos AS row_id, s
  FROM (SELECT doc_id, unnest(parts) AS s, unnest(range(0, len(parts))) AS pos
        FROM (SELECT doc_id, string_split_regex(text, '[.\\n]') AS parts FROM documents))
  WHERE length(s) > 0)"""

PAIRS = f"""pairs AS (
  SELECT doc_id, pos, row_id, {_inject('s', 1)} AS source_text, {_inject('s', 2)} AS target_text
  FROM sent)"""

PAIRS_AMB = f"""pairs_amb AS (
  SELECT doc_id, pos, row_id, {_inject('s', 1)} AS source_text,
         {_inject('s', 2, ambiguous=True)} AS target_text
  FROM sent)"""

WIDE = """wide AS (
  SELECT doc_id, pos, row_id, s AS narrow,
         CASE WHEN doc_id % 2 = 0 THEN replace(replace(s, ',', '，'), '!', '！') ELSE s END AS wide
  FROM sent)"""

_SYS_VALUES = ", ".join(f"({q(n)}, {sc}, {sp})" for n, sc, sp in SYSTEMS)

CAND = f"""cand AS (
  SELECT row_id AS id, system, score, sys_pos,
         CASE WHEN h IN ('a', 'b') THEN replace(target_text, '狗', '猫')
              WHEN h IN ('c', 'd') THEN replace(target_text, '狗', '')
              WHEN h IN ('e', 'f') THEN source_text
              ELSE target_text END AS prediction
  FROM (SELECT p.*, sy.system, sy.score, sy.sys_pos,
               substr(md5(concat_ws('|', CAST(p.doc_id AS VARCHAR), CAST(p.pos AS VARCHAR),
                                    sy.system)), 1, 1) AS h
        FROM pairs p, (VALUES {_SYS_VALUES}) sy(system, score, sys_pos)))"""

RECON = """recon AS (
  SELECT row_id AS id, replace(source_text, '🐱', '猫') AS raw, target_text AS rule,
         CASE WHEN contains(target_text, '猫') THEN replace(target_text, '猫', '')
              WHEN source_text = target_text THEN target_text || '！'
              ELSE target_text END AS model
  FROM pairs)"""

_ORDER = ["SENT", "PAIRS", "PAIRS_AMB", "WIDE", "CAND", "RECON"]
_DEPS = {"PAIRS": ["SENT"], "PAIRS_AMB": ["SENT"], "WIDE": ["SENT"],
         "CAND": ["SENT", "PAIRS"], "RECON": ["SENT", "PAIRS"]}
_TEXT = {"SENT": SENT, "PAIRS": PAIRS, "PAIRS_AMB": PAIRS_AMB, "WIDE": WIDE,
         "CAND": CAND, "RECON": RECON}


def with_fixtures(needed: list[str], *ctes: str, body: str) -> str:
    """``WITH <fixture ctes>, <extra ctes> <body>``."""
    want = set()
    for n in needed:
        want.add(n)
        want.update(_DEPS.get(n, []))
    parts = [_TEXT[n] for n in _ORDER if n in want] + list(ctes)
    return "WITH " + ",\n".join(parts) + "\n" + body
