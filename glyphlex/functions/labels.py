"""Label clean-up rules for symbol annotations (E18, E19, E20) as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: label rules -------------------------------------------------
KEEP_EXACT = ["人", "男", "女"]
KEEP_IF_CONTAINS = "的猫"
CUT_BEFORE_MARKERS = ["的男人", "的女人"]
MARKER = "的"
DROP_CHAR = "者"
DROP_WORDS_A = ["女生", "男生", "手势", "按钮"]
DROP_WORDS_B = ["女生", "男生", "手势", "按钮", "箭头"]
SKIN_WORDS = ["较浅肤色", "较深肤色", "中等-浅肤色", "中等肤色", "中等-深肤色", "肤色"]
DOUBLE_ADULT = "成人成人"
FLAG_PREFIX = "旗: "
TRAILING = ["较", ":", "："]
LONG_ALIAS = 5
ALLOW_LONG_IF = "禁止"
# -------------------------------------------------------------------------------

# Python's str.strip() white space: \s, Unicode separators, U+001C..U+001F, U+0085
_WS = r"[\s\p{Z}\x{1C}-\x{1F}\x{85}]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(text) -> Column:
    """Python ``str.strip()`` (all Unicode white space, not only ASCII blanks)."""
    return F.regexp_replace(_col(text), "^" + _WS + "+|" + _WS + "+$", "")


def _cuts(t: Column, drop_words) -> Column:
    contains_cut = None
    for m in CUT_BEFORE_MARKERS:
        c = F.instr(t, m) > 0
        contains_cut = c if contains_cut is None else (contains_cut | c)
    # text before the first marker, then text after the first marker
    t = F.when(contains_cut, F.regexp_replace(t, "(?s)" + MARKER + ".*$", "")).otherwise(t)
    t = F.when(F.instr(t, MARKER) > 0,
               F.regexp_replace(t, "(?s)^.*?" + MARKER, "")).otherwise(t)
    t = F.replace(t, F.lit(DROP_CHAR), F.lit(""))
    for w in drop_words:
        t = F.replace(t, F.lit(w), F.lit(""))
    return t


def speech_label(text) -> Column:
    """Clean one label text (rules A)."""
    t = _col(text)
    keep = t.isin(*KEEP_EXACT) | (F.instr(t, KEEP_IF_CONTAINS) > 0)
    c = _cuts(t, DROP_WORDS_A)
    for w in SKIN_WORDS:
        c = F.replace(c, F.lit(w), F.lit(""))
    c = F.replace(c, F.lit(DOUBLE_ADULT), F.lit(""))
    c = F.replace(c, F.lit(FLAG_PREFIX), F.lit(""))
    c = py_strip(c)
    for ch in TRAILING:
        c = F.regexp_replace(c, "(?:" + _quote(ch) + ")+$", "")
    return F.when(keep, t).otherwise(c)


def _quote(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\\-" else ch for ch in s)


def usable_alias(a: Column) -> Column:
    """E19 predicate: not a bare person word, no ``的猫``, not long unless ``禁止``."""
    return (~a.isin(*KEEP_EXACT) & (F.instr(a, KEEP_IF_CONTAINS) == 0)
            & ~((F.instr(a, ALLOW_LONG_IF) == 0) & (F.length(a) >= LONG_ALIAS)))


def first_usable_alias(text, trim: bool = False) -> Column:
    """First usable alias of ``a | b | c`` (no inner trimming by default, as
    the reference keeps ``"嘿嘿 "``; ``trim=True`` strips each alias), with the
    rules-B cuts; null when no alias is usable."""
    aliases = F.split(py_strip(text), r"\|", -1)
    if trim:
        aliases = F.transform(aliases, py_strip)
    first = F.try_element_at(F.filter(aliases, usable_alias), F.lit(1))
    return F.when(first.isNull(), F.lit(None).cast("string")).otherwise(
        _cuts(first, DROP_WORDS_B))


def alias_list(text) -> Column:
    """Spaces removed, split on ``|``, E18 on each, empties dropped, distinct, sorted."""
    parts = F.split(F.replace(_col(text), F.lit(" "), F.lit("")), r"\|", -1)
    cleaned = F.transform(parts, speech_label)
    return F.array_sort(F.array_distinct(F.filter(cleaned, lambda x: F.length(x) > 0)))
