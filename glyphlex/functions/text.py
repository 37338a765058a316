"""Native text expressions: case, width, spaces, punctuation, character classes.

Every function maps Columns to a Column and stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- width tables (E2), generated from the rule full = half + 0xFEE0 ---------
_WIDTH_OFFSET = 0xFEE0
_CLASSES = {
    "lower": [(0x61, 0x7A)],
    "upper": [(0x41, 0x5A)],
    "digits": [(0x30, 0x39)],
    "punctuation": [(0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E)],
}


def width_table(lower: bool = True, upper: bool = True, digits: bool = True,
                punctuation: bool = True) -> tuple[str, str]:
    """(half, full) strings of equal length for the chosen classes.

    U+3000 (ideographic space) is deliberately not part of the table.
    """
    chosen = {"lower": lower, "upper": upper, "digits": digits,
              "punctuation": punctuation}
    half = []
    for name, ranges in _CLASSES.items():
        if chosen[name]:
            for lo, hi in ranges:
                half.extend(range(lo, hi + 1))
    return ("".join(chr(c) for c in half),
            "".join(chr(c + _WIDTH_OFFSET) for c in half))


def to_half(text, lower: bool = True, upper: bool = True, digits: bool = True,
            punctuation: bool = True) -> Column:
    """Full-width -> half-width for the switched-on classes."""
    half, full = width_table(lower, upper, digits, punctuation)
    if not half:
        return _col(text)
    return F.translate(_col(text), full, half)


def to_full(text, lower: bool = True, upper: bool = True, digits: bool = True,
            punctuation: bool = True) -> Column:
    """Half-width -> full-width for the switched-on classes."""
    half, full = width_table(lower, upper, digits, punctuation)
    if not half:
        return _col(text)
    return F.translate(_col(text), half, full)


def convert_width(text, mode: str = "full2half", **classes) -> Column:
    """E2 with the reference's mode names; an unknown mode is an error."""
    if mode == "full2half":
        return to_half(text, **classes)
    if mode == "half2full":
        return to_full(text, **classes)
    raise ValueError("mode must be 'half2full' or 'full2half'")


def normalize_text(text, full2half: bool = True) -> Column:
    """Unicode lower case, then punctuation-only full -> half width."""
    lowered = F.lower(_col(text))
    if not full2half:
        return lowered
    return to_half(lowered, lower=False, upper=False, digits=False, punctuation=True)


def remove_spaces(text) -> Column:
    """Drop U+0020 only (other white space is kept)."""
    return F.replace(_col(text), F.lit(" "), F.lit(""))


# --- fixed values: punctuation widening table (E5), in application order ----
PUNCT_WIDEN = [
    (",", "，"),
    ("...", "…"),
    ("!", "！"),
    ("?", "？"),
    ("(", "（"),
    (")", "）"),
    ("#", "＃"),
    (".", "。"),
    (":", "："),
    (";", "；"),
]
# ---------------------------------------------------------------------------


def align_punct(raw, pred, table=PUNCT_WIDEN) -> Column:
    """E5: where the raw text uses the wide form, widen every narrow form in pred.

    Applied in table order (so ``...`` is handled before ``.``), then spaces go.
    """
    raw_c, out = _col(raw), _col(pred)
    for narrow, wide in table:
        # replacing the narrow form by itself is a no-op, so each step references
        # ``out`` once and the expression stays linear in the table size
        target = F.when(F.instr(raw_c, wide) > 0, F.lit(wide)).otherwise(F.lit(narrow))
        out = F.replace(out, F.lit(narrow), target)
    # an ASCII text uses no wide form
    ascii_only = F.octet_length(raw_c) == F.length(raw_c) if all(
        not wide.isascii() for _, wide in table) else F.lit(False)
    return remove_spaces(F.when(ascii_only, _col(pred)).otherwise(out))


# character classes used by the reconcile and vote rules
CJK_CLASS = r"\x{4E00}-\x{9FA5}"
# the complement spelled out: a negated class is tested about eight times slower
NOT_CJK_ALNUM = r"[\x{0}-\x{2F}\x{3A}-\x{40}\x{5B}-\x{60}\x{7B}-\x{4DFF}\x{9FA6}-\x{10FFFF}]+"
NOT_CJK = r"[^" + CJK_CLASS + r"]+"
CJK_FIRST = r"^[" + CJK_CLASS + r"]"
CJK_OR_ALNUM_FIRST = r"^[" + CJK_CLASS + r"a-zA-Z0-9]"


def keep_cjk_alnum(text) -> Column:
    """Keep CJK ideographs (4E00-9FA5) and ASCII letters/digits."""
    # spaces go first: each would be a match of its own
    return F.regexp_replace(remove_spaces(text), NOT_CJK_ALNUM, "")


def keep_cjk(text) -> Column:
    """Keep CJK ideographs (4E00-9FA5) only."""
    return F.regexp_replace(_col(text), NOT_CJK, "")


def placeholder_digit(value) -> Column:
    """A value ``:d:`` becomes ``d``."""
    return F.regexp_replace(_col(value), r"^:(\d):$", "$1")


def add_prefix(text, prefix: str) -> Column:
    """Prepend a constant task prefix."""
    return F.concat(F.lit(prefix), _col(text)) if prefix else _col(text)


def strip_and_wrap(value, bos: str = "", eos: str = "") -> Column:
    """C4: drop the first and last character, then add begin/end markers."""
    v = _col(value)
    inner = F.substring(v, F.lit(2), F.greatest(F.length(v) - 2, F.lit(0)))
    return F.concat(F.lit(bos), inner, F.lit(eos))


def char_length(text) -> Column:
    """Length in code points."""
    return F.length(_col(text))


def chars(text) -> Column:
    """The code points of a text as an array (empty text -> empty array)."""
    t = _col(text)
    return F.when(F.length(t) == 0, F.array().cast("array<string>")).otherwise(
        F.split(t, ""))


def rewrite_phrase(text, find: str, replacement: str) -> Column:
    """Literal phrase rewrite."""
    return F.replace(_col(text), F.lit(find), F.lit(replacement))

