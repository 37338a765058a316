"""Symbol (emoji) detection as native regular expressions.

The grammar is written with ``\\x{...}`` escapes only, so the same pattern string
is valid in Java regex (Spark) and RE2 (DuckDB oracle) and both engines pick the
same leftmost-first alternative.  Instead of the grammar, every function takes a
closed list of sequences (``closed_list``).
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: symbol grammar -------------------------------------------
# flag pair, keycap, then base [variation selector] [skin tone] [tag sequence]
# (joiner base [variation selector] [skin tone])*; the ranges are those that the
# Unicode emoji data publish, with the all-pictograph blocks taken whole
FLAG = r"[\x{1F1E6}-\x{1F1FF}]{2}"
KEYCAP = r"[0-9#*]\x{FE0F}?\x{20E3}"
TONE = r"[\x{1F3FB}-\x{1F3FF}]"
RANGES = (
    "00A9 00AE 203C 2049 2122 2139 2194-2199 21A9-21AA 231A-231B 2328 23CF 23E9-23F3 23F8-23FA "
    "24C2 25AA-25AB 25B6 25C0 25FB-25FE 2600-2604 260E 2611 2614-2615 2618 261D 2620 2622-2623 "
    "2626 262A 262E-262F 2638-263A 2640 2642 2648-2653 265F-2660 2663 2665-2666 2668 267B "
    "267E-267F 2692-2697 2699 269B-269C 26A0-26A1 26A7 26AA-26AB 26B0-26B1 26BD-26BE 26C4-26C5 "
    "26C8 26CE-26CF 26D1 26D3-26D4 26E9-26EA 26F0-26F5 26F7-26FA 26FD 2702 2705 2708-270D 270F "
    "2712 2714 2716 271D 2721 2728 2733-2734 2744 2747 274C 274E 2753-2755 2757 2763-2764 "
    "2795-2797 27A1 27B0 27BF 2934-2935 2B05-2B07 2B1B-2B1C 2B50 2B55 3030 303D 3297 3299 "
    "1F004 1F0CF 1F170-1F171 1F17E-1F17F 1F18E 1F191-1F19A 1F201-1F202 1F21A 1F22F 1F232-1F23A "
    "1F250-1F251 1F300-1F64F 1F680-1F6FF 1F7E0-1F7EB 1F7F0 1F900-1F9FF 1FA70-1FAFF")
TAGS = r"[\x{E0020}-\x{E007F}]*"
# ---------------------------------------------------------------------------

BASE = "[" + "".join("-".join(r"\x{%s}" % end for end in part.split("-"))
                     for part in RANGES.split()) + "]"
SEQUENCE = (BASE + r"\x{FE0F}?" + TONE + "?" + TAGS
            + r"(?:\x{200D}" + BASE + r"\x{FE0F}?" + TONE + "?)*")
SYMBOL_PATTERN = "(?:" + FLAG + "|" + KEYCAP + "|" + SEQUENCE + ")"
FULL_SYMBOL_PATTERN = "^" + SYMBOL_PATTERN + "$"
#: What no symbol holds; such runs are cut out first, so the long class of the
#: grammar is tried on few characters.
PLAIN_RUN = (r"[^0-9#*\x{A9}\x{AE}\x{200D}-\x{3299}\x{FE0F}\x{1F000}-\x{1FAFF}"
             r"\x{E0020}-\x{E007F}]+")


@dataclass(frozen=True)
class Symbols:
    """What counts as a symbol: a pattern, what no symbol holds (or None), and whether
    every symbol holds a character beyond ASCII, so that an ASCII text has none."""

    pattern: str
    plain_run: str | None = None
    beyond_ascii: bool = False

    @property
    def whole(self) -> str:
        return "^" + self.pattern + "$"


#: All sequences that the grammar allows.
GRAMMAR = Symbols(SYMBOL_PATTERN, PLAIN_RUN, True)


def _code(ch: str) -> str:
    return r"\x{%X}" % ord(ch)


def _class(chars: list[str]) -> str:
    """A character class; neighbours become ranges."""
    parts: list[list[int]] = []
    for code in sorted(map(ord, chars)):
        if parts and parts[-1][1] + 1 == code:
            parts[-1][1] = code
        else:
            parts.append([code, code])
    return "[" + "".join(_code(chr(a)) + ("" if a == b else "-" + _code(chr(b))) for a, b in parts) + "]"


def closed_list(symbols: Iterable[str]) -> Symbols:
    """Exactly the given sequences, the longest at the leftmost place.

    They become a code-point trie, and the trie a pattern: at every node the
    characters with equal rests share one class, so no character is tried twice,
    and a rest is tried before a shorter symbol that ends at its node.
    """
    root: dict = {}
    for symbol in symbols:
        node = root
        for ch in symbol or "":
            node = node.setdefault(ch, {})
        if symbol:
            node[""] = {}

    def pattern(node: dict) -> str:
        rests: dict[str, list[str]] = {}
        for ch, child in node.items():
            if ch:
                rests.setdefault(pattern(child), []).append(ch)
        own = "|".join(_class(chars) + rest for rest, chars in rests.items())
        if not own:
            return ""
        return f"(?:{own})" + ("?" if "" in node else "")

    used = set()
    todo = [root]
    while todo:
        node = todo.pop()
        used.update(ch for ch in node if ch)
        todo.extend(node.values())
    plain = f"[^{_class(list(used))[1:-1]}]+" if used and " " not in used else None
    return Symbols(pattern(root) or NOTHING, plain)


#: Matches no text at all.
NOTHING = r"(?:[^\x{0}-\x{10FFFF}])"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _short(text, symbols: Symbols) -> Column:
    return F.regexp_replace(_col(text), symbols.plain_run, " ") if symbols.plain_run else _col(text)


def extract_symbols(text, symbols: Symbols = GRAMMAR) -> Column:
    """Every symbol, left to right, longest sequence, repeats kept."""
    found = F.regexp_extract_all(_short(text, symbols), F.lit(symbols.pattern), 0)
    if not symbols.beyond_ascii:
        return found
    ascii_only = F.octet_length(_col(text)) == F.length(_col(text))
    return F.when(ascii_only, F.array().cast("array<string>")).otherwise(found)


def symbol_count(text, symbols: Symbols = GRAMMAR) -> Column:
    """Number of symbols including repeats (0 for empty text)."""
    return F.size(extract_symbols(text, symbols))


def distinct_symbols(text, symbols: Symbols = GRAMMAR) -> Column:
    """The distinct symbols of a text, sorted (the reference's order is a set's)."""
    return F.array_sort(F.array_distinct(extract_symbols(text, symbols)))


def is_symbol(text, symbols: Symbols = GRAMMAR) -> Column:
    """The whole value is exactly one symbol."""
    return _col(text).rlike(symbols.whole)


def has_symbol(text, symbols: Symbols = GRAMMAR) -> Column:
    """At least one symbol occurs."""
    return _short(text, symbols).rlike(symbols.pattern)
