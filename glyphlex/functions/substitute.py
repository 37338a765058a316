"""Native substitution expressions (E8, E10, E12, E13) for dictionaries held inline.

These build Catalyst higher-order functions over a literal array/map, so they are
only used for dictionaries whose size was checked first (see
``operators.substitute``, which picks the path for a dictionary DataFrame).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .symbols import GRAMMAR, Symbols, extract_symbols

UNKNOWN = "[UNK]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def entries_literal(entries: Sequence[tuple[str, str]]) -> Column:
    """An ``array<struct<k,v>>`` literal in the given (rank) order."""
    if not entries:
        return F.array().cast("array<struct<k:string,v:string>>")
    return F.array(*[F.struct(F.lit(k).alias("k"), F.lit(v).alias("v"))
                     for k, v in entries])


def map_literal(mapping: Mapping[str, str]) -> Column:
    if not mapping:
        return F.create_map().cast("map<string,string>")
    args = []
    for k, v in mapping.items():
        args.extend([F.lit(k), F.lit(v)])
    return F.create_map(*args)


def fold_replace(text, entries: Sequence[tuple[str, str]]) -> Column:
    """Replace every key in rank order; earlier outputs feed later keys."""
    return F.aggregate(entries_literal(entries), _col(text).cast("string"),
                       lambda acc, x: F.replace(acc, x["k"], x["v"]))


def fold_replace_column(text, entries: Column) -> Column:
    """E10 over an ``array<struct<k,v>>`` column (already rank-ordered)."""
    return F.aggregate(entries, _col(text).cast("string"),
                       lambda acc, x: F.replace(acc, x["k"], x["v"]))


def demojize(text, mapping: Mapping[str, str], unknown: str = UNKNOWN,
             symbols: Symbols = GRAMMAR) -> Column:
    """For each detected symbol in order, replace all its occurrences.

    Missing symbols become ``unknown``.  Replacement is by substring, so a short
    symbol earlier in the list also hits inside a later, longer sequence.
    """
    return demojize_from(text, map_literal(mapping), unknown, symbols)


def demojize_from(text, values: Column, unknown: str = UNKNOWN, symbols: Symbols = GRAMMAR) -> Column:
    """E8 with a map column (null: an empty one)."""
    return F.aggregate(extract_symbols(text, symbols), _col(text).cast("string"),
                       lambda acc, e: F.replace(
                           acc, e, F.coalesce(F.element_at(values, e), F.lit(unknown))))


def demojize_with_symbols(text, mapping: Mapping[str, str],
                          unknown: str = UNKNOWN, symbols: Symbols = GRAMMAR) -> Column:
    """``struct(text, symbols)``."""
    return F.struct(demojize(text, mapping, unknown, symbols).alias("text"),
                    extract_symbols(text, symbols).alias("symbols"))


def contains_any(text, keys: Sequence[str]) -> Column:
    """The text contains at least one key (literal substring test)."""
    if not keys:
        return F.lit(False)
    t = _col(text)
    arr = F.array(*[F.lit(k) for k in keys])
    return F.exists(arr, lambda k: F.instr(t, k) > 0)


def delete_keys(text, keys: Sequence[str]) -> Column:
    """Delete each key in list order."""
    return fold_replace(text, [(k, "") for k in keys])
