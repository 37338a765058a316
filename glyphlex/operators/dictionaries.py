"""Dictionaries as tables.

A dictionary is a DataFrame ``(key string, value string, rank long)``; ``rank``
is the insertion order that the reference keeps in its ordered JSON objects.
Merges and rankings are aggregations and dense indexes, never driver loops.

Inside a chain of merges ``rank`` may instead be an order key: an array of numbers
(priority, then the ranks of the steps before), compared from the left.  A step with
``ranked=False`` returns one, and the last step numbers the keys once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..functions.symbols import GRAMMAR, Symbols, extract_symbols, is_symbol
from ..functions.text import CJK_FIRST, CJK_OR_ALNUM_FIRST, placeholder_digit, strip_and_wrap
from .ranking import dense_index

DICT_SCHEMA = "key string, value string, rank long"

# --- fixed values: dictionaries stated in the reference ----------------------
# symbols whose meaning overrides every other source (training dictionary)
CUSTOM_SYMBOLS = {"🐻‍❄️": "北极", "🤵‍♂️": "帅哥", "👰‍♀️": "婚纱", "🤵‍♀️": "男"}
# punctuation-like symbols for the out-of-vocabulary dictionary
SPECIAL_SYMBOLS = {"‼": "吃惊", "⁉": "吃惊", "❓": "疑惑", "❔": "疑惑", "❕": "吃惊",
                   "❗": "吃惊"}
# the fixed phrase rewrite applied after reconciling
PHRASE_REWRITE = ("人工驾驶", "跑步")
# ---------------------------------------------------------------------------


def from_mapping(spark: SparkSession, mapping: Mapping[str, str]) -> DataFrame:
    """An inline dictionary; ranks follow the mapping's order."""
    rows = [(k, v, i) for i, (k, v) in enumerate(mapping.items())]
    return spark.createDataFrame(rows, DICT_SCHEMA)


def normalize(df: DataFrame, key: str = "key", value: str = "value",
              rank: str = "rank") -> DataFrame:
    """Project any (key, value, rank) table onto the dictionary schema; drop empty keys.
    An order key stays one."""
    kind = "array<long>" if isinstance(df.schema[rank].dataType, ArrayType) else "long"
    return (df.select(F.col(key).cast("string").alias("key"),
                      F.col(value).cast("string").alias("value"),
                      F.col(rank).cast(kind).alias("rank"))
            .where(F.col("key").isNotNull() & (F.col("key") != "")))


def order_key(d: DataFrame, first: Column) -> Column:
    """The order key of ``first``, then the dictionary's rank or order key."""
    rank = F.col("rank")
    rest = rank if isinstance(d.schema["rank"].dataType, ArrayType) else F.array(rank)
    return F.concat(F.array(first.cast("long")), rest)


def merge(dicts: Sequence[DataFrame], policy: str = "last",
          by_length: bool = False, ranked: bool = True) -> DataFrame:
    """precedence merge of ordered dictionaries.

    ``last``: later dictionaries override the value (``dict.update``); a key keeps
    the position of its first insertion.  ``first``: insert-if-absent.
    ``by_length`` fuses the I2 re-rank (stable sort by key length, descending).
    Without ``ranked`` the rank is an order key, and nothing is sorted.
    """
    if policy not in ("last", "first"):
        raise ValueError("policy must be 'last' or 'first'")
    tagged = None
    for prio, d in enumerate(dicts):
        t = normalize(d)
        t = t.withColumn("pos", order_key(t, F.lit(prio))).drop("rank")
        tagged = t if tagged is None else tagged.unionByName(t)
    pick = F.max_by if policy == "last" else F.min_by
    # a dictionary never holds a key twice; if an input does, the later rank wins
    merged = tagged.groupBy("key").agg(
        pick(F.col("value"), F.col("pos")).alias("value"),
        F.min("pos").alias("pos"))
    if not ranked:
        length = F.array(-F.length("key").cast("long"))
        return merged.select("key", "value", (F.concat(length, "pos") if by_length else F.col("pos"))
                             .alias("rank"))
    order = [F.desc(F.length("key")), F.col("pos")] if by_length else [F.col("pos")]
    return dense_index(merged, order, "rank").select("key", "value", "rank")


def rank_by_key_length(d: DataFrame) -> DataFrame:
    """Stable sort by key length (code points) descending."""
    out = dense_index(d, [F.desc(F.length("key")), F.col("rank")], "r2")
    return out.select("key", "value", F.col("r2").alias("rank"))


def symbol_keys(d: DataFrame, symbols: Symbols = GRAMMAR) -> DataFrame:
    """Keys that are exactly one symbol, in rank order (key, rank)."""
    return d.where(is_symbol("key", symbols)).select("key", "rank")


def refine(common: DataFrame, labels: DataFrame | None = None,
           symbols: Symbols = GRAMMAR) -> DataFrame:
    """P5: D5 + D6 + F7 back-fill, then I2.

    D5 drops one-character keys without a symbol that are CJK or ASCII alnum;
    D6 drops keys starting with a CJK character whose remainder is itself a key;
    F7 adds, for keys with more than one distinct symbol and a value of more than
    two space-separated words, each of their characters found in ``labels`` and
    absent from the map (in order of appearance).
    """
    base = normalize(common)
    d5 = ((F.length("key") == 1) & F.col("key").rlike(CJK_OR_ALNUM_FIRST)
          & (F.size(extract_symbols("key", symbols)) == 0))
    step = base.where(~d5)
    rest = base.select(F.col("key").alias("rest_key"))
    cand = step.withColumn("rest", F.substring("key", 2, 1 << 30))
    step = (cand.join(rest, (F.col("rest") == F.col("rest_key")) & F.col("key").rlike(CJK_FIRST),
                      "left_anti")
            .select("key", "value", "rank"))
    if labels is None:
        return rank_by_key_length(step.select("key", "value", "rank"))
    long_keys = step.where((F.size(F.array_distinct(extract_symbols("key", symbols))) > 1)
                           & (F.size(F.split("value", " ", -1)) > 2))
    chars = long_keys.select(F.col("rank").alias("src_rank"),
                             F.posexplode(F.split("key", "")).alias("cpos", "ch"))
    lab = normalize(labels).select(F.col("key").alias("ch"), F.col("value").alias("lvalue"))
    fill = (chars.join(lab, "ch", "inner")
            .join(step.select(F.col("key").alias("ch")), "ch", "left_anti")
            .groupBy("ch").agg(F.first("lvalue").alias("value"),
                               F.min(F.struct("src_rank", "cpos")).alias("pos")))
    fill = fill.select(F.col("ch").alias("key"), "value",
                       F.struct(F.lit(1).alias("grp"), F.col("pos.src_rank").alias("a"),
                                F.col("pos.cpos").cast("long").alias("b")).alias("o"))
    kept = step.select("key", "value", F.struct(F.lit(0).alias("grp"), F.col("rank").alias("a"),
                                                F.lit(0).cast("long").alias("b")).alias("o"))
    both = kept.unionByName(fill)
    return dense_index(both, [F.desc(F.length("key")), F.col("o")], "rank").select(
        "key", "value", "rank")


def build_oov(labels: DataFrame, specials: DataFrame) -> DataFrame:
    """Labels, then specials override (F5 last-wins), E23 digits, then I2."""
    merged = merge([labels, specials], policy="last", by_length=True)
    return merged.withColumn("value", placeholder_digit("value"))


def build_dictionary(library: DataFrame | None, speech_labels: DataFrame | None,
                     mined_unique: DataFrame | None, custom: DataFrame | None,
                     bos: str = "", eos: str = "") -> DataFrame:
    """Library < speech labels < mined unique < custom (F5, last wins).

    Library values lose their first and last character and get the BOS/EOS
    markers (C4).
    """
    parts = []
    if library is not None:
        parts.append(normalize(library).withColumn("value", strip_and_wrap("value", bos, eos)))
    for d in (speech_labels, mined_unique, custom):
        if d is not None:
            parts.append(d)
    return merge(parts, policy="last")


def predict_dictionary(lexicon: DataFrame, oov: DataFrame) -> DataFrame:
    """P9 dictionary: lexicon, oov inserted if absent, then I2."""
    return merge([lexicon, oov], policy="first", by_length=True)

