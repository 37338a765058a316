"""Label dictionaries from symbol annotations (D8, P6 and the rules-B variant).

Input: annotation tables from ``sources.io.read_annotations`` (file, doc_pos,
cp, type, text), several of them in precedence order (base, then derived).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import alias_list, first_usable_alias, speech_label
from ..functions.symbols import GRAMMAR, Symbols, is_symbol
from ..sources.io import slice_annotations
from .dictionaries import merge
from .ranking import dense_index


def _ranked(df: DataFrame) -> DataFrame:
    return dense_index(df, ["file", "doc_pos"], "rank")


def speech_labels(annotations: DataFrame, symbols: Symbols = GRAMMAR) -> DataFrame:
    """D8 + E18: (key, value, rank) from ``type="tts"`` rows of known symbols."""
    tts = annotations.where(is_symbol("cp", symbols) & (F.col("type") == "tts"))
    cleaned = tts.select("file", "doc_pos", F.col("cp").alias("key"),
                         speech_label("text").alias("value"))
    return _ranked(cleaned.where(F.length("value") > 0)).select("key", "value", "rank")


def alias_lists(annotations: DataFrame, symbols: Symbols = GRAMMAR) -> DataFrame:
    """D8 + E20: (key, texts, rank) from the non-tts rows of known symbols."""
    plain = annotations.where(is_symbol("cp", symbols) & (F.col("type").isNull()
                                                          | (F.col("type") != "tts")))
    cleaned = plain.select("file", "doc_pos", F.col("cp").alias("key"),
                           alias_list("text").alias("texts"))
    return _ranked(cleaned.where(F.size("texts") > 0)).select("key", "texts", "rank")


def build_labels(annotation_sets: Sequence[DataFrame],
                 symbols: Symbols = GRAMMAR) -> dict[str, DataFrame]:
    """Speech labels and alias lists; later sets override earlier ones."""
    tts = merge([speech_labels(a, symbols) for a in annotation_sets], policy="last")
    alias_parts = None
    for prio, a in enumerate(annotation_sets):
        part = alias_lists(a, symbols).withColumn("prio", F.lit(prio))
        alias_parts = part if alias_parts is None else alias_parts.unionByName(part)
    order = F.struct("prio", "rank")
    aliases = alias_parts.groupBy("key").agg(F.max_by("texts", order).alias("texts"),
                                             F.min(order).alias("pos"))
    aliases = dense_index(aliases, ["pos"], "rank").select("key", "texts", "rank")
    return {"speech": tts, "aliases": aliases}


def first_alias_labels(annotations: DataFrame, lo: int | None = None,
                       hi: int | None = None, trim: bool = False) -> DataFrame:
    """Rules-B label map: optional positional slice (A4), first usable alias per
    annotation (E19), later annotations of the same symbol win (F5)."""
    rows = _ranked(annotations if lo is None and hi is None else
                   slice_annotations(annotations, lo, hi))
    picked = rows.select(F.col("cp").alias("key"), first_usable_alias("text", trim).alias("value"),
                         "rank").where(F.col("value").isNotNull())
    return merge([picked], policy="last")
