"""Symbol statistics (G1, G2, G3, G13, H1, I1, P2) and character vocabularies (K4).

All counts are plain ``groupBy`` aggregations (partial aggregation absorbs hot
symbols before the shuffle); first-seen ranks are ``min(struct(row, seq))``
carried through the aggregation, then a distributed dense index.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.symbols import GRAMMAR, Symbols, closed_list, extract_symbols
from ..functions.text import chars
from .ranking import dense_index


#: UTF-8 bytes of a closed symbol list, at most (published lists have under 100 kB).
LIST_BYTES = 1 << 20


def symbol_list(table: DataFrame, column: str = "symbol") -> Symbols:
    """The closed list of the distinct values of ``column`` (null and empty ones
    left out), for the ``symbols`` parameter of all symbol operators.  The list goes
    into every plan as one pattern, so its bytes are checked first."""
    own = table.select(F.col(column).alias("symbol")).where("symbol <> ''").distinct()
    size = own.agg(F.coalesce(F.sum(F.octet_length("symbol")), F.lit(0))).first()[0]
    if size > LIST_BYTES:
        raise ValueError(f"a symbol list of {size} bytes; at most {LIST_BYTES}")
    return closed_list(r.symbol for r in own.collect())


def symbol_occurrences(df: DataFrame, text_col: str, row_id: str = "row_id",
                       symbols: Symbols = GRAMMAR) -> DataFrame:
    """(row_id, seq, symbol): one row per detected symbol, in text order."""
    return df.select(row_id, F.posexplode(extract_symbols(text_col, symbols)).alias("seq", "symbol"))


def known_symbols(occurrences: DataFrame, symbol_table: DataFrame,
                  column: str = "symbol") -> DataFrame:
    """Narrow grammar matches to a closed symbol list (``symbol_table`` has a
    ``symbol`` column) with a left-semi equi-join; Spark broadcasts the list
    when its statistics allow, otherwise it shuffles both sides."""
    table = symbol_table.select(F.col("symbol").alias(column)).distinct()
    return occurrences.join(table, column, "left_semi")


def symbol_frequency(df: DataFrame, text_col: str,
                     symbol_table: DataFrame | None = None,
                     symbols: Symbols = GRAMMAR) -> DataFrame:
    """G1: (symbol, cnt) with repeats counted; optionally only listed symbols."""
    occ = df.select(F.explode(extract_symbols(text_col, symbols)).alias("symbol"))
    if symbol_table is not None:
        occ = known_symbols(occ, symbol_table)
    return occ.groupBy("symbol").agg(F.count(F.lit(1)).alias("cnt"))


def symbol_totals(df: DataFrame, text_col: str, symbols: Symbols = GRAMMAR) -> DataFrame:
    """One row (total, n_distinct): symbol occurrences and distinct symbols."""
    occ = df.select(extract_symbols(text_col, symbols).alias("syms"))
    per = occ.select(F.size("syms").alias("n"), F.explode_outer("syms").alias("symbol"))
    return per.agg(F.count("symbol").alias("total"),
                   F.countDistinct("symbol").alias("n_distinct"))


def symbol_vocab(df: DataFrame, text_col: str, row_id: str = "row_id",
                 symbols: Symbols = GRAMMAR) -> DataFrame:
    """(symbol, cnt, vocab_id, count_rank).

    vocab_id: 0,1,2... in first-seen order (G3/H1); count_rank: order by count
    descending, ties by first appearance (I1).
    """
    occ = symbol_occurrences(df, text_col, row_id, symbols)
    agg = occ.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.min(F.struct(F.col(row_id).alias("r"), F.col("seq").alias("s"))).alias("first"))
    with_id = dense_index(agg, ["first"], "vocab_id")
    ranked = dense_index(with_id, [F.desc("cnt"), F.col("first")], "count_rank")
    return ranked.select("symbol", "cnt", "vocab_id", "count_rank")


def row_distinct_symbols(df: DataFrame, text_col: str, keep: Sequence[str] = (),
                         symbols: Symbols = GRAMMAR) -> DataFrame:
    """Distinct symbols per row (explode + distinct inside the row only)."""
    return df.select(*keep, F.explode(F.array_distinct(extract_symbols(text_col, symbols))).alias("symbol"))


def char_vocab(df: DataFrame, text_cols: Sequence[str], row_id: str = "row_id",
               specials: Sequence[str] = ("[PAD]", "[UNK]", "[CLS]", "[SEP]")) -> DataFrame:
    """K4: (token, token_id): specials first, then characters in first-seen order."""
    parts = None
    for i, c in enumerate(text_cols):
        part = df.select(F.col(row_id).alias("r"), F.lit(i).alias("c"),
                         F.posexplode(chars(c)).alias("p", "token"))
        parts = part if parts is None else parts.unionByName(part)
    agg = parts.groupBy("token").agg(F.min(F.struct("r", "c", "p")).alias("first"))
    agg = agg.where(~F.col("token").isin(*specials)) if specials else agg
    idx = dense_index(agg, ["first"], "idx")
    vocab = idx.select("token", (F.col("idx") + len(specials)).alias("token_id"))
    spark = df.sparkSession
    special_df = spark.createDataFrame([(s, i) for i, s in enumerate(specials)],
                                       "token string, token_id long")
    return special_df.unionByName(vocab)
