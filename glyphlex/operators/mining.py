"""Lexicon mining from paired sentences.

Pairs come from the Arrow diff stage; everything after it is aggregation:

* G4  ``groupBy(key, text)`` with ``count`` and ``min(struct(row_id, seq))``
  (partial aggregation, so a hot key is combined map-side);
* H2  top text per key as ``min(struct(-cnt, first, text))`` (one more
  partial aggregation, no window);
* H3/G6 the first three texts per key through ``row_number() <= 3``, which
  Spark turns into a map-side group limit before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ..functions.symbols import GRAMMAR, Symbols, is_symbol
from ..functions.text import remove_spaces
from ..session import materialize
from .diff import mine_pairs
from .ranking import dense_index


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(key, text, cnt, first) with first = min(struct(r=row_id, s=seq))."""
    return pairs.groupBy("key", "text").agg(
        F.sum("weight").alias("cnt"),
        F.min(F.struct(F.col("row_id").alias("r"), F.col("seq").alias("s"))).alias("first"))


def mined_pairs(df: DataFrame, source: str = "source_text", target: str = "target_text",
                row_id: str = "row_id", clean_keys: bool = True,
                strict: bool = False) -> DataFrame:
    """E16 (+E17 when ``clean_keys``): (row_id, seq, key, text)."""
    pairs = mine_pairs(df, source, target, row_id, strict)
    if clean_keys:
        pairs = pairs.withColumn("key", remove_spaces("key")).where(F.col("key") != "")
    return pairs


def texts_per_key(pairs: DataFrame) -> DataFrame:
    """The set of distinct texts of every key, as (key, text) rows (a set
    per key without collecting any key's texts into one row)."""
    return pairs.select("key", "text").distinct()


def key_summary(counts: DataFrame) -> DataFrame:
    """Per key: top text (H2), its count, first-seen position, number of texts and of pairs."""
    best = F.min(F.struct((-F.col("cnt")).alias("neg"), F.col("first").alias("f"),
                          F.col("text").alias("t")))
    return (counts.groupBy("key")
            .agg(best.alias("top"), F.min("first").alias("key_first"),
                 F.count(F.lit(1)).alias("n_texts"), F.sum("cnt").alias("n_pairs"))
            .select("key", F.col("top.t").alias("value"), (-F.col("top.neg")).alias("cnt"),
                    "key_first", "n_texts", "n_pairs"))


def rank_by_length(df: DataFrame, order_col: str, key: str = "key",
                   out: str = "rank", ranked: bool = True) -> DataFrame:
    """rank = order by key length (code points) descending, then ``order_col``;
    without ``ranked`` an order key (then ``order_col`` is a first place (r, s))."""
    if not ranked:
        return df.withColumn(out, _places(order_col, -F.length(key)))
    return dense_index(df, [F.desc(F.length(key)), F.col(order_col)], out)


def _places(first: str, *before):
    """An order key: some numbers, then a first place (r, s)."""
    return F.array(*[c.cast("long") for c in (*before, F.col(f"{first}.r"), F.col(f"{first}.s"))])


def common_map(counts: DataFrame, min_support: int = 2, ranked: bool = True,
               observation: Observation | None = None) -> DataFrame:
    """H2 + D4 + I2: (key, value, cnt, key_first, rank) for keys whose top text
    has count >= ``min_support``; rank by key length desc, then first seen.  With
    ``observation``: G11's ``n_mined``, ``n_pairs``, ``n_kept`` from the same pass."""
    keys = key_summary(counts)
    if observation is not None:
        keys = keys.observe(observation, F.count(F.lit(1)).alias("n_mined"),
                            F.coalesce(F.sum("n_pairs"), F.lit(0)).alias("n_pairs"),
                            F.count_if(F.col("cnt") >= min_support).alias("n_kept"))
    kept = keys.where(F.col("cnt") >= min_support).drop("n_pairs")
    return rank_by_length(kept, "key_first", ranked=ranked)


def first_texts(counts: DataFrame, k: int = 3) -> DataFrame:
    """H3: the first ``k`` texts of each key in first-seen order (text_pos 0..k-1)."""
    w = Window.partitionBy("key").orderBy("first")
    return (counts.withColumn("text_pos", F.row_number().over(w) - 1)
            .where(F.col("text_pos") < k))


def ambiguous_map(counts: DataFrame, k: int = 3, min_count: int = 2) -> DataFrame:
    """Keys with more than one distinct text; of their first ``k`` texts in
    first-seen order keep those with count > ``min_count``.

    Returns (key, text, cnt, text_rank) with text_rank the position in the kept list.
    """
    top = first_texts(counts, k)
    wk = Window.partitionBy("key")
    multi = top.withColumn("n_first", F.count(F.lit(1)).over(wk)).where(F.col("n_first") > 1)
    kept = multi.where(F.col("cnt") > min_count)
    wr = Window.partitionBy("key").orderBy("text_pos")
    return kept.select("key", "text", "cnt",
                       (F.row_number().over(wr) - 1).cast("long").alias("text_rank"))


def mine_lexicon(df: DataFrame, source: str = "source_text", target: str = "target_text",
                 row_id: str = "row_id", min_support: int = 2,
                 persist: bool = True, ranked: bool = True, report: bool = False
                 ) -> dict[str, DataFrame]:
    """{'pairs', 'counts', 'common', 'ambiguous'} from raw (unnormalised) pairs.

    With ``persist`` the pair counts (the output of the Python diff, already
    aggregated) and the common map are written once to the shared checkpoint
    folder, so later jobs and range-partition sampling never re-run the diff.
    Without ``ranked`` the common map's rank is an order key.  With ``report`` the
    ambiguous map is written too, and 'summary' has G11 as observed while the maps
    were written.
    """
    if report and not persist:
        raise ValueError("the report is observed while the maps are written")
    seen, amb_seen = (Observation(), Observation()) if report else (None, None)
    pairs = mined_pairs(df, source, target, row_id, clean_keys=True)
    counts = pair_counts(pairs)
    if persist:
        counts = materialize(counts, "pair-counts")
    common = common_map(counts, min_support, ranked, seen)
    if persist:
        common = materialize(common, "common-map")
    out = {"pairs": pairs, "counts": counts, "common": common, "ambiguous": ambiguous_map(counts)}
    if report:
        out["ambiguous"] = materialize(out["ambiguous"].observe(
            amb_seen, F.count_if(F.col("text_rank") == 0).alias("n_ambiguous")), "ambiguous-map")
        values = {**seen.get, **amb_seen.get}
        out["summary"] = df.sparkSession.createDataFrame(
            list(values.items()), "metric string, value long")
    return out


def mine_unique(df: DataFrame, source: str = "source_text", target: str = "target_text",
                row_id: str = "row_id", persist: bool = True,
                symbols: Symbols = GRAMMAR, ranked: bool = True) -> DataFrame:
    """P3 (+G5, D7): keys mined from normalised pairs without key clean-up; a key
    is kept when it is exactly one symbol with exactly one distinct text.

    Returns (key, value, n_texts, is_symbol, unique, rank) for every mined key,
    rank = first-seen order of the key (without ``ranked`` its order key).
    """
    pairs = mined_pairs(df, source, target, row_id, clean_keys=False)
    per_key = (pairs.groupBy("key")
               .agg(F.min(F.struct(F.col("row_id").alias("r"), F.col("seq").alias("s")))
                    .alias("key_first"),
                    F.countDistinct("text").alias("n_texts"),
                    F.min("text").alias("value")))
    if persist:
        per_key = materialize(per_key, "unique-keys")
    flagged = per_key.select("key", "value", "n_texts", "key_first",
                             is_symbol("key", symbols).alias("is_symbol"))
    flagged = flagged.withColumn("unique", F.col("is_symbol") & (F.col("n_texts") == 1))
    if not ranked:
        return flagged.withColumn("rank", _places("key_first")).drop("key_first")
    return dense_index(flagged, ["key_first"], "rank").drop("key_first")


def unique_dictionary(mined: DataFrame) -> DataFrame:
    """The D7 survivors of ``mine_unique`` as a dictionary (key, value, rank)."""
    kept = mined.where("unique")
    if isinstance(mined.schema["rank"].dataType, ArrayType):
        return kept.select("key", "value", "rank")
    return dense_index(kept, ["rank"], "r2").select("key", "value", F.col("r2").alias("rank"))


def mining_summary(counts: DataFrame, common: DataFrame, ambiguous: DataFrame) -> DataFrame:
    """(metric, value) rows: keys mined, pairs mined, keys kept, keys ambiguous."""
    def one(df: DataFrame, name: str, agg) -> DataFrame:
        return df.agg(F.coalesce(agg, F.lit(0)).cast("long").alias("value")).select(
            F.lit(name).alias("metric"), "value")
    return (one(counts, "n_mined", F.countDistinct("key"))
            .unionByName(one(counts, "n_pairs", F.sum("cnt")))
            .unionByName(one(common, "n_kept", F.count(F.lit(1))))
            .unionByName(one(ambiguous, "n_ambiguous", F.countDistinct("key"))))
