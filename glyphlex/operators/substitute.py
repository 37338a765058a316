"""Dictionary rewrites over DataFrames with a size-checked physical path
(E8, E10, E11, E12, E13, F4, F8, F9, P9).

E10 (ordered, cascading fold) has three exact paths, chosen from the
dictionary's measured size:

* ``native``  <= ``NATIVE_MAX_KEYS`` entries: Catalyst ``aggregate`` over an
  inline array literal; no Python;
* ``arrow``   <= ``BROADCAST_MAX_BYTES``: a pandas UDF holding the dictionary
  in a broadcast variable and an Aho-Corasick automaton per worker.  For each
  text it repeatedly applies the lowest-ranked key that occurs after the last
  applied rank, which equals the full fold (keys that do not occur are no-ops);
* ``chunked`` beyond that: the rank order is cut into broadcast-sized chunks,
  applied one after another with a reliable checkpoint in between (the fold is
  sequential in rank, so chunking is exact).

E8 (detected-symbol substitution) uses an inline map for small dictionaries;
otherwise the different symbols of each block of rows are joined with the
dictionary once, and the block's rows get them back as one map.

E12 (contains any key) uses an inline test, the automaton, or, for key sets beyond a
broadcast, rarest-run signatures; all three look for keys as plain substrings.
"""

from __future__ import annotations

import json
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import substitute as fs
from ..functions.symbols import GRAMMAR, Symbols, extract_symbols
from ..functions.text import chars
from ..session import materialize
from .fold import Dictionary, fold_text

#: Code points of a signature at most (shorter ones are shared by a share of all texts and
#: of all keys, which meet in the square of their number), bits of the table of signatures, parts of the join that
#: the rows of one signature are dealt to, and blocks of rows a shuffle partition.
GRAM, BITS, SALTS, BLOCKS = 8, 20, 16, 16
NATIVE_MAX_KEYS = 256
BROADCAST_MAX_BYTES = 64 << 20
COLLECT_MAX_ROWS = 2_000_000

_DICTIONARIES: dict[str, Dictionary] = {}


def dictionary_size(d: DataFrame) -> tuple[int, int]:
    """(entries, utf-8 bytes of keys and values) — one small aggregation."""
    row = d.agg(F.count(F.lit(1)).alias("n"),
                F.coalesce(F.sum(F.octet_length("key") + F.coalesce(F.octet_length("value"),
                                                                    F.lit(0))),
                           F.lit(0)).alias("b")).first()
    return int(row["n"]), int(row["b"])


def bounded_entries(d: DataFrame, max_rows: int) -> list[tuple[str, str]] | None:
    """Entries in rank order, or None when the dictionary has more than ``max_rows``.

    One job: the driver never receives more than ``max_rows + 1`` rows.
    """
    rows = d.orderBy("rank").select("key", "value").limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return None
    return [(r["key"], r["value"] if r["value"] is not None else "") for r in rows]


def collect_entries(d: DataFrame, max_rows: int = COLLECT_MAX_ROWS) -> list[tuple[str, str]]:
    """Entries in rank order; refuses dictionaries above ``max_rows``."""
    got = bounded_entries(d, max_rows)
    if got is None:
        raise ValueError(f"dictionary exceeds the collect bound of {max_rows} entries")
    return got


def choose_path(d: DataFrame) -> str:
    n, b = dictionary_size(d)
    if n <= NATIVE_MAX_KEYS:
        return "native"
    if b <= BROADCAST_MAX_BYTES and n <= COLLECT_MAX_ROWS:
        return "arrow"
    return "chunked"


# ---------------------------------------------------------------------------
# Arrow fold
# ---------------------------------------------------------------------------

def _arrow_fold_column(text: Column, entries: list[tuple[str, str]], spark,
                       any_only: bool = False) -> Column:
    token = uuid.uuid4().hex
    bc = spark.sparkContext.broadcast(entries)
    rtype = "boolean" if any_only else "string"

    @F.pandas_udf(rtype)
    def fold(s: pd.Series) -> pd.Series:
        own = _DICTIONARIES.get(token)
        if own is None:
            if len(_DICTIONARIES) >= 4:
                _DICTIONARIES.pop(next(iter(_DICTIONARIES)))
            own = _DICTIONARIES[token] = Dictionary(bc.value)
        if any_only:
            return pd.Series([own.occurs(t) for t in s.tolist()], dtype="object")
        return pd.Series([fold_text(t, own) for t in s.tolist()], dtype="object")

    return fold(text)


# ---------------------------------------------------------------------------
# public operators
# ---------------------------------------------------------------------------

def apply_fold(df: DataFrame, text_col: str, dictionary: DataFrame, out_col: str,
               path: str = "auto", chunk_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``out_col`` = ``text_col`` with every dictionary key replaced in rank order."""
    spark = df.sparkSession
    if path in ("auto", "native"):
        small = bounded_entries(dictionary, NATIVE_MAX_KEYS)
        if small is not None:
            return df.withColumn(out_col, fs.fold_replace(text_col, small))
        if path == "native":
            raise ValueError(f"dictionary exceeds {NATIVE_MAX_KEYS} entries for the native path")
        dictionary = materialize(dictionary, "fold-dictionary")
        path = choose_path(dictionary)
    elif path == "arrow":
        dictionary = materialize(dictionary, "fold-dictionary")
        if choose_path(dictionary) == "chunked":
            path = "chunked"
    if path == "arrow":
        entries = collect_entries(dictionary)
        return df.withColumn(out_col, _arrow_fold_column(F.col(text_col), entries, spark))
    if path != "chunked":
        raise ValueError(f"unknown path {path}")
    # chunked: cut the dense rank order into pieces whose bytes stay below chunk_bytes
    from .ranking import dense_index
    ranked = dense_index(dictionary.select("key", "value", "rank"), ["rank"], "_gl_r")
    stats = ranked.agg(F.count(F.lit(1)).alias("n"), F.max(
        F.octet_length("key") + F.coalesce(F.octet_length("value"), F.lit(0))).alias("mb")).first()
    per_chunk = max(1, chunk_bytes // max(1, int(stats["mb"] or 1)))
    chunked = ranked.withColumn("chunk", (F.col("_gl_r") / F.lit(per_chunk)).cast("long"))
    n_chunks = (int(stats["n"]) + per_chunk - 1) // per_chunk
    out = df.withColumn(out_col, F.col(text_col))
    for c in range(n_chunks):
        part = chunked.where(F.col("chunk") == c).select("key", "value", "rank")
        entries = [(r["key"], r["value"] or "") for r in part.orderBy("rank").collect()]
        out = out.withColumn(out_col, _arrow_fold_column(F.col(out_col), entries, spark))
        out = out.checkpoint(eager=True)
    return out


def contains_any_key(df: DataFrame, text_col: str, keys: DataFrame, out_col: str,
                     row_id: str | None = None, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Boolean ``out_col``: the text contains at least one key, as a substring
    wherever it stands (also within a longer symbol); false for a null text.

    Small key sets: native ``exists``.  Otherwise the Arrow automaton, up to ``max_bytes``
    of keys; beyond that ``by_signatures``.  The three agree on every row, and ``row_id``
    (the rows' key, if they have one) may repeat or be null.
    """
    keyset = keys.select(F.col("key")).where(F.col("key").isNotNull() & (F.col("key") != ""))
    few = keyset.limit(NATIVE_MAX_KEYS + 1).collect()
    if len(few) <= NATIVE_MAX_KEYS:
        found = fs.contains_any(text_col, [r["key"] for r in few])
        return df.withColumn(out_col, F.coalesce(found, F.lit(False)))
    keyset = materialize(keyset.distinct(), "flag-keys")
    stats = keyset.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("key")).alias("bytes")).first()
    spark = df.sparkSession
    if stats["n"] <= COLLECT_MAX_ROWS and stats["bytes"] <= max_bytes:
        entries = [(k, "") for k, _v in collect_entries(
            keyset.withColumn("value", F.lit("")).withColumn("rank", F.lit(0)))]
        found = _arrow_fold_column(F.col(text_col), entries, spark, any_only=True)
        return df.withColumn(out_col, F.coalesce(found, F.lit(False)))
    return by_signatures(df, text_col, keyset, out_col, row_id)


def _text_grams(text: Column, size: int) -> Column:
    """The different runs of ``size`` code points of a text."""
    c = chars(text)
    runs = F.transform(F.sequence(F.lit(0), F.size(c) - size),
                       lambda i: F.concat(*[F.get(c, i + k) for k in range(size)]))
    return F.when(F.size(c) >= size, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def by_signatures(df: DataFrame, text_col: str, keyset: DataFrame, out_col: str,
                  row_id: str | None = None) -> DataFrame:
    """``contains_any_key`` for key sets of any size, by equi-joins.

    A key's signature is the one of its runs of GRAM code points that the fewest
    texts hold (of a shorter key: the key).  A text emits the runs that some
    signature has, it meets the keys of that signature, and each meeting is checked
    on the whole text.  A key with a run that no text holds is gone at once.  Rows are
    written once with an id of their own, as ``row_id`` may repeat or be null.

    Before the shuffle a bit table of bounded size keeps back runs that are no
    signature.  A frequent signature's rows are dealt to SALTS parts of the join.
    """
    rid = "_gl_rid"
    tagged = materialize(df.withColumn(rid, F.monotonically_increasing_id()), "flag-rows")
    met = meetings(tagged, rid, text_col, keyset)
    if met is None:
        return df.withColumn(out_col, F.lit(False))
    hits = (met.join(tagged.select(F.col(rid).alias("row"), F.col(text_col).alias("text")), "row")
            .where(F.col("key").isNull() | F.contains("text", "key")).select(F.col("row").alias(rid)).distinct()
            .withColumn(out_col, F.lit(True)))
    return (tagged.join(hits, rid, "left")
            .withColumn(out_col, F.coalesce(F.col(out_col), F.lit(False))).drop(rid))


def meetings(tagged: DataFrame, rid: str, text_col: str, keyset: DataFrame) -> DataFrame | None:
    """(row, key) of the texts and the keys whose signature they hold; key is null where
    the signature is the whole key.  None if there is no key."""
    keyset = keyset.select("key").distinct()
    sizes = sorted(r.n for r in keyset.select(F.least(F.length("key"), F.lit(GRAM)).alias("n")).distinct().collect())

    def emitted(wanted: DataFrame) -> DataFrame:
        """(row, run) of the texts, but for most runs that are not in ``wanted``."""
        slot = F.pmod(F.xxhash64("gram"), F.lit(1 << BITS))
        words = wanted.select(slot.alias("at")).groupBy((F.col("at") / 63).cast("int").alias("word")).agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"),
                                     F.pmod("at", F.lit(63)).cast("int"))).alias("bits")).collect()
        table = [0] * ((1 << BITS) // 63 + 1)
        for r in words:  # at most 2**BITS / 63 numbers
            table[r.word] = r.bits
        bits = F.from_json(F.lit(json.dumps(table)), "array<long>")
        # runs of each length there is, exploded together
        runs = F.concat(*[_text_grams(F.col(text_col), n) for n in sizes])
        rows = tagged.where(F.col(text_col).isNotNull()).select(F.col(rid).alias("row"), F.explode(runs).alias("gram"))
        word = F.get(bits, (slot / 63).cast("int"))
        kept = F.call_function("shiftright", word, F.pmod(slot, F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1
        return rows.where(kept)

    if not sizes:
        return None
    runs = F.when(F.length("key") <= GRAM, F.array("key")).otherwise(_text_grams(F.col("key"), GRAM))
    key_grams = materialize(keyset.select("key", F.explode(runs).alias("gram")), "key-runs")
    seen = emitted(key_grams).groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rarest = materialize(
        key_grams.join(seen, "gram", "left").groupBy("key")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.col("gram").alias("gram"))).alias("sig"))
        .where("sig.n > 0").select("key", F.col("sig.gram").alias("gram")), "signatures")
    salt = F.pmod(F.xxhash64("row"), F.lit(SALTS))
    texts = emitted(rarest).withColumn("salt", salt)
    salted = rarest.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    # a key that is its own signature is found; any number of them is one row
    return (texts.join(salted, ["gram", "salt"])
            .select("row", F.when(F.col("key") != F.col("gram"), F.col("key")).alias("key")).distinct())


def delete_keys(df: DataFrame, text_col: str, keys: DataFrame, out_col: str) -> DataFrame:
    """Delete each key in rank order (a fold with empty values)."""
    return apply_fold(df, text_col, keys.select("key", F.lit("").alias("value"), "rank"),
                      out_col)


def demojize(df: DataFrame, text_col: str, dictionary: DataFrame, out_col: str,
             row_id: str = "row_id", unknown: str = fs.UNKNOWN,
             path: str = "auto", symbols: Symbols = GRAMMAR) -> DataFrame:
    """Replace each detected symbol (in order) by its dictionary value or ``unknown``."""
    if path in ("auto", "native"):
        small = bounded_entries(dictionary, NATIVE_MAX_KEYS * 4)
        if small is not None:
            return df.withColumn(out_col, fs.demojize(text_col, dict(small), unknown, symbols))
        if path == "native":
            raise ValueError("dictionary too large for the native path")
    # rows are dealt to blocks by their id; the different symbols of a block look their
    # values up once, whatever a symbol's share of all rows, and come back as one map
    n_blocks = BLOCKS * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.withColumn("_gl_block", F.pmod(F.xxhash64(row_id), F.lit(n_blocks)))
    met = (dealt.select("_gl_block", F.explode(F.array_distinct(extract_symbols(text_col, symbols))).alias("key"))
           .distinct())
    maps = (met.join(dictionary.select("key", "value"), "key")
            .groupBy("_gl_block").agg(F.map_from_entries(
                F.collect_list(F.struct("key", F.coalesce("value", F.lit(unknown))))).alias("_gl_map")))
    joined = dealt.join(maps, "_gl_block", "left")
    return joined.withColumn(out_col, fs.demojize_from(text_col, F.col("_gl_map"), unknown, symbols)).drop(
        "_gl_block", "_gl_map")


def oov_symbols(df: DataFrame, text_col: str, dictionary: DataFrame,
                symbols: Symbols = GRAMMAR) -> DataFrame:
    """(symbol, cnt) of detected symbols missing from the dictionary."""
    occ = df.select(F.explode(extract_symbols(text_col, symbols)).alias("key"))
    return (occ.join(dictionary.select("key"), "key", "left_anti")
            .groupBy(F.col("key").alias("symbol")).agg(F.count(F.lit(1)).alias("cnt")))


def apply_unique_map(pairs: DataFrame, unique: DataFrame, source: str = "source_text",
                     target: str = "target_text") -> tuple[DataFrame, DataFrame]:
    """Rewrite the source with the unambiguous map (E10 in rank order), count
    the touched rows whose result still differs from the target, and keep only
    the rows that remain different (D1).

    Returns (kept rows with the rewritten source, one-row counters
    ``(n_touched, n_still_different)``)."""
    keys = unique.select("key")
    flagged = contains_any_key(pairs, source, keys, "_gl_touched", row_id="row_id")
    rewritten = apply_fold(flagged, source, unique, "_gl_new")
    rewritten = rewritten.withColumn(source, F.when(F.col("_gl_touched"), F.col("_gl_new"))
                                     .otherwise(F.col(source)))
    counters = rewritten.agg(
        F.count_if("_gl_touched").alias("n_touched"),
        F.count_if(F.col("_gl_touched") & (F.col(source) != F.col(target)))
        .alias("n_still_different"))
    kept = rewritten.where(F.col(source) != F.col(target)).drop("_gl_touched", "_gl_new")
    return kept, counters
