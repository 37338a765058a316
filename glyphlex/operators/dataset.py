"""Training-table jobs.

All of it is narrow projection, filters and aggregations; the duplicate removal shuffles
digests and the texts that repeat.

``observation`` arguments take a ``pyspark.sql.Observation``: the job's counters, known
once its result has been written, without a pass of their own.  (Below a shuffle, a stage
that is run again after a lost executor may be counted again; above it, it is not.)
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.symbols import GRAMMAR, Symbols, symbol_count
from ..functions.text import add_prefix, chars, normalize_text, remove_spaces
from .equal_rows import computed_once, group_equal

PAD_ID, UNK_ID, CLS_ID, SEP_ID = 0, 1, 2, 3
LABEL_PAD = -100
#: Rows of the split's border bucket that the driver sorts.
BUCKET = 10_000
#: First private code point that stands for a token id, how many there are, and a code
#: point that is no character.
PRIVATE, PRIVATE_MAX, NO_CHARACTER = 0xF0000, 60_000, "\uffff"


def prepare_pairs(raw: DataFrame, prefix: str = "", do_filter: bool = True,
                  full2half: bool = True, row_id: str = "row_id",
                  symbols: Symbols = GRAMMAR, observation: Observation | None = None) -> DataFrame:
    """(row_id, source_text, target_text) ready for mining and training.

    prefix the source (C3), normalise both sides (E3), remove spaces from the
    target only (E4), then keep changed pairs (D1) whose source has a symbol (D2).
    Null texts are dropped at the door.  With ``observation`` G10's counts come from
    the same pass.
    """
    base = raw.select(F.col(row_id).alias("row_id"), "source_text", "target_text")
    nonnull = F.col("source_text").isNotNull() & F.col("target_text").isNotNull()
    if observation is None:
        base = base.where(nonnull)
    out = base.select(
        "row_id",
        normalize_text(add_prefix(F.col("source_text"), prefix), full2half).alias("source_text"),
        remove_spaces(normalize_text(F.col("target_text"), full2half)).alias("target_text"))
    changed = F.col("source_text") != F.col("target_text")
    kept = changed & (symbol_count("source_text", symbols) > 0)
    if observation is not None:  # normalised text is null where the text is
        out = out.withColumn("_gl_kept", kept).observe(
            observation, F.count(F.lit(1)).alias("n_raw"), F.count_if(nonnull).alias("n_nonnull"),
            F.count_if(changed).alias("n_changed"), F.count_if("_gl_kept").alias("n_kept"))
        out = out.where("_gl_kept" if do_filter else nonnull).drop("_gl_kept")
    elif do_filter:
        out = computed_once(out).where(kept)
    return out


def funnel(raw: DataFrame, prefix: str = "", full2half: bool = True,
           symbols: Symbols = GRAMMAR) -> DataFrame:
    """Row counts through P1's steps in one aggregation pass."""
    src = normalize_text(add_prefix(F.col("source_text"), prefix), full2half)
    tgt = remove_spaces(normalize_text(F.col("target_text"), full2half))
    nonnull = F.col("source_text").isNotNull() & F.col("target_text").isNotNull()
    changed = nonnull & (src != tgt)
    kept = changed & (symbol_count(src, symbols) > 0)
    return raw.agg(F.count(F.lit(1)).alias("n_raw"),
                   F.count_if(nonnull).alias("n_nonnull"),
                   F.count_if(changed).alias("n_changed"),
                   F.count_if(kept).alias("n_kept"))


def drop_duplicate_pairs(df: DataFrame, cols: Sequence[str] = ("source_text", "target_text"),
                         row_id: str = "row_id", observation: Observation | None = None) -> DataFrame:
    """O2: keep the first row (lowest ``row_id``) of every duplicate pair.  With
    ``observation``: ``n_rows`` before and ``n_pairs`` after."""
    out = group_equal(df, cols, row_id, n="_gl_n")
    if observation is not None:
        out = out.observe(observation, F.coalesce(F.sum("_gl_n"), F.lit(0)).alias("n_rows"),
                          F.count(F.lit(1)).alias("n_pairs"))
    return out.select(row_id, *cols)


def _split_mark(keyed: DataFrame, n_valid: int, row_id: str) -> tuple[str, int] | None:
    """The (key, row_id) of the last of the ``n_valid`` smallest rows.

    Rows are counted by key prefix, three more hex digits a pass, until the prefix that
    holds the mark has few rows; the driver sees at most 4,096 counts or BUCKET rows."""
    prefix, left = "", n_valid
    while True:
        inside = keyed.where(F.col("_gl_key").startswith(prefix)) if prefix else keyed
        counts = sorted((r.p, r.n) for r in inside.groupBy(
            F.substring("_gl_key", 1, len(prefix) + 3).alias("p"))
            .agg(F.count(F.lit(1)).alias("n")).collect())
        for prefix, n in counts:
            if n >= left:
                break
            left -= n
        if n <= BUCKET:
            rows = sorted(tuple(r) for r in keyed.where(F.col("_gl_key").startswith(prefix))
                          .select("_gl_key", row_id).collect())
            return rows[left - 1]
        if len(prefix) >= 30:
            raise ValueError(f"{row_id} does not tell the rows apart")


def train_valid_split(df: DataFrame, fraction: float = 0.1, seed: int = 42,
                      row_id: str = "row_id", train_on_all: bool = False) -> DataFrame:
    """Add ``split`` ('train'/'valid').

    Rows are ordered by ``md5(seed || row_id)``; the first ``ceil(fraction * n)``
    are validation (``row_id`` tells rows apart).  They are found by comparison with
    the last of them: no sort and no copy of the table.  With ``train_on_all``
    validation rows are also emitted as train (the reference's default trains on
    everything).
    """
    n = df.count()
    n_valid = math.ceil(fraction * n)  # the split library's rule, float product included
    key = F.md5(F.concat(F.lit(str(seed)), F.col(row_id).cast("string")))
    keyed = df.withColumn("_gl_key", key)
    if n_valid == 0:
        valid = F.lit(False)
    else:
        mark, mark_id = _split_mark(keyed.select("_gl_key", row_id), n_valid, row_id)
        valid = (F.col("_gl_key") < mark) | ((F.col("_gl_key") == mark) & (F.col(row_id) <= mark_id))
    labelled = keyed.withColumn("split", F.when(valid, "valid").otherwise("train")).drop("_gl_key")
    if train_on_all:
        extra = labelled.where(F.col("split") == "valid").withColumn("split", F.lit("train"))
        labelled = labelled.unionByName(extra)
    return labelled


def split_overlap(labelled: DataFrame, row_id: str = "row_id") -> DataFrame:
    """O4 report: rows present in both splits (non-zero only with ``train_on_all``)."""
    per = labelled.groupBy(row_id).agg(F.countDistinct("split").alias("n"))
    return per.agg(F.count_if(F.col("n") > 1).alias("n_overlap"),
                   F.count(F.lit(1)).alias("n_rows"))


def length_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column: count, mean, sample std, min, quartiles, 95 %, max of lengths,
    all columns in one aggregation."""
    def profile(c):
        n = F.length(c)
        return F.struct(
            F.lit(c).alias("column"), F.count(n).cast("long").alias("n"), F.avg(n).alias("mean"),
            F.stddev_samp(n).alias("std"), F.min(n).cast("double").alias("min"),
            F.percentile(n.cast("double"), [0.25, 0.5, 0.75, 0.95]).alias("q"),
            F.max(n).cast("double").alias("max"))
    return (df.agg(F.array(*[profile(c) for c in cols]).alias("a"))
            .select(F.explode("a").alias("p")).select("p.*")
            .select("column", "n", "mean", "std", "min",
                    *[F.col("q")[i].alias(q) for i, q in enumerate(("p25", "p50", "p75", "p95"))],
                    "max"))


def head(df: DataFrame, n: int = 5, row_id: str = "row_id", tail: bool = False) -> DataFrame:
    """I4: first (or last) ``n`` rows by ``row_id`` (top-k: a limit is the feature)."""
    order = F.desc(row_id) if tail else F.asc(row_id)
    return df.orderBy(order).limit(n)


def preview_sample(df: DataFrame, fraction: float = 0.1, seed: int = 0,
                   row_id: str = "row_id") -> DataFrame:
    """A preview of about ``fraction`` of the rows (a sampling operator), chosen by
    the digest of seed and row_id, so it does not depend on the partitioning."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(row_id).cast("string")))
    return df.where(F.substring(digest, 1, 8) < f"{min(int(fraction * 2**32), 2**32 - 1):08x}")


def rename(df: DataFrame, names: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """New column names, by name (a mapping) or by position (all of them)."""
    return df.withColumnsRenamed(dict(names)) if isinstance(names, Mapping) else df.toDF(*names)


def _character_ids(vocab: DataFrame):
    """text -> array of token ids, without a join: ``translate`` (a hash lookup) turns
    each known character into the private character of its id.  None if the vocabulary
    does not fit that."""
    known = (vocab.where(F.length("token") == 1).select("token", "token_id")
             .limit(PRIVATE_MAX + 1).collect())
    if len(known) > PRIVATE_MAX or any(
            ord(r.token) >= PRIVATE or r.token == NO_CHARACTER
            or not 0 <= r.token_id <= PRIVATE_MAX for r in known):
        return None
    tokens = "".join(r.token for r in known)
    places = "".join(chr(PRIVATE + r.token_id) for r in known)

    def ids(text):
        own = F.regexp_replace(text, r"[\x{F0000}-\x{10FFFF}]", NO_CHARACTER)
        return F.transform(chars(F.translate(own, tokens, places)), lambda c: F.when(
            F.ascii(c) >= PRIVATE, F.ascii(c) - PRIVATE).otherwise(UNK_ID).cast("long"))
    return ids


def _joined_ids(df: DataFrame, text: str, vocab: DataFrame, out: str, row_id: str,
                keep: int) -> DataFrame:
    """Token ids by a join.  Broadcast: one-character tokens, of which Unicode has at
    most 1,114,112, about 20 MB."""
    occ = df.select(F.col(row_id).alias("_gl_r"),
                    F.posexplode(chars(F.substring(text, 1, keep))).alias("p", "token"))
    table = F.broadcast(vocab.where(F.length("token") == 1).select("token", "token_id"))
    ids = (occ.join(table, "token", "left").groupBy("_gl_r")
           .agg(F.array_sort(F.collect_list(F.struct("p", F.coalesce(
               "token_id", F.lit(UNK_ID)).cast("long").alias("i"))))["i"].alias(out)))
    return df.join(ids, F.col(row_id) == F.col("_gl_r"), "left").drop("_gl_r")


def encode(df: DataFrame, text_col: str, vocab: DataFrame, max_len: int, out: str,
           row_id: str = "row_id", labels: bool = False) -> DataFrame:
    """K3: character ids ``[CLS] chars [SEP]`` truncated/padded to ``max_len``,
    plus an attention mask; with ``labels`` the padding id becomes -100.

    The text is cut to what is encoded first; ids come from an inline table (no
    shuffle).  A null text counts as empty.
    """
    keep = max_len - 2
    ids = _character_ids(vocab)
    if ids is not None:
        coded = df.withColumn("_gl_ids", ids(F.substring(text_col, 1, keep)))
    else:
        coded = _joined_ids(df, text_col, vocab, "_gl_ids", row_id, keep)
    body = F.coalesce("_gl_ids", F.array().cast("array<bigint>"))
    seq = F.concat(F.array(F.lit(CLS_ID).cast("long")), body, F.array(F.lit(SEP_ID).cast("long")))
    pad_n = F.lit(max_len) - F.size(seq)
    pad_id = LABEL_PAD if labels else PAD_ID
    padded = F.concat(seq, F.array_repeat(F.lit(pad_id).cast("long"), pad_n))
    mask = F.concat(F.array_repeat(F.lit(1).cast("long"), F.size(seq)),
                    F.array_repeat(F.lit(0).cast("long"), pad_n))
    return coded.withColumn(out, padded).withColumn(out + "_mask", mask).drop("_gl_ids")


def encode_pairs(pairs: DataFrame, vocab: DataFrame, max_source: int = 50, max_target: int = 50,
                 row_id: str = "row_id") -> DataFrame:
    """K3 over training pairs: (row_id, source_ids, source_mask, labels, target_mask);
    the labels are the target's ids with -100 in the padding."""
    both = encode(pairs, "source_text", vocab, max_source, "_gl_s", row_id)
    both = encode(both, "target_text", vocab, max_target, "_gl_t", row_id, labels=True)
    return both.select(row_id, F.col("_gl_s").alias("source_ids"),
                       F.col("_gl_s_mask").alias("source_mask"), F.col("_gl_t").alias("labels"),
                       F.col("_gl_t_mask").alias("target_mask"))


def truncation_report(df: DataFrame, cols: Sequence[str], max_len: int, epochs: int = 10,
                      batch_size: int = 64) -> DataFrame:
    """K5: rows longer than ``max_len - 2`` characters per column and training steps."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for c in cols:
        aggs.append(F.count_if(F.length(c) > max_len - 2).alias(f"n_truncated_{c}"))
    out = df.agg(*aggs)
    return out.withColumn("steps", (F.col("n_rows") * epochs / batch_size).cast("long"))


def training_table(raw: DataFrame, dictionary: DataFrame, prefix: str = "",
                   row_id: str = "row_id", symbols: Symbols = GRAMMAR,
                   observation: Observation | None = None) -> DataFrame:
    """P10 tail: demojize the prepared source (E8), remove its spaces (E4),
    drop duplicate pairs (O2).  ``raw`` must already be prepared (P1).  With
    ``observation`` O2's counts come from the same pass."""
    from .substitute import demojize
    d = demojize(raw, "source_text", dictionary, "_gl_src", row_id=row_id, symbols=symbols)
    d = d.select(row_id, remove_spaces("_gl_src").alias("source_text"), "target_text")
    return drop_duplicate_pairs(d, row_id=row_id, observation=observation)
