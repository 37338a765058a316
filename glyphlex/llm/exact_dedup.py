"""Exact dedup by content sort, native DataFrame operations only.

1. A sample of content keys gives splitters; every row gets the number of its
   key range (``part``).  A content key is the first 64 characters, a 64-bit
   digest of the whole text and a digest of the identifier: bounded in size, and
   fine enough that a text shared by a third of all rows is spread over many
   ranges.
2. One exchange by ``part``; inside a range Spark's external sort places equal
   texts next to each other, and each text is compared in full with its
   neighbour (``lag``).  Equal neighbours form a run.
3. A run that goes on in the next range is found by comparing the texts at the
   edges of the ranges in full: two rows for each range, however large the
   input is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import ascii_lower, buckets_below, hex64, materialize

#: Characters of a text that its splitter key holds.
PREFIX = 64
#: Most key ranges, and sampled keys for each range (bounds what the driver holds).
MAX_PARTS, SAMPLES_PER_PART = 16384, 16


def content_key(norm: Column) -> Column:
    """Fixed-width start of the text, then a digest of all of it."""
    return F.concat(F.rpad(F.substring(norm, 1, PREFIX), PREFIX, "\0"), hex64(F.xxhash64(norm)))


def splitters(docs: DataFrame, text: str, doc_id: str, parts: int) -> list[str]:
    """Every ``SAMPLES_PER_PART``-th key of a sorted sample of bounded size.

    They only balance the ranges; the result is the same for any splitters.
    """
    want = parts * SAMPLES_PER_PART
    n = docs.count()
    if n == 0 or parts <= 1:
        return []
    sample = docs.select(F.col(f"`{text}`").alias("t"), F.xxhash64(F.col(f"`{doc_id}`")).alias("i"))
    if want < n:
        sample = sample.sample(want / n, seed=17)
    keys = sorted(r.k for r in sample.select(
        F.concat(content_key(ascii_lower(F.col("t"))), hex64(F.col("i"))).alias("k"))
        .limit(2 * want).collect())
    step = max(1, len(keys) // parts)
    return sorted(set(keys[step::step]))


def dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: str = "smallest",
          carry: list[str] | None = None, parts: int | None = None) -> DataFrame:
    """Mark exact copies: one row per input row with the struct ``_row`` (the
    columns named in ``carry``, all by default) and ``keep_id``, ``group_size``,
    ``kept``, ``text_sha256`` (of the lower-cased text).

    Texts are equal when identical after lower-casing A-Z only.  ``keep`` tells
    which identifier of a group stays, ``smallest`` or ``largest``; a null
    identifier stays only where all are null.  Of rows that share text and
    identifier one stays.  A null text counts as empty, so null and empty texts
    are one group.  An empty table gives an empty result.  Columns of any name
    may be carried: they stay inside ``_row``.

    What the sort finds is written once to the shared checkpoint folder, so a
    later loss of an executor does not repeat the sort.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    carry = docs.columns if carry is None else carry
    n_shuffle = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = min(parts or 4 * n_shuffle, MAX_PARTS)
    bounds = splitters(docs, text, doc_id, parts)

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("_row"),
                       F.col(f"`{doc_id}`").alias("ident"), F.col(f"`{text}`").alias("raw"))
    # the exchange moves each text once: as carried, or else in normal form
    own = text in carry
    norm = ascii_lower(F.col(f"_row.`{text}`")) if own else F.col("norm")
    moved = (rows.withColumn("norm", ascii_lower(F.col("raw")))
             .withColumn("part", buckets_below(
                 F.concat(content_key(F.col("norm")), hex64(F.xxhash64("ident"))), bounds))
             .select("_row", "ident", "part", *([] if own else ["norm"]))
             .repartition(n_shuffle, "part")
             .withColumn("norm", norm).withColumn("key", content_key(F.col("norm"))))
    best = F.min if keep == "smallest" else F.max
    by_id = (F.col("ident").asc_nulls_last() if keep == "smallest"
             else F.col("ident").desc_nulls_last())
    content = W.partitionBy("part").orderBy("key", "norm", by_id)
    run = W.partitionBy("part", "run")
    local = (moved
             .withColumn("before", F.lag("norm").over(content))
             .withColumn("after", F.lead("norm").over(content))
             .withColumn("starts", F.col("before").isNull() | (F.col("before") != F.col("norm")))
             .withColumn("run", F.sum(F.col("starts").cast("int")).over(
                 content.rowsBetween(W.unboundedPreceding, 0)))
             .select("_row", "ident", "part", "run", "starts",
                     F.sha2(F.encode("norm", "UTF-8"), 256).alias("text_sha256"),
                     F.when(F.col("before").isNull() | F.col("after").isNull(),
                            F.col("norm")).alias("edge"))
             .withColumn("run_keep", best("ident").over(run))
             .withColumn("run_size", F.count(F.lit(1)).over(run)))
    local = materialize(local, "content-sort")

    chains = _stitch(local.where(F.col("edge").isNotNull()), best)
    # broadcast: at most two rows for each of at most MAX_PARTS ranges
    out = local.join(F.broadcast(chains), ["part", "run"], "left")
    return out.select(
        "_row",
        F.when(F.col("holds").isNull(), F.col("run_keep")).otherwise(F.col("chain_keep")).alias("keep_id"),
        F.coalesce("chain_size", "run_size").cast("long").alias("group_size"),
        (F.col("starts") & F.coalesce("holds", F.lit(True))).alias("kept"),
        "text_sha256")


def _stitch(edges: DataFrame, best) -> DataFrame:
    """Runs that go on over range borders: (part, run) -> group, and who holds it."""
    edges = edges.groupBy("part", "run").agg(
        F.min("edge").alias("edge"), F.min("run_keep").alias("run_keep"),
        F.min("run_size").alias("run_size"))
    line = W.partitionBy(F.lit(0)).orderBy("part", "run")
    goes_on = F.coalesce((F.col("run") == 1) & (F.lag("edge").over(line) == F.col("edge")), F.lit(False))
    chain = W.partitionBy("chain")
    return (edges.withColumn("new", F.when(goes_on, 0).otherwise(1))
            .withColumn("chain", F.sum("new").over(line.rowsBetween(W.unboundedPreceding, 0)))
            .drop("edge", "new")
            .withColumn("chain_keep", best("run_keep").over(chain))
            .withColumn("chain_size", F.sum("run_size").over(chain))
            .withColumn("runs", F.count(F.lit(1)).over(chain))
            .withColumn("holds", F.row_number().over(chain.orderBy(
                F.col("run_keep").eqNullSafe(F.col("chain_keep")).desc(), "part")) == 1)
            .where("runs > 1")
            .select("part", "run", "chain_keep", "chain_size", "holds"))
