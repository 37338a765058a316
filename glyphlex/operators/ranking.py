"""Dense, gap-free 0-based positions in a total order, computed without a
single-partition window.

The reference numbers things "in first-seen order" (vocabulary ids, dictionary
ranks, the first ``ceil(0.1 n)`` rows of a shuffled order).  A global
``row_number()`` would move the whole table into one task.  Instead:

1. range-partition on the order key into a fixed number of partitions
   (a user-numbered repartition, so AQE never coalesces it and partition ids
   stay stable), sort within partitions;
2. the in-partition position is ``monotonically_increasing_id() - (pid << 33)``;
3. per-partition counts (one row per partition) give offsets through a window
   over that tiny table, joined back by broadcast (its size is the partition count).

The tagged rows are written once to the shared checkpoint folder and both
branches read that table, so counts and positions always agree (no reliance on
exchange reuse, and a recomputed partition cannot land on other range bounds).  Callers must pass a total order (ties broken by a unique key).

The input is first written to the checkpoint folder (its upstream - usually a
scan, an explode and an aggregation - runs once, and lineage is cut).  Inputs
whose exact count is at most N (default 100,000 rows: dictionaries,
vocabularies) then take a single sorted partition instead: one stage instead of
five, and the bound is checked, not assumed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "8")))


SMALL_ROWS = 100_000


def dense_index(df: DataFrame, order: Sequence[Column | str], out: str,
                num_partitions: int | None = None, small_rows: int | None = None) -> DataFrame:
    """Add ``out`` = 0-based position of each row in ``order``."""
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    bound = SMALL_ROWS if small_rows is None else small_rows
    # the input is written once: the size check and the index read the same rows
    # and the (usually expensive) upstream runs a single time
    df = materialize(df, "dense-input")
    if bound > 0 and df.count() <= bound:
        w = Window.orderBy(*cols)
        return df.withColumn(out, (F.row_number().over(w) - 1).cast("long"))
    n = _partitions(df, num_partitions)
    tagged = (df.repartitionByRange(n, *cols)
              .sortWithinPartitions(*cols)
              .withColumn("_gl_pid", F.spark_partition_id())
              .withColumn("_gl_mid", F.monotonically_increasing_id()))
    # written once: counts and positions then come from the same rows, whatever
    # the exchange-reuse setting, and a lost executor cannot re-sample the ranges
    tagged = materialize(tagged, "dense-index")
    counts = tagged.groupBy("_gl_pid").agg(F.count(F.lit(1)).alias("_gl_n"))
    w = Window.orderBy("_gl_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_gl_pid", F.coalesce(F.sum("_gl_n").over(w), F.lit(0))
                            .cast("long").alias("_gl_off"))
    local = F.col("_gl_mid") - F.shiftleft(F.col("_gl_pid").cast("long"), 33)
    return (tagged.join(F.broadcast(offsets), "_gl_pid")
            .withColumn(out, F.col("_gl_off") + local)
            .drop("_gl_pid", "_gl_mid", "_gl_off"))


def first_seen_struct(*order_cols: str) -> Column:
    """``min(struct(order...))``: the first occurrence, partially aggregable."""
    return F.min(F.struct(*[F.col(c) for c in order_cols]))
