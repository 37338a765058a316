"""Grouping of rows with equal texts, digests first.

A plain ``groupBy`` on texts shuffles every text.  Here each row's 128-bit digest is
counted first, so only digests are shuffled.  Digests that repeat are marked in a bit
table of bounded size, which is broadcast.  A row whose digest has no mark is alone and
stays where it is; the others are grouped by digest and full texts.  Two texts that
share a digest or a mark are still told apart, so the result is exact for any digest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..session import materialize

#: Places of the bit table, which is broadcast as at most 2**BITS / 63 + 1 rows of two
#: numbers (266,306 rows).  More repeats than that fill it up, and more rows that are
#: alone are shuffled with them; the result is the same.
BITS = 24


def computed_once(df: DataFrame) -> DataFrame:
    """The same rows and columns.  A filter on a computed column is moved below its
    projection and computes it a second time; it is not moved below a generator."""
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))


def digest_of(cols: Sequence[str]) -> Column:
    """128 bits of some text columns: two 64-bit digests of different seeds."""
    texts = [F.col(f"`{c}`") for c in cols]
    return F.struct(F.xxhash64(F.lit(0), *texts).alias("a"), F.xxhash64(F.lit(1), *texts).alias("b"))


def group_equal(df: DataFrame, cols: Sequence[str], row_id: str, n: str = "n",
                digest: Column | None = None, bits: int = BITS) -> DataFrame:
    """``groupBy(*cols)`` with the least ``row_id`` and the number of rows ``n``.

    Nulls are equal to each other.  Columns other than texts are grouped plainly.  The
    needed columns are written once, so that digests and texts are of the same rows."""
    own = df.select(row_id, *cols)
    one = [F.min(f"`{row_id}`").alias(row_id), F.count(F.lit(1)).alias(n)]
    if any(own.schema[c].dataType != StringType() for c in cols):
        return own.groupBy(*cols).agg(*one)
    key = digest_of(cols) if digest is None else digest
    rows = materialize(own.withColumn("_gl_d", key), "equal-rows")
    slot = F.pmod(F.col("_gl_d.a"), F.lit(1 << bits))
    place = F.pmod(slot, F.lit(63)).cast("int")
    marks = (rows.groupBy("_gl_d").agg(F.count(F.lit(1)).alias("_gl_n")).where("_gl_n > 1")
             .groupBy(F.floor(slot / 63).cast("int").alias("_gl_word"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), place)).alias("_gl_bits")))
    tagged = (rows.withColumn("_gl_word", F.floor(slot / 63).cast("int"))
              .join(F.broadcast(marks), "_gl_word", "left"))
    marked = F.coalesce(F.call_function("shiftright", F.col("_gl_bits"), place)
                        .bitwiseAND(F.lit(1)) == 1, F.lit(False))
    alone = tagged.where(~marked).select(*cols, row_id, F.lit(1).cast("long").alias(n))
    met = tagged.where(marked).groupBy("_gl_d", *cols).agg(*one).select(*cols, row_id, n)
    return alone.unionByName(met)
