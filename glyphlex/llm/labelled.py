"""Which rows a classifier may learn from, and samples of them of bounded size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5
_GRAIN = 1 << 40


def held_out(doc_id: Column) -> Column:
    """Rows kept back for tests: a fifth, by the CRC-32 of the identifier as text."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % FOLDS == 0, F.lit(False))


def spread(doc_id: Column, salt: int = 0) -> Column:
    """A number below _GRAIN that depends on the identifier only."""
    return F.pmod(F.xxhash64(F.lit(salt), doc_id), F.lit(_GRAIN))


def labels_of(labels: DataFrame, doc_id: str, label: str) -> DataFrame:
    """(doc_id, y): one row for each labelled identifier outside the test fold; rows
    that disagree count as 1."""
    return (labels.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("y"))
            .where("doc_id is not null and y is not null").where(~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.max("y").alias("y")))


def at_most(ids: DataFrame, n: int, bound: int, salt: int = 0) -> DataFrame:
    """About ``bound`` of ``n`` rows, chosen by identifier; all of them if n <= bound."""
    return ids if n <= bound else ids.where(spread(F.col("doc_id"), salt) < int(_GRAIN * bound / n))


def one_text(rows: DataFrame, *keys: str) -> DataFrame:
    """One row for each combination of ``keys``, with its least text; repeated rows are
    reduced before the shuffle."""
    return rows.groupBy(*keys).agg(F.min("text").alias("text"))
