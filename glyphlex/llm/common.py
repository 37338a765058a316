"""Shared helpers: table access, ASCII lower-casing, native key splitting."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, materialize, ship_package

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


#: Rows of one Arrow batch, so that texts of some kilobytes make batches of some
#: megabytes in a worker; a session's own setting stays.
ARROW_ROWS, ARROW_SETTING = 2000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def prepare(spark: SparkSession) -> SparkSession:
    """Checkpoint folder known, package importable in the Python workers, batches of
    a moderate size."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    if spark.conf.get(ARROW_SETTING, None) is None:
        spark.conf.set(ARROW_SETTING, str(ARROW_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null counts as empty.

    ``lower`` has a byte-wise fast path and is exact on pure ASCII; other texts
    go through ``translate`` so that letters such as ``É`` stay as they are.
    """
    t = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(t) == F.length(t), F.lower(t)).otherwise(
        F.translate(t, UPPER, UPPER.lower()))


def hex64(number: Column) -> Column:
    """A long as 16 hex digits; as strings these sort like unsigned numbers."""
    return F.lpad(F.hex(number), 16, "0")


def packed(docs: DataFrame) -> Column:
    """All columns of ``docs`` in one struct, so that no helper column can clash."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")


def buckets_below(key: Column, bounds: list[str]) -> Column:
    """Number of ``bounds`` (sorted strings) that are <= the string ``key``.

    A binary search written as one ``aggregate`` over the halving steps:
    O(log n) comparisons a row instead of one per bound.
    """
    if not bounds:
        return F.lit(0)
    n = len(bounds)
    steps = []
    s = 1
    while s <= n:
        steps.insert(0, s)
        s *= 2
    arr = F.from_json(F.lit(json.dumps(bounds)), "array<string>")  # folded to one constant
    return F.aggregate(
        F.array(*[F.lit(x) for x in steps]), F.lit(0),
        lambda acc, step: F.when(
            (acc + step <= n) & (F.get(arr, acc + step - 1) <= key), acc + step).otherwise(acc))


__all__ = ["UPPER", "ascii_lower", "buckets_below", "hex64", "materialize", "packed", "prepare", "table"]
