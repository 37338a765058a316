"""Connected components of a graph that is a table of links, by alternating
large-star and small-star steps (each an aggregate and a join, no group is ever
held by one task)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

MAX_ROUNDS = 60


def _signature(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """links (u, v): numbers that belong together.  Returns (node, root) for every
    node of a link but the roots; a root is the least number of its component.
    Each round is written to the shared checkpoint folder."""
    links = materialize(
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .where("u != v").distinct(), "links")
    seen = _signature(links)
    for _ in range(MAX_ROUNDS):
        if not seen[0]:
            break
        # large star: larger neighbours of a node go to its least neighbour
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        # small star: a node and its smaller neighbours go to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u")
        small = (moved.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        links = materialize(small, "links")
        now = _signature(links)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
