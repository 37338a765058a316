"""Sharding by histogram sort, native DataFrame operations only.

Rows are ordered by a 192-bit key: the digest of the text, the digest of the
identifier, and a number of the row's own, so that repeated rows can be told
apart.  Splitters between the shards are found without sorting: each
round counts the exact bytes and rows below a set of probe keys over all
partitions and refines the probes around every shard border that is not settled
yet.  When all are settled, one exchange puts every row in its place.

Equal texts share the first third of the key, so a group of copies stays in one
shard.  Only a group larger than ``group_share`` of a shard may be cut, at the row
nearest to the border.
"""

from __future__ import annotations

import json
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import buckets_below, hex64, materialize, packed

#: Probes that split an unsettled interval in one round.
PROBES = 16
#: Rows that one shard's sub-ranges may differ from each other, as a share (they
#: only spread the work inside a shard).
LOOSE = 0.25
SPACE = 1 << 192
GROUP = 1 << 128


def _hex(key: int) -> str:
    return f"{key:048X}"


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes plus one; a null text has none."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def shard_key(text: Column, ident: Column, row: Column) -> Column:
    return F.concat(hex64(F.xxhash64(F.coalesce(text, F.lit("")))), hex64(F.xxhash64(ident)),
                    hex64(F.xxhash64(row)))


class _Border:
    """One border that is looked for: the wanted bytes below it, and the interval
    [low, high) of keys that holds it, with the exact bytes below ``low``."""

    def __init__(self, want: float, tolerance: float, group_bytes: float, total: int, rows: int):
        self.want, self.tolerance, self.group_bytes = want, tolerance, group_bytes
        self.low, self.high, self.below, self.inside, self.rows = 0, SPACE, 0, total, rows
        self.key: int | None = None
        self._settle()

    def _settle(self) -> None:
        """Take the nearer end where the interval can't or needn't be split."""
        one_group = (self.high - 1) // GROUP == self.low // GROUP
        off = min(abs(self.want - self.below), abs(self.below + self.inside - self.want))
        done = (self.rows <= 1 or off <= self.tolerance or self.high - self.low <= 1
                or one_group and self.inside <= self.group_bytes)
        if done:
            near_low = abs(self.want - self.below) <= abs(self.below + self.inside - self.want)
            self.key = self.low if near_low else self.high

    def probes(self) -> list[int]:
        """Between texts as long as there are several, then inside the one text."""
        unit = GROUP if (self.high - 1) // GROUP != self.low // GROUP and self.group_bytes else 1
        first, last = self.low // unit, -(-self.high // unit)
        return sorted({(first + (last - first) * i // PROBES) * unit for i in range(1, PROBES)}
                      | ({(first + 1) * unit} if unit > 1 else set()))

    def narrow(self, cells: list[tuple[int, int, int, int, int, int]]) -> None:
        """cells: (start, end, bytes below, bytes, rows, ...) of this interval, in order."""
        for below, size, rows, least, most in cells:
            if below + size > self.want or (below, size, rows, least, most) == cells[-1]:
                self.low, self.high = least, most + 1
                self.below, self.inside, self.rows = below, size, rows
                break
        self._settle()


def find_borders(sizes: DataFrame, n_shards: int, sub: int, tolerance: float,
                 group_share: float) -> tuple[list[int], list[int], int]:
    """Keys of all borders in order, of those between shards, and the rounds taken.

    ``sizes``: (key string, size long).  Every sub-th border lies between shards
    and is settled to ``tolerance`` (a share of a shard); the others only split
    a shard's work.  Driver memory: PROBES rows for each unsettled border.
    """
    total, rows = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    shard = total / n_shards
    borders = []
    for i in range(1, n_shards * sub):
        main = i % sub == 0
        borders.append(_Border(total * i / (n_shards * sub),
                               shard * tolerance if main else shard / sub * LOOSE,
                               shard * group_share if main else 0.0, total, rows))
    rounds = 0
    while open_ := [b for b in borders if b.key is None]:
        rounds += 1
        probes = sorted({p for b in open_ for p in [b.low, b.high, *b.probes()] if 0 < p < SPACE})
        cell = buckets_below(F.col("key"), [_hex(p) for p in probes])
        found = {r.cell: r for r in sizes.groupBy(cell.alias("cell")).agg(
            F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"),
            F.min("key").alias("least"), F.max("key").alias("most")).collect()}
        below, line = 0, []
        for c in range(len(probes) + 1):
            if r := found.get(c):
                line.append((below, r["size"], r["rows"], int(r["least"], 16), int(r["most"], 16)))
                below += r["size"]
        for b in open_:
            b.narrow([x for x in line if x[3] >= b.low and x[4] < b.high])
    main = sorted(b.key for b in borders[sub - 1::sub])
    return sorted({b.key for b in borders}), main, rounds


def shard(docs: DataFrame, n_shards: int = 16, text: str = "text", doc_id: str = "doc_id",
          tolerance: float = 0.0005, group_share: float = 0.005) -> DataFrame:
    """Deal rows to ``n_shards`` shards of nearly equal bytes: the struct ``_row``
    (all input columns), ``size``, ``shard`` and ``slot`` (gapless from 0).

    A shard's size may be off by ``tolerance`` of the mean or half of the row at
    its border, whichever is more; a group of equal texts of at most
    ``group_share`` of a shard is not cut, which may add half of that.  A null
    text has no bytes and counts as equal to an empty one; every row has one byte
    more than its text.  Rows that agree in text and identifier are dealt like
    other equal texts.  An empty table gives an empty result.  Columns of any name
    may be carried: they stay inside ``_row``.

    The rows are written once with their keys to the shared checkpoint folder, so
    that a row keeps its number; the rounds read only the keys.  Texts move once,
    in the last exchange.
    """
    t, i = F.col(f"`{text}`"), F.col(f"`{doc_id}`")
    n_shuffle = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sub = max(1, -(-2 * n_shuffle // n_shards))
    keyed = materialize(docs.select(
        packed(docs), shard_key(t, i, F.monotonically_increasing_id()).alias("key"),
        text_bytes(t).alias("size")), "shard-rows")
    sizes = keyed.select("key", "size")
    every, between, _ = find_borders(sizes, n_shards, sub, tolerance, group_share)
    bounds, main = ([_hex(b) if b < SPACE else "G" for b in x] for x in (every, between))

    part = buckets_below(F.col("key"), bounds)
    # one row for each range, which lies in one shard: at most n_shards * sub
    counts = sizes.groupBy(part.alias("part"), buckets_below(F.col("key"), main).alias("shard")).agg(
        F.count(F.lit(1)).alias("n")).orderBy("part").collect()
    shards, first, filled = [0] * (len(bounds) + 1), [0] * (len(bounds) + 1), Counter()
    for r in counts:
        shards[r.part], first[r.part] = r.shard, filled[r.shard]
        filled[r.shard] += r.n

    def of_part(values: list[int], kind: str) -> Column:
        return F.get(F.from_json(F.lit(json.dumps(values)), f"array<{kind}>"), F.col("part"))
    inside = W.partitionBy("part").orderBy("key")
    return (keyed.select("_row", "key", "size", part.alias("part"))
            .withColumn("at", F.row_number().over(inside) - 1)
            .select("_row", "size", of_part(shards, "int").alias("shard"),
                    (of_part(first, "long") + F.col("at")).cast("long").alias("slot")))
