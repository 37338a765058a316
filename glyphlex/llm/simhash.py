"""SimHash near-duplicates with a Gray-order hierarchical index.

A fingerprint has a bit for each bit position that is set in over half of the
digests of a text's word shingles.  Two texts are linked when their fingerprints
differ in at most ``max_bits`` bits.

The index is a forest.  Its roots are masked bit patterns: the 64 positions are
cut into blocks, and every choice of (blocks - max_bits) blocks is a mask.  Two
fingerprints within ``max_bits`` agree on all bits of at least one mask, so both
stand below the same root there, and no link is lost.  Spark deals the roots out
by one exchange.  Below a root, fingerprints are sorted by Gray rank (neighbours
differ in few bits), groups of FANOUT neighbours become nodes, and a node holds
the bits that all its members share beyond those its parent holds.  A search
adds up the differences to these patterns on its way down and drops a whole
group as soon as they exceed ``max_bits``, or once the group is known to belong
to the searcher's own component.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, prepare
from .components import components

SEED = 42
FANOUT = 8
#: Mean fingerprints below a root that the number of blocks aims at.
ROOT_SIZE = 2048
#: Fingerprints below one root that one piece of work holds; a root with more is
#: cut into pieces, and every two of them meet.
PIECE = 32768
#: Fingerprints that a task handles at once (whole roots), searchers and open
#: (searcher, node) pairs at a time.
AT_ONCE, SEARCHERS, OPEN = 1 << 16, 4096, 1 << 19

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_COLUMN = (np.arange(8) * 256)[None, :]


def fingerprint(text: bytes, shingle: int) -> int:
    """64-bit SimHash; a text of fewer words is one shingle, one of none is zero."""
    words = text.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:n - 1]]).tolist()
    stops = (ends[min(shingle, len(words)) - 1:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, n)
    seen = np.bincount((h.view(np.uint8).reshape(n, 8) + _COLUMN).reshape(-1), minlength=2048)
    ones = (seen.reshape(8, 256) @ _BYTE_BITS).reshape(64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _fingerprinter(shingle: int):
    @F.arrow_udf("long")
    def fingerprints(texts: pa.Array) -> pa.Array:
        out = np.zeros(len(texts), np.uint64)
        for k, t in enumerate(texts.cast(pa.large_binary())):
            b = t.as_buffer()
            out[k] = fingerprint(b.to_pybytes(), shingle) if b is not None else 0
        return pa.array(out.view(np.int64))
    return fingerprints


def masks(max_bits: int, n: int) -> list[int]:
    """Masks of the roots for ``n`` fingerprints, fewest blocks first that keep the
    mean root small enough; any number of blocks gives the same links."""
    blocks = max_bits + 1
    while blocks < 16 and n / 2 ** (64 * (blocks - max_bits) // blocks) > ROOT_SIZE:
        blocks += 1
    cuts = [64 * k // blocks for k in range(blocks + 1)]
    own = [sum(1 << b for b in range(cuts[k], cuts[k + 1])) for k in range(blocks)]
    return [sum(own[k] for k in chosen) for chosen in combinations(range(blocks), blocks - max_bits)]


def gray_rank(code):
    """Place of a code in Gray order (as a column)."""
    for s in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, s))
    return code


class Forest:
    """Levels of nodes over fingerprints sorted by (root, Gray rank)."""

    def __init__(self, root: np.ndarray, code: np.ndarray):
        self.code = code
        n = len(code)
        self.levels = []  # from the fingerprints up: first row, rows' end, all-ones, any-ones, root
        first, stop, every, some, own = np.arange(n), np.arange(1, n + 1), code, code, root
        self.levels.append((first, stop, every, some, None))
        while True:
            starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            if len(starts) == len(own) and len(self.levels) > 1:
                break
            sizes = np.diff(np.append(starts, len(own)))
            place = np.arange(len(own)) - np.repeat(starts, sizes)
            at = np.flatnonzero(place % FANOUT == 0)
            child_stop = np.append(at[1:], len(own))
            every, some = np.bitwise_and.reduceat(every, at), np.bitwise_or.reduceat(some, at)
            first, stop, own = first[at], stop[child_stop - 1], own[at]
            self.levels.append((first, stop, every, some, (at, child_stop)))
        self.root_of = np.repeat(np.arange(len(first)), stop - first)  # row -> top node
        # bits that all members share, less those that the parent holds already
        self.shared: list = [None] * len(self.levels)
        above = np.zeros(len(first), np.uint64)
        for k in range(len(self.levels) - 1, -1, -1):
            _, _, every, some, children = self.levels[k]
            mask = ~(every ^ some)
            self.shared[k] = (every, mask & ~above)
            if children is not None:
                above = np.repeat(mask, children[1] - children[0])

    def links(self, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, row) pairs that join all rows that the bit distance joins: every
        row but the first of its component, with that first row."""
        n = len(self.code)
        parent = np.arange(n)
        single = None
        for begin in range(0, n, SEARCHERS):
            q = np.arange(begin, min(begin + SEARCHERS, n))
            found = self._search(q, max_bits, parent, single)
            if len(found[0]):
                _join(parent, *found)
                single = self._single(parent)
        row = np.flatnonzero(parent != np.arange(n))
        return row, parent[row]

    def _single(self, parent: np.ndarray) -> list[np.ndarray]:
        """By level: the component of a node whose members are all in one, else -1."""
        out = [parent]
        low = high = parent
        for _, _, _, _, (at, _) in self.levels[1:]:
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            out.append(np.where(low == high, low, -1))
        return out

    def _search(self, q: np.ndarray, max_bits: int, parent: np.ndarray, single) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (searcher, later row) within the distance and not known to be joined."""
        top = len(self.levels) - 1
        todo = [(top, q, self.root_of[q], np.zeros(len(q), np.int64))]
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        while todo:
            level, q, node, acc = todo.pop()
            if len(q) > OPEN:
                half = len(q) // 2
                todo += [(level, q[half:], node[half:], acc[half:]), (level, q[:half], node[:half], acc[:half])]
                continue
            _, stop, _, _, children = self.levels[level]
            pattern, mask = self.shared[level]
            acc = acc + np.bitwise_count((self.code[q] ^ pattern[node]) & mask[node])
            keep = (acc <= max_bits) & (stop[node] > q + 1)
            if single is not None:
                keep &= single[level][node] != parent[q]
            q, node, acc = q[keep], node[keep], acc[keep]
            if children is None:
                a.append(q)
                b.append(node)
                continue
            size = children[1][node] - children[0][node]
            ends = np.cumsum(size)
            each = np.repeat(np.arange(len(q)), size)
            child = np.arange(ends[-1] if len(ends) else 0) - (ends - size)[each] + children[0][node][each]
            if len(child):
                todo.append((level - 1, q[each], child, acc[each]))
        return np.concatenate(a), np.concatenate(b)


def _join(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Union of rows in place; afterwards every row points at its least row."""
    while True:
        a, b = parent[i], parent[j]
        apart = a != b
        if not apart.any():
            return
        i, j = i[apart], j[apart]
        low, high = np.minimum(a, b)[apart], np.maximum(a, b)[apart]
        np.minimum.at(parent, high, low)
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up


def _link_roots(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by root, then Gray rank: links below each root."""
    held: list[pa.Table] = []
    rows = 0

    def link(t: pa.Table) -> pa.RecordBatch:
        keys = [t[c].to_numpy() for c in ("mask", "pattern", "a", "b")]
        new = np.zeros(len(t), bool)
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
        code = t["fp"].to_numpy().view(np.uint64)
        i, j = Forest(np.cumsum(new), code).links(max_bits)
        code = code.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(code[i]), pa.array(code[j])], ["u", "v"])

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(pa.Table.from_batches([batch]))
        rows += batch.num_rows
        if rows >= AT_ONCE:
            t = pa.concat_tables(held).combine_chunks()
            last = {c: t[c][-1].as_py() for c in ("mask", "pattern", "a", "b")}
            tail = np.ones(len(t), bool)
            for c, x in last.items():
                tail &= t[c].to_numpy() == x
            cut = int(np.argmax(tail))  # the last root may go on
            if cut:
                yield link(t.slice(0, cut))
            held, rows = [t.slice(cut)], len(t) - cut
    if rows:
        yield link(pa.concat_tables(held).combine_chunks())


def link_fingerprints(distinct: DataFrame, n: int, max_bits: int) -> DataFrame:
    """Links (u, v) among ``n`` different fingerprints (column ``fp``), enough to
    join what is within ``max_bits``, at most one a fingerprint and root."""
    spark = distinct.sparkSession
    n_shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    below = distinct.select("fp", F.posexplode(F.array(
        *[F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)) for m in masks(max_bits, n)]
    )).alias("mask", "pattern"))
    below = below.withColumn("a", F.lit(0)).withColumn("b", F.lit(0))
    large = materialize(below.groupBy("mask", "pattern").agg(F.count(F.lit(1)).alias("n"))
                        .where(F.col("n") > PIECE), "large-roots")
    n_large = large.count()
    if n_large:
        pieces = large.select("mask", "pattern", F.ceil(F.col("n") / PIECE).cast("int").alias("pieces"))
        # few by nature (n / PIECE for each mask); beyond the bound a plain join
        pieces = F.broadcast(pieces) if n_large <= 100_000 else pieces
        own = F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int")
        below = (below.drop("a", "b").join(pieces, ["mask", "pattern"], "left")
                 .withColumn("own", F.coalesce(own, F.lit(0)))
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("pieces", F.lit(1)) - 1)))
                 .select("fp", "mask", "pattern", F.least("own", "other").alias("a"),
                         F.greatest("own", "other").alias("b")))
    dealt = (below.withColumn("gray", gray_rank(F.col("fp")))
             .repartition(n_shuffle, "mask", "pattern", "a", "b")
             .sortWithinPartitions("mask", "pattern", "a", "b", "gray")
             .select("fp", "mask", "pattern", "a", "b"))
    return dealt.mapInArrow(lambda it: _link_roots(it, max_bits), "u long, v long")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 4,
                    max_bits: int = 4, carry: list[str] | None = None) -> DataFrame:
    """Components of texts whose fingerprints are linked: one row per input row with
    the struct ``_row`` (the columns named in ``carry``, all by default),
    ``fingerprint`` (long), ``component_id`` (least identifier of the component)
    and ``kept`` (one row of each component, one that has that identifier).

    Words are what stands between ASCII white space after lower-casing A-Z.  Null
    and empty texts have fingerprint zero, which is linked like any other.  A
    component without any identifier has a null one.  An empty table gives an
    empty result.  Columns of any name may be carried: they stay inside ``_row``.
    """
    spark = prepare(docs.sparkSession)
    carry = docs.columns if carry is None else carry
    rows = materialize(docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("_row"), F.col(f"`{doc_id}`").alias("ident"),
        _fingerprinter(shingle)(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("fp"),
        F.monotonically_increasing_id().alias("uid")), "fingerprints")
    distinct = materialize(rows.groupBy("fp").agg(F.min("ident").alias("least")), "distinct")
    roots = components(link_fingerprints(distinct, distinct.count(), max_bits))
    # fingerprint -> root, for those that have links; a root is its own
    joined = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least")
    per_root = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    of = materialize(joined.select("fp", "root").join(per_root, "root"), "roots")
    slim = rows.select("uid", "ident", "fp").join(of, "fp")
    first = (slim.where(F.col("ident").eqNullSafe(F.col("component_id")))
             .groupBy("root").agg(F.min("uid").alias("first")))
    of = of.join(first, "root")
    return rows.join(of, "fp").select("_row", F.col("fp").alias("fingerprint"), "component_id",
                                      (F.col("uid") == F.col("first")).alias("kept"))
