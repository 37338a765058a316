"""Benchmark decontamination by winnowing.

Each text is a sequence of words.  Of the GRAM-word digests, the least of every
WINDOW neighbours is a fingerprint.  GRAM + WINDOW - 1 = SPAN, so a span of SPAN
words that a document shares with an item has a fingerprint in common with it:
no shared span can be missed.  Matching fingerprints are extended word by word
to both sides and count only where at least SPAN words agree.

The items' fingerprints are a sorted array of checked size that is broadcast;
a larger benchmark is taken in blocks, each against all documents, and the spans
that the blocks find are united per document.  Documents are never shuffled for
a single block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, prepare
from .wordarrays import NOT_ALNUM, Words, gram_hashes, member, mix, text_blocks

SPAN, GRAM = 13, 6
WINDOW = SPAN - GRAM + 1
#: Bytes of item texts in one broadcast index (the index takes about three times that).
INDEX_BYTES = 16 << 20
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def _slide(x: np.ndarray, width: int, pick) -> np.ndarray:
    """Extreme of each ``width`` neighbours, by doubling."""
    have, n = 1, len(x) - width + 1
    out = x
    while have < width:
        step = min(have, width - have)
        out = pick(out[:len(out) - step], out[step:])
        have += step
    return out[:max(n, 0)]


def winnow(grams: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Positions of grams that are the least of some ``window`` neighbours (all of
    them where there are fewer)."""
    n = len(grams)
    if not n:
        return np.zeros(0, np.int64)
    pad = np.full(window - 1, _TOP, np.uint64)
    padded = np.concatenate([pad, grams, pad])
    least = _slide(padded, window, np.minimum)
    return np.flatnonzero(_slide(least, window, np.maximum) == grams)


def _grams_of_rows(words: Words, k: int) -> np.ndarray:
    """Gram digests, the greatest value where a gram would leave its text."""
    g = gram_hashes(words.hash, k)
    for j in range(1, k):
        cut = words.first[1:-1] - j
        g[cut[(cut >= 0) & (cut < len(g))]] = _TOP
    return g


@dataclass
class Index:
    """One block of items: their words, and the fingerprints by (gram length,
    whether winnowed) as sorted digests and the words they start at."""

    ids: np.ndarray      # by item row: its identifier as text, or None
    words: np.ndarray    # digests of all words, item after item
    row: np.ndarray      # item row of each word
    need: np.ndarray     # by item row: words that must agree
    grams: dict[tuple[int, bool], tuple[np.ndarray, np.ndarray]]


def build_index(items: list[tuple[str | None, bytes]]) -> Index:
    """An item of fewer than SPAN words, but not none, must occur whole: its first
    gram stands for it, and is looked up among all grams of a document."""
    ids, rows = [], []
    for i, text in items:
        w = Words(np.array([0, len(text)]), np.frombuffer(text, np.uint8), NOT_ALNUM).hash
        if len(w):
            ids.append(i)
            rows.append(w)
    lengths = np.array([len(r) for r in rows], np.int64)
    starts = np.cumsum(lengths) - lengths
    found: dict[tuple[int, bool], list] = {}
    for r, start in zip(rows, starts):
        size, full = min(len(r), GRAM), len(r) >= SPAN
        g = gram_hashes(r, size)
        at = winnow(g) if full else np.zeros(1, np.int64)
        found.setdefault((size, full), []).append((g[at], at + start))
    words = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
    row = np.repeat(np.arange(len(rows)), lengths)
    grams = {}
    for key, parts in found.items():
        g, at = (np.concatenate(x) for x in zip(*parts))
        one, _ = _first_of_each(row[at], _contexts(words, row, at, key[0]))
        g, at = g[one], at[one]
        order = np.argsort(g, kind="stable")
        grams[key] = (g[order], at[order])
    return Index(np.array(ids, object), words, row, np.minimum(lengths, SPAN), grams)


def _contexts(words: np.ndarray, row: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Digests of all words that an extension from a gram may look at: places with
    one context agree with any other place to the same extent."""
    h = np.zeros(len(at), np.uint64)
    for j in range(size - SPAN, SPAN):
        k = at + j
        own = np.clip(k, 0, len(row) - 1)
        inside = (k == own) & (row[own] == row[at])
        h = mix(h ^ np.where(inside, words[own], _TOP)) + np.uint64(1)
    return h


def _first_of_each(row: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the places of one row with one context, the first; and for each place the
    number of its first one."""
    order = np.lexsort((context, row))
    new = np.ones(len(order), bool)
    new[1:] = (row[order][1:] != row[order][:-1]) | (context[order][1:] != context[order][:-1])
    of = np.empty(len(order), np.int64)
    of[order] = np.cumsum(new) - 1
    return order[new], of


def _pairs(keys: np.ndarray, at: np.ndarray, grams: np.ndarray, where: np.ndarray,
           most: int = 200_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Joins equal digests: (place in the texts, place in the items), ``most`` at a time."""
    g = grams[where]
    low, high = np.searchsorted(keys, g, "left"), np.searchsorted(keys, g, "right")
    ends = np.cumsum(high - low)
    total = int(ends[-1]) if len(ends) else 0
    for begin in range(0, total, most):
        k = np.arange(begin, min(begin + most, total))
        j = np.searchsorted(ends, k, "right")
        yield where[j], at[high[j] - (ends[j] - k)]


def _extend(words: Words, row: np.ndarray, index: Index, p: np.ndarray, s: np.ndarray, size: int,
            reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Words that agree to the left of each pair, and from it on to the right, up
    to ``reach`` words beyond the gram."""
    step = np.arange(-reach, size + reach)
    a, b = p[:, None] + step, s[:, None] + step
    a_in, b_in = np.clip(a, 0, len(row) - 1), np.clip(b, 0, len(index.row) - 1)
    same = ((a == a_in) & (b == b_in) & (words.hash[a_in] == index.words[b_in])
            & (row[a_in] == row[p][:, None]) & (index.row[b_in] == index.row[s][:, None]))
    left = np.logical_and.accumulate(same[:, :reach][:, ::-1], axis=1).sum(axis=1)
    right = np.logical_and.accumulate(same[:, reach:], axis=1).sum(axis=1)
    return left, right


def scan(texts: pa.Array, index: Index) -> pa.Array:
    """For each text: n_words, the spans of hit words, and the identifiers of the
    items that have an occurring window."""
    n_words, spans_n, spans_at, spans_len, items_n, items = [], [], [], [], [], []
    for _, offsets, raw in text_blocks(texts):
        words = Words(offsets, raw, NOT_ALNUM)
        rows, n = len(offsets) - 1, len(words.hash)
        row = np.repeat(np.arange(rows), words.counts())
        edge = np.zeros(n + 1, np.int64)
        met: list[np.ndarray] = []
        for (size, full), (keys, at) in index.grams.items():
            grams = _grams_of_rows(words, size)
            where = winnow(grams) if full else np.arange(len(grams))
            where = where[member(keys, grams[where])]
            # places that look alike are extended once, so that repeated words do not
            # meet each other in pairs
            first, of = _first_of_each(row[where], _contexts(words.hash, row, where, size))
            one = where[first]
            left_most, right_most = np.zeros((2, len(one)), np.int64)
            place = np.zeros(n, np.int32)
            place[one] = np.arange(len(one))
            for p, s in _pairs(keys, at, grams, one):
                left, right = _extend(words, row, index, p, s, size, SPAN - size)
                ok = (right >= size) & (left + right >= index.need[index.row[s]])
                p, s, left, right = p[ok], s[ok], left[ok], right[ok]
                np.maximum.at(left_most, place[p], left)
                np.maximum.at(right_most, place[p], right)
                met.append(np.unique(row[p] * len(index.ids) + index.row[s]))
            # all spans from one place hold its gram, so their union is one span
            found = right_most[of] > 0
            np.add.at(edge, (where - left_most[of])[found], 1)
            np.add.at(edge, (where + right_most[of])[found], -1)
        hit = np.concatenate([[0], np.cumsum(edge[:-1]) > 0, [0]]).astype(np.int8)
        begins = hit[1:-1] & ~hit[:-2] & 1
        stops = hit[1:-1] & ~hit[2:] & 1
        cut = words.first[1:-1]
        cut = cut[(cut > 0) & (cut < n)]
        begins[cut] |= hit[1:-1][cut]  # a span ends where its text ends
        stops[cut - 1] |= hit[1:-1][cut - 1]
        b, e = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        n_words.append(words.counts())
        spans_n.append(np.bincount(row[b], minlength=rows))
        spans_at.append(b - words.first[row[b]])
        spans_len.append(e - b)
        pair = np.unique(np.concatenate(met)) if met else np.zeros(0, np.int64)
        r, k = np.divmod(pair, max(1, len(index.ids)))
        items_n.append(np.bincount(r, minlength=rows))
        items.extend(index.ids[k])

    def flat(x):
        return np.concatenate(x).astype(np.int32) if x else np.zeros(0, np.int32)

    def ends(x):
        return pa.array(np.concatenate([[0], np.cumsum(flat(x))]), pa.int32())

    span = pa.StructArray.from_arrays([pa.array(flat(spans_at)), pa.array(flat(spans_len))],
                                      ["first", "words"])
    return pa.StructArray.from_arrays(
        [pa.array(flat(n_words)), pa.ListArray.from_arrays(ends(spans_n), span),
         pa.ListArray.from_arrays(ends(items_n), pa.array(items, pa.string()))],
        ["n_words", "spans", "items"])


FOUND = "n_words int, spans array<struct<first:int, words:int>>, items array<string>"


def _finder(spark, items: list[tuple[str | None, bytes]]):
    shared = spark.sparkContext.broadcast(build_index(items))

    @F.arrow_udf(f"struct<{FOUND}>")
    def find(texts: pa.Array) -> pa.Array:
        return scan(texts, shared.value)
    return find


def find_benchmark(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
                   item_text: str = "text", index_bytes: int = INDEX_BYTES) -> DataFrame:
    """One row per document: the struct ``_row`` (all its columns), ``n_words``,
    ``n_hit``, ``spans`` (runs of hit words: first word, words), ``items``
    (identifiers, as text and sorted, of the items that have an occurring window) and
    ``n_items`` (their number).

    A window is SPAN consecutive words of an item, or all words of a shorter one;
    a word is hit if it lies in an occurrence of a window.  Null and empty texts
    have no words; items without words have no window.  Items with a null
    identifier hit words as all others do; they are not in the list ``items``, and
    all of them together count as one in ``n_items``.  Rows with one identifier
    count as one item.  An empty benchmark hits nothing; an empty table gives an empty result.  Columns
    of any name may be carried: they stay inside ``_row``.
    """
    spark = prepare(docs.sparkSession)
    own = items.select(F.col(f"`{item_id}`").cast("string").alias("i"),
                       F.encode(F.coalesce(F.col(f"`{item_text}`"), F.lit("")), "UTF-8").alias("t")
                       ).distinct()
    size = own.agg(F.coalesce(F.sum(F.length("t") + 64), F.lit(0))).first()[0]
    blocks = max(1, -(-size // index_bytes))
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    for b in range(blocks):
        block = own if blocks == 1 else own.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == b)
        # at most index_bytes, by the check above (or one block's share of them)
        find = _finder(spark, [(r.i, bytes(r.t)) for r in block.collect()])
        out = out.withColumn(f"found_{b}", find(F.col(f"_row.`{text}`")))
        if b:
            out = out.withColumn("found_0", F.struct(
                F.col("found_0.n_words").alias("n_words"),
                F.concat("found_0.spans", f"found_{b}.spans").alias("spans"),
                F.array_distinct(F.concat("found_0.items", f"found_{b}.items")).alias("items"))
            ).drop(f"found_{b}")
        if blocks > 1:
            out = materialize(out, "benchmark-block")
    spans = F.col("found_0.spans")
    words = F.size(F.array_distinct(F.flatten(F.transform(
        spans, lambda s: F.sequence(s["first"], s["first"] + s["words"] - 1))))) if blocks > 1 else (
        F.aggregate(spans, F.lit(0), lambda n, s: n + s["words"]))
    # a block too may hold one identifier with several texts
    named = F.array_distinct(F.filter("found_0.items", lambda i: i.isNotNull()))
    unnamed = F.exists("found_0.items", lambda i: i.isNull())
    return out.select("_row", F.col("found_0.n_words").cast("long").alias("n_words"),
                      words.cast("long").alias("n_hit"), spans.alias("spans"),
                      F.array_sort(named).alias("items"),
                      (F.size(named) + unnamed.cast("int")).cast("long").alias("n_items"))


def contaminated(n_words: Column, n_hit: Column) -> Column:
    """At least a twentieth of the words, and one, is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)
