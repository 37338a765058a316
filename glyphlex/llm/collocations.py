"""Phrase collocations, counted in quotient filters.

Words are known by 64-bit numbers told from their language and bytes, and checked
against the table of all words to be different for different words (else another
seed is taken).  A phrase packs its words' numbers.  Its key is that packed number
under an invertible permutation: the first bits (the quotient) say where the counter
stands, all other bits (the remainder) are kept in full, so a counter is never shared
and the phrase can be read back.  Every task fills a filter of its own; filters are
cut by quotient, and the sorted pieces of all tasks are merged, one range of
quotients at a time.

Phrases are counted by length.  A phrase can reach the least count only if its two
longest parts do, so a bit table of those parts, of bounded size, keeps others from
being counted.  The bit table may let rare phrases through, never lose one.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import dense_index
from .common import materialize, prepare

#: A-Z in lower case; a piece ends at each of ``.,;:!?`` and at line ends.
LOWER = bytes(b + 32 if 65 <= b <= 90 else 10 if b in b".,;:!?\n\v\f\r" else b for b in range(256))
_PIECE_END = re.compile(rb"[.,;:!?\n\v\f\r]")
_TOKEN = re.compile(rb"[^ \t\n]+|\n")

#: Text bytes handled at once.
BLOCK_BYTES = 1 << 20
#: Different words, and phrases, that a task counts before it passes them on.
WORDS_HELD, PHRASES_HELD = 200_000, 1 << 20
#: Phrases that one range of quotients holds, about, and bits of a bit table, at most.
RANGE_PHRASES, MOST_BITS = 1 << 20, 27
SEEDS = 32

U64 = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit numbers."""
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U64(32))) * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def _unmix(x: np.ndarray) -> np.ndarray:
    back = U64(pow(0xD6E8FEB86659FD93, -1, 1 << 64))
    x = (x ^ (x >> U64(32))) * back
    x = (x ^ (x >> U64(32))) * back
    return x ^ (x >> U64(32))


def permute(keys: list[np.ndarray]) -> list[np.ndarray]:
    """Permutation of packed numbers of len(keys) * 64 bits; every bit of the first
    word depends on all words."""
    keys = [_mix(keys[0]), *keys[1:]]
    for j in range(1, len(keys)):
        keys[j] = keys[j] ^ _mix(keys[j - 1] + U64(j))
    if len(keys) > 1:
        keys[0] = keys[0] ^ _mix(keys[-1])
    return keys


def restore(keys: list[np.ndarray]) -> list[np.ndarray]:
    """Inverse of ``permute``."""
    keys = list(keys)
    if len(keys) > 1:
        keys[0] = keys[0] ^ _mix(keys[-1])
    for j in range(len(keys) - 1, 0, -1):
        keys[j] = keys[j] ^ _mix(keys[j - 1] + U64(j))
    keys[0] = _unmix(keys[0])
    return keys


class QuotientFilter:
    """Exact counters, sorted by permuted key."""

    def __init__(self, keys: list[np.ndarray], counts: np.ndarray):
        """``keys`` are permuted and may repeat; counts of equal keys are added."""
        order = np.lexsort(keys[::-1])
        keys = [k[order] for k in keys]
        new = np.ones(len(order), bool)
        if len(order):
            new[1:] = False
            for k in keys:
                new[1:] |= k[1:] != k[:-1]
        at = np.flatnonzero(new)
        self.keys = [k[at] for k in keys]
        self.counts = np.add.reduceat(counts[order], at) if len(at) else np.zeros(0, np.int64)

    def __len__(self) -> int:
        return len(self.counts)

    @staticmethod
    def merged(filters: list["QuotientFilter"]) -> "QuotientFilter":
        return QuotientFilter([np.concatenate(k) for k in zip(*(f.keys for f in filters))],
                              np.concatenate([f.counts for f in filters]))

    def pieces(self, range_bits: int, bits: int) -> Iterator[tuple[int, bytes, bytes, bytes, bytes]]:
        """(range, runs, remainders, counts, larger counts), one for each range of
        quotients that is not empty.  ``runs`` holds the number of keys of each
        quotient of the range.  Remainders lack the ``bits`` (a multiple of 8) of the
        quotient.  A count is one byte, or 255 and a number among the larger ones."""
        quotient = (self.keys[0] >> U64(64 - bits)).astype(np.int64)
        rest = np.column_stack(self.keys).astype(">u8").view(np.uint8)[:, bits // 8:]
        inside = bits - range_bits
        of = quotient >> inside
        first = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]])) if len(of) else []
        for a, b in zip(first, [*first[1:], len(of)]):
            n = self.counts[a:b]
            runs = np.bincount(quotient[a:b] & ((1 << inside) - 1), minlength=1 << inside)
            yield (int(of[a]), runs.astype("<u4").tobytes(), rest[a:b].tobytes(),
                   np.minimum(n, 255).astype(np.uint8).tobytes(), n[n >= 255].astype("<i8").tobytes())

    @staticmethod
    def from_piece(of: int, runs: bytes, rest: bytes, small: bytes, large: bytes,
                   length: int, range_bits: int, bits: int) -> "QuotientFilter":
        """Inverse of ``pieces`` for one range."""
        out = object.__new__(QuotientFilter)
        n = np.frombuffer(small, np.uint8).astype(np.int64)
        n[n == 255] = np.frombuffer(large, "<i8")
        inside = bits - range_bits
        quotient = (of << inside) + np.repeat(np.arange(1 << inside), np.frombuffer(runs, "<u4"))
        raw = np.zeros((len(n), 8 * length), np.uint8)
        raw[:, bits // 8:] = np.frombuffer(rest, np.uint8).reshape(len(n), -1)
        keys = raw.view(">u8").astype(U64)
        out.keys = [np.ascontiguousarray(keys[:, j]) for j in range(length)]
        out.keys[0] |= quotient.astype(U64) << U64(64 - bits)
        out.counts = n
        return out


def blocks(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    """(language, bytes) of a batch of (language, text): texts in lower case, pieces
    ended by line feeds, about BLOCK_BYTES at a time.  Null counts as empty."""
    held: dict[str, list[bytes]] = {}
    size: Counter = Counter()
    texts = batch.column(1).cast(pa.large_binary())
    for lang, t in zip(batch.column(0).to_pylist(), texts):
        b = t.as_buffer()
        raw = b.to_pybytes() if b is not None else b""
        at = 0
        while at < len(raw):
            end = _PIECE_END.search(raw, at + BLOCK_BYTES) if len(raw) - at > BLOCK_BYTES else None
            part = raw[at:end.end() if end else len(raw)]
            at += len(part)
            held.setdefault(lang, []).append(part)
            size[lang] += len(part)
            if size[lang] >= BLOCK_BYTES:
                yield lang, b"\n".join(held.pop(lang)).translate(LOWER)
                size[lang] = 0
    for lang, parts in held.items():
        yield lang, b"\n".join(parts).translate(LOWER)


def word_ids(words, lang: str, seed: int) -> list[int]:
    """Numbers of words; a piece's end has number 0."""
    own = xxhash.xxh64_intdigest(lang.encode(), seed)
    digest = xxhash.xxh64_intdigest
    return [0 if w == b"\n" else digest(w, own) for w in words]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _count_words(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    held: dict[str, Counter] = {}

    def out():
        for lang, c in held.items():
            words = list(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(words), pa.string()), pa.array(words, pa.binary()).cast(pa.string()),
                 _signed(np.array(word_ids(words, lang, seed), U64)),
                 pa.array(list(c.values()), pa.int64())], ["lang", "word", "id", "n"])

    for batch in batches:
        for lang, block in blocks(batch):
            c = held.setdefault(lang, Counter())
            c.update(_TOKEN.findall(block))
            del c[b"\n"]
            if sum(map(len, held.values())) > WORDS_HELD:
                yield from out()
                held = {}
    yield from out()


def word_table(texts: DataFrame) -> tuple[DataFrame, int]:
    """All words of (lang, text): lang, word, id, n; and the seed of their numbers,
    for which no two words share one."""
    for seed in range(SEEDS):
        words = materialize(
            texts.mapInArrow(lambda it, s=seed: _count_words(it, s), "lang string, word string, id long, n long")
            .groupBy("lang", "word", "id").agg(F.sum("n").alias("n")), "words")
        clash = words.groupBy("id").agg(F.count(F.lit(1)).alias("k")).where("k > 1 or id = 0")
        if clash.isEmpty():
            return words, seed
    raise ValueError("no seed keeps the words' numbers apart")


def bit_table(frequent: DataFrame, n: int, length: int) -> np.ndarray:
    """Bits of the permuted keys of ``frequent`` (columns w1 to w<length>): 32 bits a
    key, 2**MOST_BITS at most, which bounds what reaches the driver and is broadcast."""
    bits = min(MOST_BITS, max(16, (32 * max(1, n)).bit_length()))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [batch.column(j).to_numpy().view(U64) for j in range(length)]
            at = (permute(keys)[0] >> U64(64 - bits)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(at >> 6), _signed(U64(1) << (at & 63).astype(U64))], ["at", "bit"])

    got = (frequent.select(*[f"w{j + 1}" for j in range(length)]).mapInArrow(places, "at long, bit long")
           .groupBy("at").agg(F.bit_or("bit").alias("bit")).toArrow())
    table = np.zeros(1 << (bits - 6), U64)
    table[got["at"].to_numpy()] = got["bit"].to_numpy().view(U64)
    return table


def in_table(table: np.ndarray, first_key: np.ndarray) -> np.ndarray:
    """Whether the bits of permuted keys (their first words) are set."""
    at = (first_key >> U64(65 - (64 * len(table)).bit_length())).astype(np.int64)
    return (table[at >> 6] >> (at & 63).astype(U64)) & U64(1) != 0


PIECES = "part int, runs binary, rest binary, small binary, large binary"


def _count_phrases(batches: Iterator[pa.RecordBatch], seed: int, length: int, table: np.ndarray,
                   range_bits: int, bits: int) -> Iterator[pa.RecordBatch]:
    """(lang, text) -> pieces of filters of the phrases of ``length`` words both of
    whose longest parts are in the bit table."""
    held: list[list[np.ndarray]] = []
    size = 0

    def out(f: QuotientFilter):
        rows = list(f.pieces(range_bits, bits))
        for k in range(0, len(rows), 64):
            yield pa.RecordBatch.from_pydict(
                dict(zip(["part", "runs", "rest", "small", "large"], zip(*rows[k:k + 64]))),
                schema=pa.schema([("part", pa.int32())] + [(c, pa.binary()) for c in
                                                           ("runs", "rest", "small", "large")]))

    def filled() -> QuotientFilter:
        keys = [np.concatenate(k) for k in zip(*held)]
        return QuotientFilter(keys, np.ones(len(keys[0]), np.int64))

    done: list[QuotientFilter] = []
    for batch in batches:
        for lang, block in blocks(batch):
            tokens = _TOKEN.findall(block)
            own = list(set(tokens))
            number = dict(zip(own, word_ids(own, lang, seed)))
            x = np.fromiter(map(number.__getitem__, tokens), U64, len(tokens))
            n = len(x) - length + 1
            if n <= 0:
                continue
            part = [x[j:j + n + 1] for j in range(length - 1)]  # the two parts: at i and at i + 1
            good = in_table(table, permute(part)[0])
            for p in part:
                good &= p != 0
            at = np.flatnonzero(good[:-1] & good[1:])
            held.append(permute([x[at + j] for j in range(length)]))
            size += len(at)
            if size >= PHRASES_HELD:
                done.append(filled())
                held, size = [], 0
                if sum(map(len, done)) >= PHRASES_HELD:
                    done = [QuotientFilter.merged(done)]
                    if len(done[0]) >= PHRASES_HELD // 2:
                        yield from out(done.pop())
    if held:
        done.append(filled())
    if done:
        yield from out(QuotientFilter.merged(done))


def count_phrases(texts: DataFrame, seed: int, shorter: DataFrame, n_shorter: int, length: int,
                  n_words: int, least: int) -> DataFrame:
    """Phrases of ``length`` words that occur ``least`` times or more: w1 to
    w<length> and n.  ``shorter`` holds those of one word less."""
    spark = texts.sparkSession
    n_shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # ranges by the number of word occurrences, which no count of phrases exceeds
    range_bits = max(4, (max(n_shuffle, n_words // RANGE_PHRASES) - 1).bit_length())
    bits = 8 * max(2, -(-(range_bits + 4) // 8))
    table = spark.sparkContext.broadcast(bit_table(shorter, n_shorter, length - 1))
    parts = texts.mapInArrow(
        lambda it: _count_phrases(it, seed, length, table.value, range_bits, bits), PIECES)

    def merge(rows):  # the pieces of one range, from all tasks
        f = QuotientFilter.merged([
            QuotientFilter.from_piece(r["part"], r["runs"], r["rest"], r["small"], r["large"], length,
                                      range_bits, bits) for r in rows.to_pylist()])
        keep = f.counts >= least
        return pa.Table.from_arrays(
            [*[_signed(k) for k in restore([k[keep] for k in f.keys])], pa.array(f.counts[keep])],
            [*names, "n"])

    names = [f"w{j + 1}" for j in range(length)]
    return materialize(parts.groupBy("part").applyInArrow(
        merge, ", ".join(f"{c} long" for c in [*names, "n"])), f"phrases-{length}")


def cut_score(a: Column, left: Column, right: Column) -> Column:
    """floor(1,000,000 * a * a / (left * right)) in whole numbers of 38 digits."""
    whole = [c.cast("decimal(19,0)") for c in (a, left, right)]
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * whole[0] * whole[0],
                           whole[1] * whole[2])


def collocations(docs: DataFrame, most_words: int = 3, least: int = 10, within: int = 50,
                 top: int = 2000, text: str = "text", lang: str = "lang") -> DataFrame:
    """The ``top`` phrases of 2 to ``most_words`` words of each language: lang, rank,
    phrase, a (its occurrences), l and r (of the two parts of its lowest-scoring cut),
    n (all word occurrences of the language) and score.

    A phrase of fewer than ``least`` occurrences is no candidate, nor is one that lies
    inside a longer candidate with ``within`` per cent or more of its occurrences.  A
    null text has no words; a null language is ``und``.  Equal scores are ranked by
    falling occurrences, then by the phrase's bytes.  Repeated rows count as often as
    they stand there.  An empty table gives an empty result.  Other columns are not
    read, whatever their names.

    Tables of words, of frequent phrases and of scored candidates are written to the
    shared checkpoint folder.  No task holds all of a language: words and phrases are
    dealt by their digests, ranks come from one sort by ranges.
    """
    prepare(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
                        F.col(f"`{text}`").alias("text"))
    words, seed = word_table(texts)
    n_words, n_frequent = words.agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") >= least, 1))).first()
    frequent = {1: words.where(F.col("n") >= least).withColumnRenamed("id", "w1")}
    count = n_frequent
    for k in range(2, most_words + 1):
        frequent[k] = count_phrases(texts, seed, frequent[k - 1], count, k, n_words, least)
        count = frequent[k].count()

    scored = None
    for k in range(2, most_words + 1):
        own = _score(frequent, k, most_words, within)
        scored = own if scored is None else scored.unionByName(own)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    placed = dense_index(scored, ["lang", F.desc("score"), F.desc("a"), "phrase"], "place", small_rows=0)
    first = placed.groupBy("lang").agg(F.min("place").alias("first"))
    return (placed.join(first, "lang").withColumn("rank", F.col("place") - F.col("first") + 1)
            .where(F.col("rank") <= top).join(totals, "lang")
            .select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


def _score(frequent: dict[int, DataFrame], k: int, most_words: int, within: int) -> DataFrame:
    """Candidates of ``k`` words that stay: lang, phrase, a, l, r, score."""
    names = [f"w{j + 1}" for j in range(k)]
    out = frequent[k].withColumnRenamed("n", "a")
    for longer in range(k + 1, most_words + 1):
        parts = frequent[longer].select("n", F.explode(F.array(*[
            F.struct(*[F.col(f"w{i + j + 1}").alias(names[j]) for j in range(k)])
            for i in range(longer - k + 1)])).alias("p"))
        most = parts.groupBy(*[F.col(f"p.{c}").alias(c) for c in names]).agg(F.max("n").alias("most"))
        out = out.join(most, names, "left").where(
            F.col("most").isNull() | (100 * F.col("most") < within * F.col("a"))).drop("most")
    for j in range(k):
        word = frequent[1].select(F.col("w1").alias(f"w{j + 1}"), F.col("word").alias(f"word{j + 1}"),
                                  F.col("n").alias(f"f{j + 1}_{j + 1}"), *(["lang"] if j == 0 else []))
        out = out.join(word, f"w{j + 1}")
    for size in range(2, k):
        for i in (0, k - size):  # the first words of a cut, or the last ones
            part = frequent[size].select(*[F.col(f"w{j + 1}").alias(f"w{i + j + 1}") for j in range(size)],
                                         F.col("n").alias(f"f{i + 1}_{i + size}"))
            out = out.join(part, [f"w{i + j + 1}" for j in range(size)])
    cuts = []
    for c in range(1, k):
        left, right = F.col(f"f1_{c}"), F.col(f"f{c + 1}_{k}")
        cuts.append(F.struct(cut_score(F.col("a"), left, right).alias("score"), F.lit(c).alias("cut"),
                             left.alias("l"), right.alias("r")))
    lowest = F.array_min(F.array(*cuts))
    return (out.withColumn("low", lowest)
            .select("lang", F.concat_ws(" ", *[f"word{j + 1}" for j in range(k)]).alias("phrase"),
                    "a", "low.l", "low.r", "low.score"))
