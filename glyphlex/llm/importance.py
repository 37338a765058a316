"""Importance resampling of documents towards a target distribution.

Features are the runs of 1 to ``n`` consecutive words of a text, hashed into a fixed
number of buckets by CRC-32.  A 256-byte table lower-cases A-Z and blanks every byte
that is in no word, so ``bytes.split`` yields the words; the CRC of a longer run goes
on from that of the shorter one.  A bucket's gain is the logarithm of how much more
often the target holds it; a document's weight is the mean gain of its features.
Gumbel noise from the identifier is added, and the highest sums are drawn.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import dense_index
from .common import materialize, packed, prepare

#: Digits, letters and all bytes of other scripts are in words.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256))
#: Gain, noise and score are whole thousandths.
SCALE = 1000
#: Text bytes that are split at once; a longer text is taken in pieces.
PIECE_BYTES = 1 << 20


def pieces(raw: bytes, size: int = PIECE_BYTES) -> Iterator[list[bytes]]:
    """Words of a text, about ``size`` bytes at a time, never cutting a word."""
    at = 0
    while at < len(raw):
        part = raw[at:at + size].translate(WORD_BYTES)
        if at + size < len(raw) and not part.endswith(b" "):
            end = part.rfind(b" ") + 1
            if not end:  # one long word: up to its end, wherever that is
                size *= 2
                continue
            part = part[:end]
        yield part.split()
        at += len(part)


def feature_crcs(raw: bytes, n: int) -> Iterator[tuple[int, list[int]]]:
    """(run length, CRC-32 values) of all features of a text, repeats included."""
    before: list[bytes] = []
    for words in pieces(raw):
        own = before + words
        crcs = list(map(crc32, own))
        yield 1, crcs[len(before):]
        if n > 1:
            spaced = [b" " + w for w in own]
            for k in range(2, n + 1):
                crcs = list(map(crc32, spaced[k - 1:], crcs))
                yield k, crcs[max(0, len(before) - k + 1):]
            before = own[-(n - 1):]


def _bytes_of(texts: pa.Array) -> Iterator[bytes]:
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    for t in texts.cast(pa.binary() if pa.types.is_string(texts.type) else pa.large_binary()):
        b = t.as_buffer()
        yield b.to_pybytes() if b is not None else b""


def bucket_counts(texts: DataFrame, text: str, n: int, buckets: int) -> np.ndarray:
    """Features of all texts in each bucket.  A task holds one counter of at most
    ``buckets`` entries; as many rows reach the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for raw in _bytes_of(batch.column(0)):
                for _, crcs in feature_crcs(raw, n):
                    total.update([c % buckets for c in crcs])
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int32()), pa.array(list(total.values()), pa.int64())], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in (texts.select(F.col(f"`{text}`")).mapInArrow(count, "bucket int, n long")
              .groupBy("bucket").agg(F.sum("n").alias("n")).collect()):
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket in whole thousandths, rounded down; one is added to every
    count."""
    b = len(source)
    s_all, t_all = int(source.sum()), int(target.sum())
    return np.array([
        math.floor(SCALE * math.log((t + 1) * (s_all + b) / ((s + 1) * (t_all + b))))
        for s, t in zip(source.tolist(), target.tolist())], np.int64)


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise of an identifier (null: as an empty one) in whole thousandths."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-float(SCALE)) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def weigh(docs: DataFrame, gain: np.ndarray, text: str = "text", n: int = 1) -> DataFrame:
    """The struct ``_row`` (all columns), ``n_words``, ``n_features`` and ``weight``:
    the mean gain of a whole text's features, rounded down (none: 0)."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(gain.tolist())  # one number a bucket

    @F.arrow_udf("struct<n_words:bigint,n_features:bigint,weight:bigint>")
    def weights(texts: pa.Array) -> pa.Array:
        gain = shared.value
        rows = []
        for raw in _bytes_of(texts):
            words = features = total = 0
            for k, crcs in feature_crcs(raw, n):
                words += len(crcs) if k == 1 else 0
                features += len(crcs)
                total += sum([gain[c % len(gain)] for c in crcs])
            rows.append((words, features, total // features if features else 0))
        return pa.StructArray.from_arrays(
            [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)],
            ["n_words", "n_features", "weight"])

    return docs.select(packed(docs), weights(F.col(f"`{text}`")).alias("w")).select("_row", "w.*")


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20,
             n: int = 1, buckets: int = 10000, seed: int = 2024, text: str = "text",
             doc_id: str = "doc_id", target_text: str = "text") -> DataFrame:
    """Draw ``percent`` of the documents of at least ``least_words`` words, without
    replacement, in favour of those that look like ``target``.

    One row for every document: ``_row`` (all columns), ``n_words``, ``n_features``,
    ``weight``, ``score`` (weight plus noise) and ``rank`` (from 1, by falling score,
    then by identifier; null if not drawn).  A null text has no words; a null
    identifier counts as an empty one and comes last among equal scores.  Rows with
    the same identifier and text tie, and are drawn in any order.  An empty target
    counts nothing in every bucket; an empty table gives an empty result.  Columns
    of any name may be carried: they stay inside ``_row``.

    The scored rows are written once to the shared checkpoint folder.  The border
    between drawn and not is read from a count by score (whole numbers between two
    logarithms: the driver holds some ten thousand rows, whatever the corpus); only
    rows from the border up are sorted, by ranges that ties can't make unequal.
    """
    gain = gains(bucket_counts(docs, text, n, buckets),
                 bucket_counts(target, target_text, n, buckets))
    ident = F.col(f"_row.`{doc_id}`")
    scored = materialize(
        weigh(docs, gain, text, n)
        .withColumn("score", F.col("weight") + noise(ident, seed))
        .withColumn("at", F.monotonically_increasing_id()), "scored")
    fit = F.col("n_words") >= least_words
    by_score = sorted(((r.score, r.n) for r in scored.where(fit).groupBy("score").agg(
        F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    wanted = sum(k for _, k in by_score) * percent // 100
    border, above = None, 0
    for s, k in by_score:
        if above >= wanted:
            break
        border, above = s, above + k
    cols = ["_row", "n_words", "n_features", "weight", "score", "rank"]
    if border is None:
        return scored.withColumn("rank", F.lit(None).cast("long")).select(*cols)
    near = fit & (F.col("score") >= border)
    drawn = dense_index(scored.where(near), [F.desc("score"), ident.asc_nulls_last(), F.col("at")],
                        "place", small_rows=0)
    drawn = drawn.withColumn("rank", F.when(F.col("place") < wanted, F.col("place") + 1))
    rest = scored.where(~near).withColumn("rank", F.lit(None).cast("long"))
    return drawn.select(*cols).unionByName(rest.select(*cols))
