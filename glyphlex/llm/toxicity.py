"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; all other text is unlabelled, toxic or
not.  A linear classifier in numpy minimises the risk that is corrected by the
class prior p:

    p * R(positives as toxic) + max(0, R(unlabelled as clean) - p * R(positives as clean))

where the second term can't fall below zero, so the classifier does not learn
the positives by heart.  Features are words and their first bytes; the ones that
positives hold more often than unlabelled texts are counted and chosen by Spark.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, prepare
from .labelled import at_most, held_out, labels_of, one_text
from .wordarrays import NOT_ALNUM, Words, member, mix, text_blocks

#: Lengths in bytes of the word starts that are features besides whole words.
STARTS = (4, 5, 6, 7, 8)
#: Rows of each kind to learn from, and features, at most.
MAX_POSITIVE, MAX_UNLABELLED, MAX_FEATURES = 6000, 12000, 4096
#: A feature must be in so many positives, and stand out by so many deviations.
LEAST_POSITIVES, DEVIATIONS = 4, 5.0
STEPS, RATE, RIDGE = 400, 0.05, 0.1
#: Text bytes whose features a worker holds at once.
BLOCK_BYTES = 1 << 18


def features(words: Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """(word numbers, digests): whole words, and the starts of longer ones."""
    out = [(np.arange(len(words.hash)), words.hash)]
    size = words.end - words.start
    for k in STARTS:
        longer = np.flatnonzero(size > k)
        out.append((longer, words.prefix(longer, k)))
    return out


def distinct_features(texts: pa.Array) -> pa.Array:
    """The different features of each text, as longs."""
    sizes, values = [], []
    for _, offsets, raw in text_blocks(texts, BLOCK_BYTES):
        words = Words(offsets, raw, NOT_ALNUM)
        rows = len(offsets) - 1
        row = np.repeat(np.arange(rows), words.counts())
        at, h = (np.concatenate(x) for x in zip(*features(words)))
        order = np.lexsort((h, row[at]))
        r, h = row[at][order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
        sizes.append(np.bincount(r[new], minlength=rows))
        values.append(h[new])
    flat = np.concatenate(values) if values else np.zeros(0, np.uint64)
    ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]) if sizes else np.zeros(1)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64)))


def chosen_counts(texts: pa.Array, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature number, times) of the features in the sorted ``keys``, and the
    number of words of each row."""
    rows_, cols_, n_, words_ = [], [], [], []
    for first, offsets, raw in text_blocks(texts, BLOCK_BYTES):
        words = Words(offsets, raw, NOT_ALNUM)
        row = np.repeat(np.arange(len(offsets) - 1), words.counts())
        words_.append(words.counts())
        cell = []
        for at, h in features(words):
            own = np.flatnonzero(member(keys, h))
            cell.append(row[at[own]] * len(keys) + np.searchsorted(keys, h[own]))
        cell, n = np.unique(np.concatenate(cell), return_counts=True)
        r, c = np.divmod(cell, max(1, len(keys)))
        rows_.append(r + first)
        cols_.append(c)
        n_.append(n)

    def flat(x):
        return np.concatenate(x) if x else np.zeros(0, np.int64)
    return flat(rows_), flat(cols_), flat(n_), flat(words_)


def inputs(rows: np.ndarray, cols: np.ndarray, times: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, columns) of the ones in the input matrix of 2 * n columns: a feature
    is there, and it is there more than once."""
    again = times > 1
    return np.concatenate([rows, rows[again]]), np.concatenate([cols, cols[again] + n])


def fit(rows: np.ndarray, cols: np.ndarray, n_rows: int, n_cols: int, positive: np.ndarray,
        prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias by the non-negative risk (logistic loss, Adam, all rows a step)."""
    w, b = np.zeros(n_cols), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(n_cols + 1), np.zeros(n_cols + 1)
    n_p, n_u = max(1, positive.sum()), max(1, (~positive).sum())
    for t in range(1, STEPS + 1):
        z = np.bincount(rows, w[cols], n_rows) + b
        s = 1 / (1 + np.exp(-np.clip(z, -30, 30)))  # slope of the loss as clean; s - 1 as toxic
        clean = np.logaddexp(0, z)
        rest = clean[~positive].mean() - prior * clean[positive].mean() 
        grow = np.where(positive, -prior * s / n_p, s / n_u)
        # a negative remainder means that positives are learnt by heart: step back on it
        slope = (-grow if rest < 0 else grow + np.where(positive, prior * (s - 1) / n_p, 0))
        g = np.append(np.bincount(cols, slope[rows], n_cols) + RIDGE * w / max(1, n_cols), slope.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, b


class Model:
    """Chosen features (sorted digests), their weights, and the bias."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray, bias: float):
        self.keys, self.weights, self.bias = keys, weights, bias

    def score(self, texts: pa.Array) -> pa.Array:
        r, c, n, words = chosen_counts(texts, self.keys)
        r, c = inputs(r, c, n, len(self.keys))
        z = self.bias + np.bincount(r, self.weights[c], len(words))
        return pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id",
          label: str = "toxic", label_id: str = "doc_id", max_positive: int = MAX_POSITIVE,
          max_unlabelled: int = MAX_UNLABELLED, prior: float | None = None) -> Model:
    """Learn from at most about ``max_positive`` confirmed texts and
    ``max_unlabelled`` others outside the test fold; of rows with one identifier the
    least text counts.  Without ``prior`` the share
    of positives among the labelled rows is the class prior."""
    marked = labels_of(labels, label_id, label)
    n, n_p = marked.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    if not n_p:
        return Model(np.zeros(0, np.uint64), np.zeros(0), -30.0)
    prior = min(max(n_p / n if prior is None else prior, 1e-4), 0.9)
    ident = docs.select(F.col(f"`{doc_id}`").alias("doc_id"))
    # unlabelled is every text, confirmed ones among them: the risk corrects for that
    others = ident.where("doc_id is not null").where(~held_out(F.col("doc_id")))
    n_u = others.count()
    chosen = at_most(marked.where("y = 1").select("doc_id"), n_p, max_positive).withColumn(
        "positive", F.lit(True)).unionByName(
        at_most(others, n_u, max_unlabelled, 1).distinct().withColumn("positive", F.lit(False)))
    chosen = materialize(chosen, "sample-ids")
    # broadcast: at most about max_positive + max_unlabelled identifiers
    sample = materialize(one_text(
        docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "doc_id"), "doc_id", "positive"), "sample")

    @F.arrow_udf("array<long>")
    def feature_set(texts: pa.Array) -> pa.Array:
        return distinct_features(texts)

    kinds = sample.groupBy("positive").count().collect()
    have = {r["positive"]: r["count"] for r in kinds}
    a, b = have.get(True, 0), have.get(False, 0)
    if not a:
        return Model(np.zeros(0, np.uint64), np.zeros(0), -30.0)
    p_rate, u_rate = F.col("p") / a, (F.col("u") + 0.5) / (b + 1)
    least = max(LEAST_POSITIVES, a // 500)
    stands_out = (p_rate - u_rate) / F.sqrt(u_rate / a + 1e-12)
    found = (sample.select("positive", F.explode(feature_set("text")).alias("f"))
             .groupBy("f").agg(F.count(F.when(F.col("positive"), 1)).alias("p"),
                               F.count(F.when(~F.col("positive"), 1)).alias("u"))
             .where(F.col("p") >= least).withColumn("z", stands_out)
             .where(F.col("z") >= DEVIATIONS).orderBy(F.desc("z"), "f").limit(MAX_FEATURES).collect())
    keys = np.sort(np.array([r.f for r in found], np.int64).view(np.uint64))

    @F.arrow_udf("struct<cols:array<int>,times:array<int>>")
    def chosen_features(texts: pa.Array) -> pa.Array:
        r, c, times, words = chosen_counts(texts, keys)
        ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(r, minlength=len(words)))]), pa.int32())
        return pa.StructArray.from_arrays(
            [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in (c, times)],
            ["cols", "times"])

    got = sample.select("doc_id", "positive", chosen_features("text").alias("x")).orderBy("doc_id").collect()
    positive = np.array([r.positive for r in got], bool)
    sizes = np.array([len(r.x["cols"]) for r in got], np.int64)
    cols = np.array([c for r in got for c in r.x["cols"]], np.int64)
    times = np.array([c for r in got for c in r.x["times"]], np.int64)
    rows, cols = inputs(np.repeat(np.arange(len(got)), sizes), cols, times, len(keys))
    w, bias = fit(rows, cols, len(got), 2 * len(keys), positive, prior)
    return Model(keys, w, bias)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The struct ``_row`` (all columns) and ``score`` (0 to 1) of every whole text.

    Null and empty texts have no features and get the score of the bias alone.
    An empty table gives an empty result; columns of any name are carried inside
    ``_row``."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        return shared.value.score(texts)
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       scores(F.col(f"`{text}`")).alias("score"))
