"""Quality scores by compression.

One zstandard dictionary is built from labelled good text and one from labelled
bad text.  Every whole text is compressed with both; the difference of the two
sizes, as a share of the text and of the compressed sizes, becomes a calibrated
score by a logistic curve, fitted to labelled texts that are in neither dictionary.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, prepare
from .labelled import at_most, labels_of, one_text, spread

#: Labelled rows of each kind for a dictionary, and for the calibration, at most.
MAX_DICTIONARY, MAX_CALIBRATION = 1500, 4000
#: Bytes of the texts of one kind that a dictionary is built from, at most.
MAX_TEXT_BYTES = 16 << 20
#: Bytes of a dictionary, and the compression level.
DICTIONARY_BYTES, LEVEL = 112640, 3
#: Bytes of a block that is compressed by itself.
BLOCK = 512
RIDGE = 1e-3


def build_dictionary(texts: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary; few texts are a dictionary as they are."""
    texts = [t for t in texts if t]
    if sum(map(len, texts)) > 10 * size and len(texts) >= 100:
        try:
            return zstandard.train_dictionary(size, texts).as_bytes()
        except zstandard.ZstdError:
            pass  # texts that the trainer finds nothing in
    return b"".join(texts)[-size:]


class Sizer:
    """Compressed sizes with the good and with the bad dictionary."""

    def __init__(self, good: bytes, bad: bytes):
        self.compressors = []
        for d in (good, bad):
            own = zstandard.ZstdCompressionDict(d)
            if d:
                own.precompute_compress(level=LEVEL)
            self.compressors.append(zstandard.ZstdCompressor(
                level=LEVEL, dict_data=own if d else None, write_content_size=False,
                write_checksum=False, write_dict_id=False))

    def features(self, texts: pa.Array) -> np.ndarray:
        """One row a text; null counts as empty.  A text is compressed as a whole,
        and once more in blocks, where only the dictionaries can help."""
        good, bad = self.compressors
        rows = []
        for t in texts.cast(pa.large_binary()):
            raw = t.as_buffer()
            raw = memoryview(raw) if raw is not None else memoryview(b"")
            n = len(raw)
            g, b = len(good.compress(raw)), len(bad.compress(raw))
            block_g = block_b = better = 0
            blocks = range(0, n, BLOCK)
            for at in blocks:
                part = raw[at:at + BLOCK]
                x, y = len(good.compress(part)), len(bad.compress(part))
                block_g += x
                block_b += y
                better += x < y
            rows.append((n, g, b, block_g, block_b, better / max(1, len(blocks))))
        n, g, b, block_g, block_b, better = np.array(rows, float).reshape(-1, 6).T
        lead = (block_b - block_g) / (block_b + block_g + 16)
        return np.column_stack([(b - g) / (n + 16), (b - g) / (b + g), lead, np.abs(lead), better,
                                lead * np.log(n + 16)])


#: Features of a text.
WIDTH = 6


class Model:
    """Dictionaries, scales of the features, and the curve."""

    def __init__(self, good: bytes, bad: bytes):
        self.good, self.bad = good, bad
        self.mean = self.scale = self.weights = None
        self._sizer: Sizer | None = None

    def __getstate__(self):
        return self.__dict__ | {"_sizer": None}

    def features(self, texts: pa.Array) -> np.ndarray:
        if self._sizer is None:
            self._sizer = Sizer(self.good, self.bad)
        return self._sizer.features(texts)

    def calibrate(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        """Logistic fit by Newton steps with a small ridge."""
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        a = np.column_stack([np.ones(len(x)), np.clip((x - self.mean) / self.scale, -5, 5)])
        w = np.zeros(a.shape[1])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            ridge = np.append(0, np.full(len(w) - 1, RIDGE)) * weight.sum() / 10
            g = a.T @ (weight * (p - y)) + ridge * w
            h = (a * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ a + np.diag(ridge + 1e-9)
            step = np.linalg.solve(h, g)
            w = w - step / max(1.0, np.abs(step).max() / 2)
            if np.abs(step).max() < 1e-8:
                break
        self.weights = w

    def score(self, texts: pa.Array) -> np.ndarray:
        x = self.features(texts)
        a = np.column_stack([np.ones(len(x)), np.clip((x - self.mean) / self.scale, -5, 5)])
        return 1 / (1 + np.exp(-np.clip(a @ self.weights, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id",
          label: str = "quality", label_id: str = "doc_id", max_dictionary: int = MAX_DICTIONARY,
          max_calibration: int = MAX_CALIBRATION, max_text_bytes: int = MAX_TEXT_BYTES) -> Model:
    """Learn from labelled rows outside the test fold: by identifier, one half
    serves the dictionaries and the other the calibration, each at most about so
    many rows of each kind as the parameters say.  Of rows with one identifier the
    least text counts.  Texts for a dictionary reach the driver, of each kind at
    most ``max_text_bytes``: in the order of identifiers, a text that would exceed
    them is left out."""
    prepare(docs.sparkSession)
    marked = labels_of(labels, label_id, label).withColumn("half", spread(F.col("doc_id"), 7) % 2)
    counts = {(r["y"], r["half"]): r["n"] for r in marked.groupBy("y", "half").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    parts = [at_most(marked.where((F.col("y") == y) & (F.col("half") == half)), n,
                     max_calibration if half else max_dictionary)
             for (y, half), n in sorted(counts.items())]
    if not parts:
        model = Model(b"", b"")
        model.calibrate(np.zeros((1, WIDTH)), np.array([0.5]), np.ones(1))
        return model
    chosen = parts[0]
    for p in parts[1:]:
        chosen = chosen.unionByName(p)
    # broadcast: at most about two times max_dictionary + max_calibration identifiers
    sample = materialize(one_text(
        docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
        .join(F.broadcast(materialize(chosen, "sample-ids")), "doc_id"), "doc_id", "y", "half"), "sample")
    room, taken = {0: max_text_bytes, 1: max_text_bytes}, []
    for r in sample.where("half = 0").select("doc_id", "y", F.octet_length("text").alias("n")).orderBy("doc_id").collect():
        if r.n <= room[r.y]:
            room[r.y] -= r.n
            taken.append(r.doc_id)
    own = sample.where((F.col("half") == 0) & F.col("doc_id").isin(taken)).orderBy("doc_id").collect()
    model = Model(*(build_dictionary([(r.text or "").encode() for r in own if r.y == y]) for y in (1, 0)))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("array<double>")
    def features(texts: pa.Array) -> pa.Array:
        return pa.array(list(shared.value.features(texts)), pa.list_(pa.float64()))

    got = sample.where("half = 1").select("doc_id", "y", features("text").alias("x")).orderBy("doc_id").collect()
    if not got:
        model.calibrate(np.zeros((1, WIDTH)), np.array([0.5]), np.ones(1))
        return model
    y = np.array([r.y for r in got], float)
    # kinds keep their share among labelled rows, whatever the sample took of them
    share = {k: sum(n for (c, _), n in counts.items() if c == k) / max(1, (y == k).sum()) for k in (0, 1)}
    model.calibrate(np.array([r.x for r in got]), y, np.where(y == 1, share[1], share[0]))
    return model


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The struct ``_row`` (all columns) and ``score`` (0 to 1, higher for good text)
    of every whole text.

    Null and empty texts get the score of an empty text.  An empty table gives an
    empty result; columns of any name are carried inside ``_row``."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        return pa.array(shared.value.score(texts))
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       scores(F.col(f"`{text}`")).alias("score"))
