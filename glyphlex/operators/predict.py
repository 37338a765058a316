"""Batch prediction with a pluggable predictor (K2).

Text preparation (E3, E8, E4) is native; only the predictor runs in Python, inside
``mapInArrow``, on batches of ``batch_size`` texts of like length.  The predictor
object is built once per Python worker from a picklable factory.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.symbols import GRAMMAR, Symbols
from ..functions.text import normalize_text, remove_spaces
from .substitute import demojize

# --- fixed values: options of a text generator, as the jobs hand them over -----
GENERATION_OPTIONS = {"max_length": 100, "num_beams": 10, "do_sample": False, "top_k": 50, "top_p": 1.0,
                      "early_stopping": False, "repetition_penalty": 2.5}
# ---------------------------------------------------------------------------
#: Texts that are ordered by length together before they are cut into batches.
POOL = 4096
#: The worker's model and the call that it belongs to.
_MODEL: list = []


class DictionaryPredictor:
    """A stand-in model: ordered literal replacements on each text of a batch."""

    def __init__(self, entries: Sequence[tuple[str, str]]):
        self.entries = list(entries)

    def __call__(self, texts: list[str], **options) -> list[str]:
        """Options of a text generator mean nothing here."""
        out = []
        for t in texts:
            for k, v in self.entries:
                t = t.replace(k, v)
            out.append(t)
        return out


def _worker_model(key: str, factory: Callable[[], Callable]) -> Callable:
    """The call's model; a worker holds one at a time."""
    if not _MODEL or _MODEL[0] != key:
        _MODEL.clear()
        _MODEL.extend([key, factory()])
    return _MODEL[1]


def length_batches(texts: Sequence[str], batch_size: int) -> list[list[int]]:
    """Positions of the texts in batches of like length, so that a predictor that pads
    to the longest text of a batch pads little."""
    order = sorted(range(len(texts)), key=lambda k: (len(texts[k]), k))
    return [order[k:k + batch_size] for k in range(0, len(order), batch_size)]


def predict_table(df: DataFrame, dictionary: DataFrame, predictor: Callable[..., list[str]]
                  | None = None, batch_size: int = 32, factory: Callable[[], Callable] | None = None,
                  id_col: str = "id", text_col: str = "text", options: Mapping | None = None,
                  pool: int = POOL, symbols: Symbols = GRAMMAR) -> DataFrame:
    """(id, prediction): normalise, demojize and de-space the text, predict in
    batches of ``batch_size`` texts of like length, de-space the output; ids are kept
    as they are.

    ``options`` are handed to the predictor by keyword with every batch
    (``GENERATION_OPTIONS`` has those of the usual generator).  A factory's model is
    built once for each worker and given up for that of a later call.  ``pool`` texts
    are ordered by length at a time, which bounds what a worker holds."""
    if (predictor is None) == (factory is None):
        raise ValueError("give exactly one of predictor or factory")
    prepared = df.select(F.col(id_col).alias("id"), normalize_text(text_col).alias("_gl_t"))
    prepared = demojize(prepared, "_gl_t", dictionary, "_gl_d", row_id="id", symbols=symbols)
    prepared = prepared.select("id", remove_spaces("_gl_d").alias("source"))
    key = uuid.uuid4().hex  # reused workers never answer with an earlier call's model
    kwargs = dict(options or {})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = predictor if factory is None else _worker_model(key, factory)
        for batch in batches:
            for at in range(0, batch.num_rows, pool):
                part = batch.slice(at, pool)
                texts = [t or "" for t in part.column(1).to_pylist()]
                found: list[str | None] = [None] * len(texts)
                for places in length_batches(texts, batch_size):
                    got = model([texts[k] for k in places], **kwargs)
                    if len(got) != len(places):
                        raise ValueError(f"{len(got)} predictions for {len(places)} texts")
                    for k, text in zip(places, got):
                        found[k] = text
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array(found, pa.string())], ["id", "prediction"])

    return prepared.mapInArrow(run, "id long, prediction string").select(
        "id", remove_spaces("prediction").alias("prediction"))
