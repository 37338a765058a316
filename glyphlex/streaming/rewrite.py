"""Structured Streaming form of the stateless rewrites.

The reference has no streams; its per-row rewrites are pure projections, so a
stream needs no state, watermark or window.  The dictionary is read once when
the query is defined, checked for size, and inlined into the expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import substitute as fs
from ..functions.text import normalize_text, remove_spaces
from ..operators.substitute import NATIVE_MAX_KEYS, bounded_entries

STREAM_MAX_KEYS = NATIVE_MAX_KEYS * 16


def rewrite_stream(stream: DataFrame, dictionary: DataFrame, text_col: str = "text",
                   out_col: str = "prediction", mode: str = "fold") -> DataFrame:
    """Add ``out_col`` to a streaming frame.

    ``fold``: normalise, then replace every dictionary key in rank order (E10),
    then drop spaces (the rule-based rewrite).  ``demojize``: normalise, replace
    detected symbols (E8), drop spaces (the model input preparation).
    """
    entries = bounded_entries(dictionary, STREAM_MAX_KEYS)
    if entries is None:
        raise ValueError(f"streaming rewrites inline at most {STREAM_MAX_KEYS} entries")
    norm = normalize_text(text_col)
    if mode == "fold":
        body = fs.fold_replace(norm, entries)
    elif mode == "demojize":
        body = fs.demojize(norm, dict(entries))
    else:
        raise ValueError("mode must be 'fold' or 'demojize'")
    return stream.withColumn(out_col, remove_spaces(body))


def start_rewrite(stream: DataFrame, dictionary: DataFrame, sink_path: str,
                  checkpoint_path: str, text_col: str = "text", mode: str = "fold",
                  trigger_once: bool = False):
    """Start an append-mode parquet sink for ``rewrite_stream`` (exactly-once via
    the checkpoint folder, which must be on shared storage)."""
    out = rewrite_stream(stream, dictionary, text_col=text_col, mode=mode)
    writer = (out.writeStream.format("parquet").option("path", sink_path)
              .option("checkpointLocation", checkpoint_path).outputMode("append"))
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()

