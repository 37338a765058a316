"""Readers and writers.

TSV is read and written with the same explicit options on both sides so that
tabs, quotes, embedded newlines and leading/trailing spaces survive a round
trip (only an empty text comes back as null).  Dictionaries are stored as
parquet ``(key, value, rank)``; the single-object JSON form is an export.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import dense_index

TSV_OPTIONS = {
    "sep": "\t",
    "header": "true",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
PAIR_SCHEMA = "row_id long, raw_text string, source_text string, target_text string"
JSON_EXPORT_MAX_ENTRIES = 5_000_000


def read_tsv(spark: SparkSession, path: str, schema: str, multi_line: bool = True) -> DataFrame:
    """A1: tab-separated text with a header and a fixed schema.

    A file whose texts may hold line breaks is read by one task; ``multi_line=False``
    splits large files.  Keep large tables as parquet.

    Unlike pandas, the literal strings ``NA`` / ``null`` / ``nan`` stay text (this
    is text data); only an empty field reads back as null."""
    return (spark.read.schema(schema).options(**TSV_OPTIONS)
            .option("multiLine", str(multi_line).lower()).csv(path))


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite", by: str | None = None,
              compression: str = "none") -> None:
    """B1: header, no index; the folder's name can carry metadata.  ``by`` is a column that
    becomes folders ``by=value``, all written in one pass.  Files that are compressed with
    ``gzip`` take far less disk and are read by one task each, as those whose texts may
    hold line breaks are anyway."""
    out = df.write.mode(mode).options(**TSV_OPTIONS).option("compression", compression)
    (out.partitionBy(by) if by else out).csv(path)


def read_pairs(spark: SparkSession, path: str, fmt: str = "parquet",
               multi_line: bool = True) -> DataFrame:
    """A2: the raw pair table (row_id, raw_text, source_text, target_text); for a TSV
    ``multi_line`` as in ``read_tsv``."""
    if fmt == "parquet":
        return spark.read.schema(PAIR_SCHEMA).parquet(path)
    return read_tsv(spark, path, PAIR_SCHEMA, multi_line)


def read_annotations(spark: SparkSession, path: str) -> DataFrame:
    """A3: one row per ``<annotation cp type>`` element: (file, doc_pos, cp, type, text).

    ``doc_pos`` orders rows in document order within a file (partitions of one
    file cover increasing offsets)."""
    raw = (spark.read.format("xml").schema("_cp string, _type string, _VALUE string")
           .option("rowTag", "annotation").option("valueTag", "_VALUE").load(path))
    return raw.select(F.col("_metadata.file_path").alias("file"),
                      F.monotonically_increasing_id().alias("doc_pos"),
                      F.col("_cp").alias("cp"), F.col("_type").alias("type"),
                      F.col("_VALUE").alias("text"))


def slice_annotations(annotations: DataFrame, lo: int | None = None,
                      hi: int | None = None) -> DataFrame:
    """A4: half-open positional slice ``[lo, hi)`` in document order, counted anew in
    each file; adds ``pos``."""
    idx = dense_index(annotations, ["file", "doc_pos"], "pos")
    starts = idx.groupBy("file").agg(F.min("pos").alias("_gl_first"))
    idx = idx.join(starts, "file").withColumn("pos", F.col("pos") - F.col("_gl_first")).drop("_gl_first")
    if lo is not None:
        idx = idx.where(F.col("pos") >= lo)
    if hi is not None:
        idx = idx.where(F.col("pos") < hi)
    return idx


def read_dict(spark: SparkSession, path: str, value_type: str = "string") -> DataFrame:
    """A5: a whole-file JSON object -> (key, value, rank) in file order.

    ``value_type`` may be ``array<string>`` for multi-maps."""
    text = spark.read.option("wholetext", "true").text(path)
    parsed = text.select(F.posexplode(F.map_entries(
        F.from_json("value", f"map<string,{value_type}>"))).alias("pos", "e"))
    # a key written twice keeps its first position and its last value
    dedup = (parsed.select(F.col("e.key").alias("key"), F.col("e.value").alias("value"),
                           F.col("pos").cast("long").alias("pos"))
             .groupBy("key").agg(F.max_by("value", "pos").alias("value"),
                                 F.min("pos").alias("first")))
    return dense_index(dedup, ["first"], "rank").select("key", "value", "rank")


def write_dict_json(d: DataFrame, path: str, mode: str = "overwrite") -> None:
    """B2 export: one ordered JSON object (non-ASCII kept).  A single object is
    one row by nature, so the dictionary size is checked first."""
    n = d.limit(JSON_EXPORT_MAX_ENTRIES + 1).count()
    if n > JSON_EXPORT_MAX_ENTRIES:
        raise ValueError("dictionary too large for a single JSON object; keep it as parquet")
    entries = F.array_sort(F.collect_list(F.struct("rank", "key", "value")))
    obj = d.agg(F.to_json(F.map_from_entries(
        F.transform(entries, lambda e: F.struct(e["key"], e["value"])))).alias("value"))
    obj.coalesce(1).write.mode(mode).text(path)


def write_dict(d: DataFrame, path: str, mode: str = "overwrite") -> None:
    """B2 primary form: parquet (key, value, rank)."""
    d.select("key", "value", "rank").write.mode(mode).parquet(path)


def read_candidates(spark: SparkSession, systems: Mapping[str, str],
                    schema: str = "id long, prediction string",
                    multi_line: bool = True) -> DataFrame:
    """One TSV per system, in registration order; the score is the integer after
    ``res`` in the last path component (as in ``res87730`` or ``res=87730``).  ``multi_line`` as
    in ``read_tsv``: without it a large system is read by many tasks."""
    parts = None
    for pos, (system, path) in enumerate(systems.items()):
        part = read_tsv(spark, path, schema, multi_line).select(
            "id", F.lit(system).alias("system"),
            F.regexp_extract(F.col("_metadata.file_path"), r"res=?(\d+)/[^/]*$", 1)
            .cast("int").alias("score"),
            F.lit(pos).alias("sys_pos"), "prediction")
        parts = part if parts is None else parts.unionByName(part)
    return parts


def write_partitioned(df: DataFrame, path: str, column: str, mode: str = "overwrite") -> None:
    """One write, one folder per threshold (``partitionBy``)."""
    df.write.mode(mode).partitionBy(column).parquet(path)
