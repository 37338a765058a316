"""Deterministic test tables derived from the driver's ``documents`` table.

The driver's text holds no symbols, CJK or full-width characters, so symbols
and words are injected with literal ``replace`` calls that DuckDB can repeat
exactly (see ``plans.oracle_fixtures`` for the SQL twins).  Every table here is derived
from the whole ``documents`` table, so its size grows with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.diff import python_partitions

# --- fixed values: injection table (find, source gets, target gets) ----------
INJECTIONS = [
    (" the ", " 🐶 ", " 狗 "),
    (" and ", " 🐱 ", " 猫 "),
    (" la ", " ❤️ ", " 爱 "),
    (" der ", " 🤵‍♂️ ", " 帅哥 "),
    (" le ", " 🏃 ", " 跑步 "),
]
# the alternative word for " and " on rows whose md5(doc_id) starts with 8..f
AMBIGUOUS_WORD = "咪"
# candidate systems: (name, score, registration position)
SYSTEMS = [("s0", 90, 0), ("s1", 80, 1), ("s2", 70, 2), ("s3", 60, 3)]
ROW_ID_STRIDE = 1 << 32
# largest scan task, in even shares of a core, from which the rows are spread
UNEVEN = 1.25
# ---------------------------------------------------------------------------

SYMBOLS = [s for _, s, _ in INJECTIONS]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, pos, row_id, s): whole documents split on '.' and newline; empty pieces left out."""
    # spread the documents, not the sentences: everything computed from the
    # generated sentences (injection, normalisation, symbol filters) sits above
    # the generator, so the optimizer cannot push it back into the scan task
    docs = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return (docs.select("doc_id", F.posexplode(F.split("text", r"[.\n]")).alias("pos", "s"))
            .where(F.length("s") > 0)
            .select("doc_id", F.col("pos").cast("long").alias("pos"),
                    (F.col("doc_id") * ROW_ID_STRIDE + F.col("pos")).alias("row_id"),
                    "s"))


def spread(df: DataFrame, key: str) -> DataFrame:
    """Input-parallelism guard: splits are planned by bytes, but a row group is read by
    one task, so a file of one row group is one task whatever its size.  The rows of
    each scan task are counted (from the file footers, no column is read); where the
    largest task holds clearly more than an even share of a core, rows are
    hash-partitioned on ``key`` and the other columns, so null or repeated keys do
    not meet in one task.  Any other input is left alone (no extra shuffle)."""
    spark = df.sparkSession
    rows = df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"))
    top = rows.agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
    if not top["all"] or top["most"] * spark.sparkContext.defaultParallelism <= UNEVEN * top["all"]:
        return df
    return df.repartition(python_partitions(spark), key, *[c for c in df.columns if c != key])


def _inject(col, column_index: int, ambiguous: bool = False):
    out = col
    for find, src, tgt in INJECTIONS:
        rep = src if column_index == 1 else tgt
        if ambiguous and column_index == 2 and find == " and ":
            rep = F.when(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 1) < "8",
                         F.lit(tgt)).otherwise(F.lit(f" {AMBIGUOUS_WORD} "))
            out = F.replace(out, F.lit(find), rep)
        else:
            out = F.replace(out, F.lit(find), F.lit(rep))
    return out


def pairs(spark: SparkSession, sf_dir: str, ambiguous: bool = False) -> DataFrame:
    """(doc_id, pos, row_id, source_text, target_text)."""
    s = sentences(spark, sf_dir)
    return s.select("doc_id", "pos", "row_id",
                    _inject(F.col("s"), 1).alias("source_text"),
                    _inject(F.col("s"), 2, ambiguous).alias("target_text"))


def raw_pairs(spark: SparkSession, sf_dir: str, p: DataFrame | None = None) -> DataFrame:
    """The M1 raw table: (row_id, raw_text, source_text, target_text).  Here and below
    ``p`` is the table of ``pairs``, for a job that has written it for several uses."""
    p = pairs(spark, sf_dir) if p is None else p
    return p.select("row_id", F.col("source_text").alias("raw_text"),
                    "source_text", "target_text")


def test_table(spark: SparkSession, sf_dir: str, p: DataFrame | None = None) -> DataFrame:
    """The M2 test table: (id, text) = symbol sentences."""
    p = pairs(spark, sf_dir) if p is None else p
    return p.select(F.col("row_id").alias("id"), F.col("source_text").alias("text"))


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, pos, row_id, narrow, wide): ',' and '!' widened on even doc_id."""
    s = sentences(spark, sf_dir)
    even = (F.col("doc_id") % 2) == 0
    widened = F.replace(F.replace(F.col("s"), F.lit(","), F.lit("，")),
                        F.lit("!"), F.lit("！"))
    return s.select("doc_id", "pos", "row_id", F.col("s").alias("narrow"),
                    F.when(even, widened).otherwise(F.col("s")).alias("wide"))


def candidates(spark: SparkSession, sf_dir: str, p: DataFrame | None = None) -> DataFrame:
    """Long candidate table (id, system, score, sys_pos, prediction)."""
    p = pairs(spark, sf_dir) if p is None else p
    systems = F.array(*[F.struct(F.lit(n).alias("system"), F.lit(sc).alias("score"),
                                 F.lit(sp).alias("sys_pos")) for n, sc, sp in SYSTEMS])
    c = p.select("doc_id", "pos", "row_id", "source_text", "target_text",
                 F.explode(systems).alias("sys"))
    h = F.substring(F.md5(F.concat_ws("|", F.col("doc_id").cast("string"),
                                      F.col("pos").cast("string"), F.col("sys.system"))), 1, 1)
    t = F.col("target_text")
    pred = (F.when(h.isin("a", "b"), F.replace(t, F.lit("狗"), F.lit("猫")))
            .when(h.isin("c", "d"), F.replace(t, F.lit("狗"), F.lit("")))
            .when(h.isin("e", "f"), F.col("source_text"))
            .otherwise(t))
    return c.select(F.col("row_id").alias("id"), F.col("sys.system").alias("system"),
                    F.col("sys.score").alias("score"), F.col("sys.sys_pos").alias("sys_pos"),
                    pred.alias("prediction"))


def reconcile_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, raw, rule, model) for the reconcile job."""
    p = pairs(spark, sf_dir)
    t = F.col("target_text")
    model = (F.when(F.instr(t, "猫") > 0, F.replace(t, F.lit("猫"), F.lit("")))
             .when(F.col("source_text") == t, F.concat(t, F.lit("！")))
             .otherwise(t))
    return p.select(F.col("row_id").alias("id"),
                    F.replace(F.col("source_text"), F.lit("🐱"), F.lit("猫")).alias("raw"),
                    t.alias("rule"), model.alias("model"))
