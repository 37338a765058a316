"""Corpus pipeline: from raw documents to packed training sequences.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and
returns what it keeps, and is written as Parquet before the next one reads it.
All stages but the last return the columns of the documents they are given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphlex.llm import decontaminate, exact_dedup, packing, simhash, toxicity
from glyphlex.llm.common import materialize, table
from glyphlex.llm.queries import PACK_END, PACK_TOKENIZER
from glyphlex.llm.tokens import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a toxicity score below one half."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where("score < 0.5").select("_row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the largest doc_id of each group of equal texts."""
    return exact_dedup.dedup(docs, keep="largest").where("kept").select("_row.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each component."""
    return simhash.near_duplicates(docs, shingle=4, max_bits=4).where("kept").select("_row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents of which less than a twentieth occurs in the benchmark."""
    found = decontaminate.find_benchmark(docs, table(spark, sf_dir, "benchmark"))
    return found.where(~decontaminate.contaminated(F.col("n_words"), F.col("n_hit"))).select("_row.*")


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all documents into sequences of 4096 tokens, token identifiers included."""
    return packing.pack(docs, tokenizer_path(PACK_TOKENIZER), PACK_END)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_tokens),
]

#: The classifier and the tokenizer have no SQL form; tests hold the pipeline
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
