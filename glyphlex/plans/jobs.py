"""End-to-end jobs: the three ways the reference is used, as DataFrame pipelines.

1. ``rule_baseline``   mine a lexicon from paired sentences, refine it, add the
                       out-of-vocabulary labels, rewrite the test sentences.
2. ``training_table``  prepare pairs, mine the unambiguous map, build the
                       training dictionary, demojize, de-duplicate.
3. ``post_process``    widen punctuation, reconcile each system with the rule
                       output, vote, derive pseudo-labels and pseudo pairs;
   ``feed_back``       append pseudo-labelled rows to the training table.

Inputs
------
train:  (row_id, raw_text, source_text, target_text)
test:   (id, text)
models: (id, system, score, sys_pos, prediction) — one row per system and id
annotations: ``sources.io.read_annotations`` output (optional)
symbols: what counts as a symbol: the grammar, or ``vocab.symbol_list`` of a table
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.symbols import GRAMMAR, Symbols
from ..functions.text import align_punct
from ..operators import dataset, mining, pseudo, reconcile, substitute, vote
from ..operators import dictionaries as dicts
from ..operators.labels import first_alias_labels
from ..session import materialize


def observed(spark, observation: Observation) -> DataFrame:
    """One row: the counters of a job whose result has been written."""
    values = observation.get
    return spark.createDataFrame([tuple(int(v) for v in values.values())],
                                 ", ".join(f"{k} long" for k in values))


def _empty_dict(spark) -> DataFrame:
    return dicts.from_mapping(spark, {})


def rule_baseline(train: DataFrame, test: DataFrame, annotations: DataFrame | None = None,
                  annotation_slice: tuple[int | None, int | None] = (None, None),
                  min_support: int = 2, symbols: Symbols = GRAMMAR) -> dict[str, DataFrame]:
    """Entry 1: P4 -> P5 -> P7 -> P9 with the E12 ambiguity flag."""
    spark = train.sparkSession
    lex = mining.mine_lexicon(train, "source_text", "target_text", "row_id", min_support)
    labels = (first_alias_labels(annotations, *annotation_slice) if annotations is not None
              else _empty_dict(spark))
    refined = dicts.refine(lex["common"].select("key", "value", "rank"), labels, symbols)
    oov = dicts.build_oov(labels, dicts.from_mapping(spark, dicts.SPECIAL_SYMBOLS))
    dictionary = dicts.predict_dictionary(refined, oov)
    amb_keys = lex["ambiguous"].select("key").distinct()
    flagged = substitute.contains_any_key(test.select("id", "text"), "text", amb_keys,
                                          "has_ambiguous", row_id="id")
    predictions = substitute.apply_fold(flagged, "text", dictionary, "prediction")
    predictions = predictions.select("id", "prediction", "has_ambiguous")
    counters = predictions.agg(F.count(F.lit(1)).alias("n_rows"),
                               F.count_if("has_ambiguous").alias("n_with_ambiguous"))
    return {"common": lex["common"], "reconcile_keys": reconcile.reconcile_keys(refined, oov, symbols),
            "ambiguous": lex["ambiguous"], "lexicon": refined,
            "oov": oov, "dictionary": dictionary, "predictions": predictions,
            "counters": counters}


def training_table(train: DataFrame, speech_labels: DataFrame | None = None,
                   library: DataFrame | None = None, custom: DataFrame | None = None,
                   prefix: str = "", symbols: Symbols = GRAMMAR) -> dict[str, DataFrame]:
    """Entry 2: P1 -> P3 -> P8 -> E8 -> E4 -> O2, plus the G9 length profile.

    The prepared pairs and the table are written once; 'funnel' (G10) and 'duplicates'
    (rows before and pairs after O2) have the counts observed in those passes."""
    spark = train.sparkSession
    funnel, repeats = Observation(), Observation()
    prepared = materialize(dataset.prepare_pairs(train, prefix=prefix, symbols=symbols,
                                                 observation=funnel), "prepared-pairs")
    unique = mining.unique_dictionary(mining.mine_unique(prepared, symbols=symbols, ranked=False))
    if custom is None:
        custom = dicts.from_mapping(spark, dicts.CUSTOM_SYMBOLS)
    dictionary = dicts.build_dictionary(library, speech_labels, unique, custom)
    table = materialize(dataset.training_table(prepared, dictionary, symbols=symbols,
                                               observation=repeats), "training-table")
    return {"prepared": prepared, "unique": unique, "dictionary": dictionary, "table": table,
            "funnel": observed(spark, funnel), "duplicates": observed(spark, repeats),
            "profile": dataset.length_profile(table, ["source_text", "target_text"])}


def post_process(test: DataFrame, rule_predictions: DataFrame, models: DataFrame,
                 symbol_keys: DataFrame, fallback: str = "lowest",
                 thresholds: Sequence[int] = (3, 4, 5, 6),
                 systems: Sequence[tuple[str, int, int]] | None = None,
                 symbols: Symbols = GRAMMAR) -> dict[str, DataFrame]:
    """Entry 3: E5 on every system, P12 reconcile, P13 vote over the widened
    outputs, P14 pseudo-labels, P15 pseudo pairs."""
    widened = (reconcile.with_text(models, test.select("id", F.col("text").alias("_gl_raw")),
                                   "_gl_raw")
               .withColumn("prediction", align_punct("_gl_raw", "prediction"))
               .drop("_gl_raw"))
    reconciled = reconcile.reconcile_many(models, test, rule_predictions, symbol_keys, symbols)
    voted = vote.vote(widened, test, fallback, systems=systems)
    labels = vote.pseudo_labels(voted, thresholds)
    return {"widened": widened, "reconciled": reconciled,
            "counters": reconcile.decision_counters(reconciled, keys=("system",)),
            "voted": voted, "histogram": vote.vote_histogram(voted), "pseudo_labels": labels,
            "pseudo_pairs": pseudo.pseudo_pairs(labels, rule_predictions)}


def feed_back(pseudo_labels: DataFrame, test: DataFrame, training: DataFrame,
              dictionary: DataFrame, min_votes: int = 3,
              symbols: Symbols = GRAMMAR) -> DataFrame:
    """Append the rows agreed by at least ``min_votes`` systems."""
    chosen = pseudo_labels.where(F.col("min_votes") == min_votes).select("id", "prediction")
    return pseudo.add_pseudo(chosen, test, training, dictionary, symbols)
