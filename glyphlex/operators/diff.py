"""Character diff stages (E15, E16, E21): the only per-row Python in the engine.

A character diff with the reference's block order (changed blocks print the
shorter side first, ties print deletions first, and a popular-character rule
applies once the second text reaches 200 characters) is not expressible in SQL,
so it runs as an Arrow-batched ``mapInPandas`` stage over whole texts of any
length.  Matching blocks are those of the standard library, found in almost linear
time (``matching.py``); everything around the diff (filtering equal rows first, counting, ranking, joining) stays in Spark.
"""

from __future__ import annotations

import string
from collections import deque
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import chars
from .equal_rows import computed_once
from .matching import POPULAR_FROM, Matcher, _aligned

Block = tuple[str, str]  # "-", "+" or " ", and the characters


def _changed(gone: str, come: str) -> Iterator[Block]:
    """A changed block: the shorter side first, deletions first on ties."""
    sides = [("-", gone), ("+", come)]
    if len(come) < len(gone):
        sides.reverse()
    return (side for side in sides if side[1])


def _replaced(x: str, y: str) -> Iterator[Block]:
    """A replaced block of a long text, which may hold common (popular) characters.

    Characters of ``y`` are taken in order; one that occurs in the rest of ``x``
    ties the two sides together at its first place there, and what lies before it
    is a changed block.  One pass: a character that is not found once is not
    looked for again, since the rest of ``x`` only gets shorter.
    """
    i = j = 0
    absent: set[str] = set()
    for k, ch in enumerate(y):
        if ch in absent:
            continue
        place = x.find(ch, i)
        if place < 0:
            absent.add(ch)
            continue
        yield from _changed(x[i:place], y[j:k])
        yield " ", ch
        i, j = place + 1, k + 1
    yield from _changed(x[i:], y[j:])


def diff_blocks(a: str, b: str) -> Iterator[Block]:
    """E15 as blocks of equal, deleted and inserted characters, in the order in which
    ``difflib.Differ().compare(a, b)`` prints them."""
    long = len(b) >= POPULAR_FROM
    for tag, i1, i2, j1, j2 in Matcher(None, a, b).get_opcodes():
        if tag == "equal":
            yield " ", a[i1:i2]
        elif tag == "replace" and long:
            yield from _replaced(a[i1:i2], b[j1:j2])
        else:
            yield from _changed(a[i1:i2], b[j1:j2])


def diff_ops(a: str, b: str) -> list[tuple[str, str]]:
    """``[(op, ch)]`` with op in ``'-' '+' ' '``, per code point."""
    return [(op, ch) for op, text in diff_blocks(a, b) for ch in text]


def extract_pairs(a: str, b: str, strict: bool = False) -> list[tuple[str, str]]:
    """(key, text) pairs from the diff of a (symbol text) and b (plain text).

    What was deleted and inserted since the last pair is a pair as soon as an
    equal block follows and neither is empty; so a lone deletion is carried into
    the next key, and a change at the very end is dropped.  ``strict=True`` drops
    what is carried at every equal block and takes the change at the end.
    """
    since: dict[str, list[str]] = {"-": [], "+": []}
    out = []
    for op, text in [*diff_blocks(a, b), *([(" ", "")] if strict else [])]:
        if op != " ":
            since[op].append(text)
            continue
        pair = ("".join(since["-"]), "".join(since["+"]))
        if all(pair):
            out.append(pair)
        if strict or all(pair):
            since = {"-": [], "+": []}
    return out


_LETTERS = frozenset(string.ascii_letters)


def reconcile_decision(raw_clean: str, model_clean: str, model: str) -> tuple[bool, str]:
    """E21 + P11 decision: (take the rule output?, model text with its case repaired).

    The rule output is taken if any deleted character is not an ASCII letter; the
    model text is then of no use and stays as it is.  Otherwise the deleted
    letters form a queue, and an inserted character that equals its head but for
    case is written like the head everywhere in ``model``.
    """
    # where short texts need no search, the matches alone tell that nothing is deleted
    found = _aligned(raw_clean, model_clean, set()) if len(model_clean) < POPULAR_FROM else None
    if found is not None and sum(size for _, _, size in found) == len(raw_clean):
        return False, model
    blocks = list(diff_blocks(raw_clean, model_clean))
    if any(op == "-" and not _LETTERS.issuperset(text) for op, text in blocks):
        return True, model
    queue: deque[str] = deque()
    for op, text in blocks:
        if op == "-":
            queue.extend(text)
        elif op == "+":
            for ch in text:
                if queue and queue[0].upper() == ch.upper():
                    model = model.replace(ch, queue.popleft())
    return False, model


# ---------------------------------------------------------------------------
# Spark stages
# ---------------------------------------------------------------------------

PAIR_SCHEMA = "row_id long, seq int, key string, text string, weight long"


def python_partitions(spark) -> int:
    """Partitions for a CPU-bound Python stage after a shuffle: the cluster's
    shuffle partition count, at least its parallelism."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")),
               spark.sparkContext.defaultParallelism)


def mine_pairs(df: DataFrame, source: str = "source_text", target: str = "target_text",
               row_id: str = "row_id", strict: bool = False, dedupe: bool = True) -> DataFrame:
    """(row_id, seq, key, text, weight) for every mined pair, ``seq`` = order in the row.

    Rows whose texts are equal cannot yield a pair and never reach Python.
    With ``dedupe`` every distinct (source, target) is diffed once: the diff
    depends only on the two texts, so ``row_id`` is the first row holding them
    and ``weight`` the number of such rows (the aggregation is partial, so
    repeated lines collapse before the shuffle).  Counts must sum ``weight``.
    """
    work = (computed_once(df.select(F.col(row_id).cast("long").alias("row_id"),
                                    F.col(source).alias("a"), F.col(target).alias("b")))
            .where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))))
    if dedupe:
        # partial aggregation collapses repeated pairs map-side, and the exchange of the
        # aggregation deals the distinct pairs to the Python stage: a spread by (a, b)
        # falls together with it, one by another key would shuffle all texts again
        work = (work.groupBy("a", "b").agg(F.min("row_id").alias("row_id"),
                                           F.count(F.lit(1)).alias("w"))
                .repartition(python_partitions(df.sparkSession), "a", "b"))
    else:
        work = work.withColumn("w", F.lit(1).cast("long"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rid, seq, keys, texts, weights = [], [], [], [], []
            for r, a, b, w in zip(pdf["row_id"].tolist(), pdf["a"].tolist(), pdf["b"].tolist(),
                                  pdf["w"].tolist()):
                for i, (k, t) in enumerate(extract_pairs(a, b, strict)):
                    rid.append(r)
                    seq.append(i)
                    keys.append(k)
                    texts.append(t)
                    weights.append(w)
            yield pd.DataFrame({"row_id": pd.Series(rid, dtype="int64"),
                                "seq": pd.Series(seq, dtype="int32"),
                                "key": pd.Series(keys, dtype="object"),
                                "text": pd.Series(texts, dtype="object"),
                                "weight": pd.Series(weights, dtype="int64")})

    return work.select("row_id", "a", "b", "w").mapInPandas(run, PAIR_SCHEMA)


def diff_table(df: DataFrame, a: str, b: str, row_id: str = "row_id") -> DataFrame:
    """E15 as a table: (row_id, step, op, ch) for every diff line.

    Only changed rows are handed to Python, which returns whole blocks; blocks become
    lines in the engine."""
    work = (computed_once(df.select(F.col(row_id).cast("long").alias("row_id"),
                                    F.col(a).alias("a"), F.col(b).alias("b")))
            .where(F.col("a").isNotNull() & F.col("b").isNotNull()))

    @F.arrow_udf("array<struct<start:int,op:string,text:string>>")
    def changed(a: pa.Array, b: pa.Array) -> pa.Array:
        ends, starts, ops, texts = [0], [], [], []
        for x, y in zip(a.to_pylist(), b.to_pylist()):
            start = 0
            for op, text in diff_blocks(x, y) if x is not None else ():
                starts.append(start)
                ops.append(op)
                texts.append(text)
                start += len(text)
            ends.append(len(ops))
        blocks = pa.StructArray.from_arrays(
            [pa.array(starts, pa.int32()), pa.array(ops, pa.string()), pa.array(texts, pa.string())],
            ["start", "op", "text"])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), blocks)

    differs = F.col("a") != F.col("b")
    found = work.select("row_id", "a", differs.alias("differs"), changed(
        F.when(differs, F.col("a")), F.when(differs, F.col("b"))).alias("blocks"))
    same = F.array(F.struct(F.lit(0).alias("start"), F.lit(" ").alias("op"), F.col("a").alias("text")))
    blocks = found.select("row_id", F.inline(F.when(F.col("differs"), F.col("blocks")).otherwise(same)))
    return blocks.select("row_id", "start", "op", F.posexplode(chars("text")).alias("at", "ch")).select(
        "row_id", (F.col("start") + F.col("at")).alias("step"), "op", "ch")


def decide(df: DataFrame, raw_clean: str, model_clean: str, model: str,
           keep: list[str]) -> DataFrame:
    """Append (use_rule boolean, repaired string) computed by the E21 walk; where the
    cleaned texts are equal or both null there is nothing to walk, and Python gets none."""
    cols = list(keep) + [raw_clean, model_clean, model]
    work = computed_once(df.select(*[F.col(c) for c in dict.fromkeys(cols)]))

    @F.pandas_udf("use_rule boolean, repaired string")
    def walk(raw: pd.Series, clean: pd.Series, text: pd.Series) -> pd.DataFrame:
        use, rep = [], []
        known = {(None, None, None): (False, None)}  # several systems may give one answer
        for row in zip(raw.tolist(), clean.tolist(), text.tolist()):
            if row not in known:
                known[row] = reconcile_decision(*row)
            u, r = known[row]
            use.append(u)
            rep.append(None if r == row[2] else r)
        return pd.DataFrame({"use_rule": pd.Series(use, dtype="bool"),
                             "repaired": pd.Series(rep, dtype="object")})

    own, other, text = (F.coalesce(c, F.lit("")) for c in (raw_clean, model_clean, model))
    walked = walk(*[F.when(own != other, c) for c in (own, other, text)])
    return work.withColumn("_gl_walk", walked).select(
        *work.columns, F.col("_gl_walk.use_rule").alias("use_rule"),
        F.when(F.col(model).isNotNull(), F.coalesce("_gl_walk.repaired", model)).alias("repaired"))
