"""E15 as a table: whole blocks come from Python and become lines in the engine."""

import random

from glyphlex.operators import diff


def test_diff_table_keeps_every_line_and_row_key(spark):
    r = random.Random(4)
    texts = [("".join(r.choice("ab 🐶") for _ in range(r.randint(0, 30))),
              "".join(r.choice("ab 狗") for _ in range(r.randint(0, 30)))) for _ in range(60)]
    texts += [("甲AB乙", "甲a乙"), ("same é🐶", "same é🐶"), ("", ""), ("", "x"), ("x", ""), (None, "x"), ("x", None),
              ("ab " * 90 + "🐶" + "cd " * 20, "ab " * 90 + "狗" + "cd " * 20)]
    ids = [None if i % 9 == 0 else (1 << 60) + i for i in range(len(texts))]
    df = spark.createDataFrame([(i, *t) for i, t in zip(ids, texts)], "row_id long, a string, b string")
    out = diff.diff_table(df, "a", "b")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInPandas" not in plan and "posexplode" in plan
    want = [(i, step, op, ch) for i, (a, b) in zip(ids, texts) if a is not None and b is not None
            for step, (op, ch) in enumerate(diff.diff_ops(a, b))]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
