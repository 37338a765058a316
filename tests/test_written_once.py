"""Jobs at sentence level: inputs written and mined once, and diffs without a search."""

import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from glyphlex.operators import diff, matching, mining, reconcile
from glyphlex.plans import fixtures as fx

TEXTS = ["I saw the cat and the dog.It was fun, le end", "and la casa la.\nNo more", "", None,
         "der Hund der schläft.The the the end", "I saw the cat and the dog."]


@pytest.fixture
def documents(tmp_path):
    pq.write_table(pa.table({"doc_id": [5, 1, 2, 3, 4, 9], "text": TEXTS}), str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def counted(monkeypatch, module, name):
    calls, own = [], getattr(module, name)
    monkeypatch.setattr(module, name, lambda *a, **k: (calls.append(name), own(*a, **k))[1])
    return calls


def test_p16_computes_its_pairs_once(spark, documents, monkeypatch):
    calls = counted(monkeypatch, fx, "pairs")
    rows = entry.queries()["p16_add_pseudo"](spark, documents).collect()
    assert len(calls) == 1
    assert {r.origin for r in rows} == {"train", "pseudo"}


def test_p12_computes_its_pairs_and_lexicon_once(spark, documents, monkeypatch):
    pairs, mined = counted(monkeypatch, fx, "pairs"), counted(monkeypatch, mining, "mine_lexicon")
    rows = entry.queries()["p12_reconcile_many"](spark, documents).collect()
    assert (len(pairs), len(mined)) == (1, 1)
    assert len(rows) == 4 * fx.test_table(spark, documents).count()


def test_reconcile_many_fails_on_a_missing_text_only_if_it_is_needed(spark):
    keys = spark.createDataFrame([("🐶", 0)], "key string, rank long")
    models = spark.createDataFrame([(1, "s0", "狗A")], "id long, system string, prediction string")
    raw = spark.createDataFrame([(1, "🐶 a"), (2, "x")], "id long, text string")
    rule = spark.createDataFrame([(1, "狗 a"), (3, "y")], "id long, prediction string")
    got = reconcile.reconcile_many(models, raw, rule, keys).collect()
    assert [(r.id, r.system, r.decision, r.prediction) for r in got] == [(1, "s0", "model", "狗a")]
    for name, r, p in (("raw", raw.where("id = 2"), rule), ("rule", raw, rule.where("id = 3"))):
        with pytest.raises(Exception, match="for identifier: 1"):
            reconcile.reconcile_many(models, r, p, keys).collect()


def test_decide_walks_changed_rows_as_the_loop_does(spark):
    rows = [("甲AB", "甲ab", "甲，ab"), ("甲", "甲", "甲！"), (None, None, "x"), (None, None, None), ("甲", None, "甲"),
            (None, "乙", "乙"), ("甲狗", "甲", None), ("甲A", "甲a", None), ("甲AB", "甲ab", "甲，ab"), ("", None, "y")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, x string, y string, m string")
    out = diff.decide(df, "x", "y", "m", keep=["i"])
    assert out.columns == ["i", "x", "y", "m", "use_rule", "repaired"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInPandas" not in plan and plan.count("walk(") == 1
    got = {r.i: (r.use_rule, r.repaired) for r in out.collect()}
    for i, (x, y, m) in enumerate(rows):
        use, rep = (False, m) if x is None and y is None else diff.reconcile_decision(x or "", y or "", m or "")
        assert got[i] == (use, rep if m is not None else None), rows[i]


def test_runs_within_runs_need_no_search(monkeypatch):
    def none(*_a):
        raise AssertionError("a search")
    monkeypatch.setattr(matching.Matcher, "_by_find", none)
    a, b = "we saw 🐶 in 🐱 old house", "wesaw狗in猫oldhouse"
    assert [a[i:i + k] for i, _j, k in matching.Matcher(None, a, b).get_matching_blocks()] == [
        "we", "saw", "in", "old", "house", ""]
    assert diff.reconcile_decision("wesawinold", "wesaw狗in猫old", "we") == (False, "we")


def test_runs_within_runs_are_matched_as_the_library_does():
    import difflib
    r = random.Random(8)
    some = 0
    for _ in range(4000):
        words = ["".join(r.choice("abc") for _ in range(r.randint(1, r.choice([2, 6])))) for _ in range(r.randint(1, 10))]
        a = "".join(w + r.choice(["", " ", " 🐶"]) for w in words)
        b = "".join(w + r.choice(["", "", "狗"]) for w in words)
        if r.random() < 0.5:
            a, b = b, a
        some += matching._aligned(a, b, set()) is not None
        assert matching.Matcher(None, a, b).get_matching_blocks() == difflib.SequenceMatcher(
            None, a, b).get_matching_blocks(), (a, b)
    assert some > 1000
