"""Candidates are written packed, all systems in one pass."""

import glob

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from glyphlex import session
from glyphlex.plans import fixtures as fx

TEXTS = ["I saw the cat and the dog.It was fun, le end", "and la casa la.\nNo more", "", None,
         "der Hund der schläft.The the the end", "I saw the cat and the dog."]


@pytest.fixture
def documents(tmp_path):
    pq.write_table(pa.table({"doc_id": [5, 1, 2, 3, 4, 9], "text": TEXTS}), str(tmp_path / "documents.parquet"))
    return str(tmp_path)


def test_candidates_are_written_packed_in_one_pass(spark, documents, monkeypatch):
    paths = []
    own = session.scratch_path
    monkeypatch.setattr(session, "scratch_path", lambda s, n: (paths.append(own(s, n)), paths[-1])[1])
    got = entry.queries()["a7_candidate_scan"](spark, documents)
    want = fx.candidates(spark, documents).select("id", "system", "score", "prediction")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    base = next(p for p in paths if "candidates-" in p).removeprefix("file:")
    for _name, score, _pos in fx.SYSTEMS:
        plain = [f for f in glob.glob(f"{base}/res={score}/part-*") if not f.endswith(".gz")]
        assert glob.glob(f"{base}/res={score}/part-*.gz")
        assert all(len(open(f).readlines()) <= 1 for f in plain)  # a header at most


def test_candidates_of_an_empty_table(spark, tmp_path):
    pq.write_table(pa.table({"doc_id": pa.array([1], pa.int64()), "text": pa.array([None], pa.string())}),
                   str(tmp_path / "documents.parquet"))
    assert entry.queries()["a7_candidate_scan"](spark, str(tmp_path)).collect() == []
