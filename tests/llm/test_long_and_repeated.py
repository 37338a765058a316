"""Repeated words and rows, very long texts, and scripts other than Latin."""

import random
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers import SENTENCE, alnum_words, benchmark_hits, documents

from glyphlex.llm import decontaminate, packing, queries, sharding, token_trees, tokens
from glyphlex.llm.tokens import WordEncoder, tokenizer_path


def hits(texts, items):
    index = decontaminate.build_index([(i, t.encode()) for i, t in items])
    return [(r["n_words"], sum(s["words"] for s in r["spans"]), sorted(r["items"]))
            for r in decontaminate.scan(pa.array(texts), index).to_pylist()]


def test_one_word_over_and_over():
    began = time.time()
    assert hits(["same " * 4000], [("1", "same " * 4000)]) == [(4000, 4000, ["1"])]
    assert time.time() - began < 1


@pytest.mark.parametrize("seed", range(12))
def test_runs_and_periods_hit_like_all_windows(seed):
    r = random.Random(seed)

    def words(n):
        out = []
        while len(out) < n:
            unit = [r.choice("abcd") for _ in range(r.choice([1, 1, 2, 3, 7]))]
            out += unit * r.randint(1, 12)
        return out
    pool = [words(r.randint(1, 60)) for _ in range(6)]
    items = [(str(k), " ".join(w)) for k, w in enumerate(pool)]
    texts = [" ".join(w) for w in (words(200), words(30), pool[0] * 3, pool[1] + words(20) + pool[2][5:], pool[3][:14])]
    for text, got in zip(texts, hits(texts, items)):
        assert got == benchmark_hits(text, items), text


def test_repeated_rows_are_dealt(spark):
    rows = spark.range(9000).selectExpr(
        "if(id % 3 = 0, 7, id) as doc_id",
        "if(id % 3 = 0, 'the same row again and again', concat('text ', id, ' of some words')) as text")
    size, slots = Counter(), defaultdict(list)
    for r in sharding.shard(rows, 16).select("size", "shard", "slot").collect():
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    mean = sum(size.values()) / 16
    assert len(size) == 16 and all(abs(x - mean) < 0.01 * mean for x in size.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_one_repeated_row_only(spark):
    rows = spark.range(1600).selectExpr("cast(1 as long) doc_id", "'x' text")
    assert {r["shard"]: r["count"] for r in sharding.shard(rows, 16).groupBy("shard").count().collect()} == {
        k: 100 for k in range(16)}


class LongText:
    """In place of an encoder: one text of many identifiers."""

    def __init__(self, n):
        self.n = n

    def encode_all(self, texts):
        yield 0, np.arange(self.n, dtype="<u4").tobytes()

    def end_task(self):
        pass


def test_long_text_is_cut_without_copies(monkeypatch):
    monkeypatch.setattr(packing, "encoder", lambda path: LongText(16 << 20))
    batch = pa.RecordBatch.from_arrays([pa.array([5]), pa.array(["x"]), pa.array([0])], ["uid", "text", "task"])
    began = time.time()
    pieces = [r for b in packing._pack_task(iter([batch]), "", 2, 4096, False)
              for r in zip(b["start"].to_pylist(), b["length"].to_pylist(), b["doc_tokens"].to_pylist())]
    assert time.time() - began < 3
    assert pieces == [(k, 4096, (16 << 20) + 1) for k in range(0, 16 << 20, 4096)] + [(16 << 20, 1, (16 << 20) + 1)]


def test_parts_of_a_long_text_give_its_tokens(monkeypatch):
    encoder = WordEncoder(tokenizer_path(queries.PACK_TOKENIZER))
    texts = [f"{SENTENCE}\t{SENTENCE.upper()}\n don't É中文!? " * 30, None, "", "x" * 700, " <|endoftext|> y " * 50]
    want = [encoder.whole(t or "") for t in texts]
    monkeypatch.setattr(tokens, "GROUP_BYTES", 64)
    monkeypatch.setattr(tokens, "WORDS", 10)
    monkeypatch.setattr(tokens, "PIECES", 10)
    encoder.forget()
    got = defaultdict(bytes)
    for _ in range(3):
        got.clear()
        for row, ids in encoder.encode_all(pa.array(texts)):
            got[row] += ids
            assert len(encoder.pieces) < 60 and len(encoder.words) < 60
        assert [got[k] for k in range(len(texts))] == want
    encoder.forget()
    assert not encoder.pieces and not encoder.words and not encoder.before


SCRIPTS = {
    "cyrillic": "съешь ещё этих мягких французских булок, да выпей чаю. ",
    "chinese": "视野无限广，窗外有蓝天。微风迎客，软语伴茶！",
    "arabic": "نص حكيم له سر قاطع وذو شأن عظيم مكتوب على ثوب أخضر. ",
    "digits": "12 345 6789, 0; ",
    "greek": "Ξεσκεπάζω την ψυχοφθόρα βδελυγμία· ",
    "contractions": "it's they'll 'sore' ’tis 'T was—we'd ",
}


@pytest.mark.parametrize("script", SCRIPTS)
def test_edits_in_any_script_stay_local(script):
    import public_tokenizers
    encode = token_trees.Encoder(tokenizer_path(queries.COUNT_RANKS), public_tokenizers.PATTERN)
    unit, r = SCRIPTS[script], random.Random(script)
    text = unit * (12000 // len(unit))
    tree = token_trees.Tree.build(text, encode)
    for _ in range(25):
        at = r.randrange(len(text))
        text, again = tree.edit(text, at, r.choice([0, 3]), r.choice(["", "abc", "é ", "，", "'s", "  ", "\n"]), encode)
        assert again < 2000
        assert tree.total == encode.count(text)


def test_words_of_helpers():
    assert alnum_words("A-b") == ["a", "b"] and documents
